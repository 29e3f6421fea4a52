"""Answers for many drivers, slots or cells at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabgrid.config import Settings
from cabgrid.functions import scalars
from cabgrid.operators.stations import DETAILS, long_stations, wide_name

SLOT = ("hour_of_day", "day_of_week")

OK = "ok"
OUT_OF_AREA = "out_of_area"
NO_MATCH = "no_match"


def locate(points: DataFrame, settings: Settings) -> DataFrame:
    """Cell, hour, day of week and service-area flag of points ``(lat, lon, ts)``."""
    return points.withColumns(
        {
            "in_area": F.coalesce(scalars.in_box("lat", "lon", settings.service_box), F.lit(False)),
            "driver_h3": settings.grid.cell_of("lat", "lon"),
            "hour": F.hour("ts"),
            "day_of_week": F.dayofweek("ts"),
        }
    )


def _status(found: Column) -> Column:
    return F.when(~F.col("in_area"), OUT_OF_AREA).when(found, OK).otherwise(NO_MATCH)


def answer_lists(recs: DataFrame, settings: Settings) -> DataFrame:
    """One row per origin and slot with its ranked answers as an array of at most ``top`` structs."""
    grid = settings.grid
    answer = F.struct(
        F.col("rank"),
        F.col("candidate_h3").alias("h3_cell"),
        grid.center_lat("candidate_h3").alias("lat"),
        grid.center_lon("candidate_h3").alias("lon"),
        scalars.shown("candidate_demand", 2).alias("predicted_demand"),
        scalars.shown("charger_score", 2).alias("charger_score"),
        F.col("grid_distance"),
        scalars.shown("final_score", 4).alias("score"),
    )
    return (
        recs.filter(F.col("rank") <= settings.top)
        .groupBy("origin_h3", *SLOT)
        .agg(F.array_sort(F.collect_list(answer)).alias("recommendations"))
    )


def recommend(points: DataFrame, recs: DataFrame, settings: Settings) -> DataFrame:
    """Each point with a status and its list of recommendations.

    Recommendations are nested before the join, so a point stays one row and a
    crowded cell does not multiply.
    """
    return _answered(points, locate(points, settings), answer_lists(recs, settings))


def look_up(points: DataFrame, recs: DataFrame, settings: Settings, buckets: int) -> DataFrame:
    """The same from a lookup table of so many buckets (``sinks.lookup``), reading only the slots asked for.

    The slots of the points, at most 24 x 7 rows and so always broadcast, prune
    the table's folders at run time. The cells asked for, each with its slots, are dealt by
    the hash of the buckets. So the table stays where it is, and the lists are made there, as a
    bucket holds all rows of a cell.
    """
    located = locate(points, settings)
    asked = (
        # The range holds for every hour; Spark prunes by filters that compare.
        located.filter("in_area AND driver_h3 IS NOT NULL AND hour BETWEEN 0 AND 23")
        .selectExpr("driver_h3 AS origin_h3", "hour AS hour_of_day", "day_of_week")
        .distinct()
    )
    slots = asked.select(*SLOT).distinct()
    cells = (
        asked.repartition(buckets, "origin_h3")
        .groupBy("origin_h3")
        .agg(F.collect_set(F.struct(*SLOT)).alias("slots_asked"))
    )
    found = (
        recs.join(F.broadcast(slots), [*SLOT], "left_semi")
        .join(cells, "origin_h3")
        .filter(F.array_contains("slots_asked", F.struct(*SLOT)))
    )
    return _answered(points, located, answer_lists(found, settings))


def _answered(points: DataFrame, located: DataFrame, lists: DataFrame) -> DataFrame:
    lists = lists.withColumnsRenamed({"origin_h3": "driver_h3", "hour_of_day": "hour"})
    found = located.join(lists, ["driver_h3", "hour", "day_of_week"], "left")
    return found.select(
        *points.columns,
        "driver_h3",
        "hour",
        "day_of_week",
        _status(F.col("recommendations").isNotNull()).alias("status"),
        F.when(F.col("in_area"), F.col("recommendations")).alias("recommendations"),
    )


def recommendation_rows(answers: DataFrame) -> DataFrame:
    """Nested answers as one row per recommendation."""
    return answers.select(*[c for c in answers.columns if c != "recommendations"], F.inline("recommendations"))


def to_json(answers: DataFrame) -> DataFrame:
    """Successful answers as response text."""
    return answers.filter(F.col("status") == OK).withColumn(
        "response", F.to_json(F.struct("driver_h3", "hour", "day_of_week", "recommendations"))
    )


def nearest_chargers(points: DataFrame, nearest: DataFrame, settings: Settings) -> DataFrame:
    """Nearest-station columns for each point's cell; the lowest zone id answers for a shared cell."""
    columns = [wide_name(p, name) for p in range(1, settings.stations_per_cell + 1) for name in DETAILS]
    by_cell = (
        nearest.groupBy("h3_cell")
        .agg(F.min_by(F.struct("LocationID", *columns), "LocationID").alias("first"))
        .select("h3_cell", "first.*")
    )
    cells = points.withColumn("h3_cell", settings.grid.cell_of("lat", "lon"))
    return cells.join(by_cell, "h3_cell", "left").withColumn(
        "status", F.when(F.col("LocationID").isNotNull(), OK).otherwise(NO_MATCH)
    )


def charger_rows(points: DataFrame, nearest: DataFrame, settings: Settings) -> DataFrame:
    """Nearest stations of each point as rows by priority, for points with a match."""
    found = nearest_chargers(points, nearest, settings).filter(F.col("status") == OK)
    renamed = found.withColumnsRenamed({"lat": "driver_lat", "lon": "driver_lon"})
    return long_stations(renamed.drop("LocationID", "status"), settings.stations_per_cell)


def slot(typical: DataFrame, hour: int | None = None, day: int | None = None) -> DataFrame:
    """Rows of one hour, one day of week, or both. Prunes folders of a slot table."""
    rows = typical
    if hour is not None:
        rows = rows.filter(F.col("hour_of_day") == hour)
    if day is not None:
        rows = rows.filter(F.col("day_of_week") == day)
    return rows


def heatmap(typical: DataFrame, settings: Settings) -> DataFrame:
    """Heatmap records: slot, cell, centre and displayed demand."""
    grid = settings.grid
    return typical.select(
        *SLOT,
        F.col("pickup_h3").alias("h3"),
        grid.center_lat("pickup_h3").alias("center_lat"),
        grid.center_lon("pickup_h3").alias("center_lon"),
        scalars.shown("typical_demand", 2).alias("demand"),
    )


def heatmap_status(slots: DataFrame, typical: DataFrame) -> DataFrame:
    """For requested slots: how many cells are active, and whether there is an answer."""
    active = typical.groupBy(*SLOT).agg(F.count("*").alias("cells"))
    return slots.join(active, [*SLOT], "left").select(
        *slots.columns,
        F.coalesce("cells", F.lit(0)).alias("cells"),
        F.when(F.col("cells").isNotNull(), OK).otherwise(NO_MATCH).alias("status"),
    )


def intensity(typical: DataFrame, frame: tuple[str, ...] = SLOT, epsilon: float = 1e-9) -> DataFrame:
    """Demand scaled to [0, 1] within each frame of the view.

    A frame may hold every cell, so its extremes are aggregated and joined
    back; Spark decides how by their size.
    """
    extremes = typical.groupBy(*frame).agg(
        F.min("typical_demand").alias("low"), F.max("typical_demand").alias("high")
    )
    return (
        typical.join(extremes, list(frame))
        .withColumn(
            "intensity", scalars.min_max("typical_demand", "low", "high", epsilon)
        )
        .withColumn("height", scalars.shown("typical_demand", 0))
        .drop("low", "high")
    )


def day_frames(typical: DataFrame, day: int) -> DataFrame:
    """All hourly frames of one day of week."""
    return intensity(slot(typical, day=day), ("hour_of_day",))


def hour_view(typical: DataFrame, hour: int) -> DataFrame:
    """All seven days at one hour, scaled together; a cell appears once per day."""
    return intensity(slot(typical, hour=hour), ("hour_of_day",))
