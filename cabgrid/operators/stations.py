"""Charging stations: cleaning, nearest three per cell, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.config import Settings
from cabgrid.functions import scalars
from cabgrid.functions.hexgrid import grid_distance, pack_sql, q_sql, r_sql

DETAILS = ("station_name", "lat", "lon", "fast_chargers", "level2_chargers", "charger_h3")

# Square tiles of so many bits along each axis: blocks of four by four cells, districts
# of 16 by 16, and regions wider than a metropolitan area (about 400 km).
BLOCK, DISTRICT, REGION = 2, 4, 9
# Districts of cells are dealt to so many copies of the regions, of which there are few.
ROOT_COPIES = 64
AXES = (("q", "q"), ("r", "r"), ("s", "q + r"))


def clean_stations(raw: DataFrame, settings: Settings, key: Column | None = None) -> DataFrame:
    """Typed stations inside the station box, with a stable id and their cell.

    Unreadable coordinates drop a row, unreadable counts become NULL. A count
    with a point is readable and counts by its whole part. The id is
    ``key``, else a hash of the row's text, so it does not depend on how the
    file was split.
    """
    typed = raw.select(
        (F.xxhash64(*raw.columns) if key is None else key.cast("bigint")).alias("charger_id"),
        F.col("Station Name").alias("station_name"),
        scalars.number_or_null("Latitude").alias("lat"),
        scalars.number_or_null("Longitude").alias("lon"),
        scalars.whole_number("EV DC Fast Count").alias("fast_chargers"),
        scalars.whole_number("EV Level2 EVSE Num").alias("level2_chargers"),
    )
    return typed.filter(scalars.in_box("lat", "lon", settings.station_box)).withColumn(
        "charger_h3", settings.grid.cell_of("lat", "lon")
    )


def rejected_stations(raw: DataFrame) -> DataFrame:
    """How many rows have unreadable coordinates or counts."""

    def unreadable(name: str) -> Column:
        return F.count_if(F.col(name).isNotNull() & scalars.whole_number(name).isNull())

    return raw.agg(
        F.count("*").alias("stations"),
        F.count_if(F.col("Latitude").try_cast("double").isNull() | F.col("Longitude").try_cast("double").isNull()).alias(
            "bad_coordinates"
        ),
        unreadable("EV DC Fast Count").alias("bad_fast"),
        unreadable("EV Level2 EVSE Num").alias("bad_level2"),
    )


def _tile(bits: int, name: str) -> Column:
    """Id of the square tile of ``2**bits`` cells that holds ``(q, r)``."""
    return F.expr(f"{pack_sql(f'shiftright(q, {bits})', f'shiftright(r, {bits})')} AS {name}")


def _above(tile: str, bits: int, name: str) -> Column:
    """Id of the tile that holds ``tile``, whose edges are ``2**bits`` times as long."""
    return F.expr(f"{pack_sql(f'shiftright({q_sql(tile)}, {bits})', f'shiftright({r_sql(tile)}, {bits})')} AS {name}")


def _extent(name: str) -> Column:
    """Extremes of a tile's cells along the three axes."""
    ends = ", ".join(f"'{a}_{end}', {end}({at})" for a, at in AXES for end in ("min", "max"))
    return F.expr(f"named_struct({ends}) AS {name}")


def _union(name: str) -> Column:
    """Extremes of a tile from those of the tiles in it."""
    ends = ", ".join(f"'{a}_{end}', {end}({name}.{a}_{end})" for a, _ in AXES for end in ("min", "max"))
    return F.expr(f"named_struct({ends}) AS {name}")


def _placed(rows: DataFrame, cell: str) -> DataFrame:
    return rows.filter(F.col(cell).isNotNull()).selectExpr("*", f"{q_sql(cell)} AS q", f"{r_sql(cell)} AS r")


def _within_reach(pairs: DataFrame, by: str, k: int) -> DataFrame:
    """Of the tiles ``there`` that each tile ``here`` met, those that may hold one of the ``k`` stations nearest to a cell in it.

    ``k`` stations are certain within the least distance by whose tiles, seen
    from the farthest cells of both, ``k`` are counted. A tile none of whose cells is
    as near as that holds none of them.
    """
    # Distance is the largest difference along the three axes.
    closest = ", ".join(f"there.{a}_min - here.{a}_max, here.{a}_min - there.{a}_max" for a, _ in AXES)
    farthest = ", ".join(f"there.{a}_max - here.{a}_min, here.{a}_max - there.{a}_min" for a, _ in AXES)
    of = Window.partitionBy(by)
    within = of.orderBy("d_max").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        pairs.selectExpr("*", f"greatest(0, {closest}) AS d_min", f"greatest({farthest}) AS d_max")
        .withColumn("stations_within", F.sum("n").over(within))
        .withColumn("enough_at", F.min(F.expr(f"IF(stations_within >= {k}, d_max, NULL)")).over(of))
        .filter("enough_at IS NULL OR d_min <= enough_at")
        .drop("d_min", "d_max", "stations_within", "enough_at", "there", "n")
    )


def nearest_stations(cells: DataFrame, stations: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` nearest stations of each cell: ``(h3_cell, charger_distance, station columns, priority)``.

    Cells and stations are not paired with each other; tiles of cells meet tiles
    of stations. Stations are counted per district, and districts are summed to
    regions. A district of cells meets the regions, keeps those within reach,
    meets the districts in them and again keeps some. A block of cells takes
    over what its district kept and meets the blocks of stations in there, each
    a row with at most ``k`` stations a cell, so 16 ``k``. Only what is left is looked at cell by
    cell. Of stations in one cell the lowest ids are first, and equal distances
    go to the lower station id.

    With fewer than ``k`` stations in all, all are kept. What one district of
    cells meets is bounded by the 1,024 districts of each region kept, what a
    block meets by the 16 blocks of each district kept: those along the edge of what is near.
    """
    # Of stations in one cell only the k lowest ids can ever be chosen.
    in_cell = Window.partitionBy("charger_h3").orderBy("charger_id")
    local = (
        _placed(stations.select("charger_id", *DETAILS), "charger_h3")
        .withColumn("nth", F.row_number().over(in_cell))
        .filter(F.col("nth") <= k)
    )
    station_blocks = (
        local.groupBy(_tile(BLOCK, "station_block"))
        .agg(
            F.least(F.count("*"), F.lit(k)).alias("n"),
            _extent("there"),
            F.collect_list(F.struct("charger_id", *DETAILS)).alias("stations"),
        )
        .withColumn("district", _above("station_block", DISTRICT - BLOCK, "district"))
    )
    districts = (
        _placed(stations.select("charger_h3"), "charger_h3")
        .groupBy(_tile(DISTRICT, "district"))
        .agg(F.least(F.count("*"), F.lit(k)).alias("n"), _extent("there"))
        .withColumn("region", _above("district", REGION - DISTRICT, "region"))
        # Said here, as the join below would say it for one of two readers, and both can read one exchange.
        .filter("region IS NOT NULL AND district IS NOT NULL")
    )
    regions = districts.groupBy("region").agg(F.least(F.sum("n"), F.lit(k)).alias("n"), _union("there"))

    asked = _placed(cells.select("h3_cell"), "h3_cell")
    homes = asked.groupBy(_tile(DISTRICT, "home")).agg(_extent("here"))
    cell_blocks = (
        asked.groupBy(_tile(BLOCK, "block"))
        .agg(_extent("here"), F.collect_set("h3_cell").alias("cells"))
        .withColumn("home", _above("block", DISTRICT - BLOCK, "home"))
    )
    copies = regions.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(ROOT_COPIES - 1))))
    dealt = homes.withColumn("part", F.expr(f"CAST(pmod(xxhash64(home), {ROOT_COPIES}) AS INT)"))
    near_regions = _within_reach(dealt.join(copies, "part").drop("part"), "home", k)
    near_districts = _within_reach(near_regions.join(districts, "region").drop("region"), "home", k)
    met = cell_blocks.join(near_districts.select("home", "district"), "home").join(station_blocks, "district")
    # A block's rows are together already, so its cells need no shuffle of their own.
    nearest_first = Window.partitionBy("block", "h3_cell").orderBy("charger_distance", "charger_id")
    return (
        _within_reach(met.drop("home", "district", "station_block"), "block", k)
        .select("block", F.explode("cells").alias("h3_cell"), "stations")
        .select("block", "h3_cell", F.inline("stations"))
        .withColumn("charger_distance", grid_distance("h3_cell", "charger_h3"))
        .withColumn("priority", F.row_number().over(nearest_first))
        .filter(F.col("priority") <= k)
        .select("h3_cell", "charger_distance", "charger_id", *DETAILS, "priority")
    )


def nearest_table(zone_cell_rows: DataFrame, stations: DataFrame, k: int = 3) -> DataFrame:
    """One row per zone and cell with ``priority_1..k`` and the details of each station.

    Details travel through rank and pivot as a struct, so stations are not
    joined again. The nearest stations depend on the cell alone, so a cell that
    two zones share is ranked once.
    """
    ranked = nearest_stations(zone_cell_rows, stations, k)
    wide = (
        ranked.groupBy("h3_cell")
        .pivot("priority", list(range(1, k + 1)))
        .agg(F.first(F.struct("charger_id", *DETAILS)))
    )
    return zone_cell_rows.join(wide, "h3_cell").selectExpr(
        "LocationID",
        "h3_cell",
        *[f"`{p}`.charger_id AS priority_{p}" for p in range(1, k + 1)],
        *[f"`{p}`.{name} AS {wide_name(p, name)}" for p in range(1, k + 1) for name in DETAILS],
    )


def wide_name(priority: int, detail: str) -> str:
    """Column of one station detail in the wide table."""
    if detail == "station_name":
        return f"P{priority}_charger_station_name"
    return f"P{priority}_charger_{detail.removeprefix('charger_')}"


def long_stations(nearest: DataFrame, k: int = 3) -> DataFrame:
    """Wide nearest-station columns as rows ``(priority, name, lat, lon, fast, level2)``."""
    slots = ", ".join(
        f"""named_struct('priority', {p}, 'name', {wide_name(p, "station_name")},
            'lat', {wide_name(p, "lat")}, 'lon', {wide_name(p, "lon")},
            'fast', {scalars.safe_int_sql(wide_name(p, "fast_chargers"))},
            'level2', {scalars.safe_int_sql(wide_name(p, "level2_chargers"))})"""
        for p in range(1, k + 1)
    )
    wide = {wide_name(p, name) for p in range(1, k + 1) for name in DETAILS}
    wide |= {f"priority_{p}" for p in range(1, k + 1)}
    kept = [c for c in nearest.columns if c not in wide]
    return nearest.selectExpr(*kept, f"inline(array({slots}))")


def cell_scores(nearest: DataFrame, settings: Settings) -> DataFrame:
    """Charger score per cell, one row per cell even where zones share it."""
    counts = [
        (wide_name(p, "fast_chargers"), wide_name(p, "level2_chargers"))
        for p in range(1, settings.stations_per_cell + 1)
    ]
    scored = nearest.select("h3_cell", scalars.charger_score(counts, settings.weights).alias("charger_score"))
    return scored.groupBy("h3_cell").agg(F.max("charger_score").alias("charger_score"))


def station_points(stations: DataFrame) -> DataFrame:
    """Map points ``(name, lat, lon, fast, level2)``, one per coordinate, with a class.

    The lowest id wins where stations share a coordinate.
    """
    points = stations.select(
        "charger_id",
        F.col("station_name").alias("name"),
        scalars.number_or_null("lat").alias("lat"),
        scalars.number_or_null("lon").alias("lon"),
        scalars.zero_if_none("fast_chargers").alias("fast"),
        scalars.zero_if_none("level2_chargers").alias("level2"),
    ).na.drop(subset=["lat", "lon"])
    first = F.min_by(F.struct("name", "fast", "level2"), "charger_id")
    return (
        points.groupBy("lat", "lon")
        .agg(first.alias("first"))
        .select("first.name", "lat", "lon", "first.fast", "first.level2")
        .withColumn("station_class", F.when(F.col("fast") > 0, "fast").otherwise("level2_only"))
    )


def station_statistics(points: DataFrame) -> DataFrame:
    """Number of stations, of those with fast chargers and of those without."""
    return points.agg(
        F.count("*").alias("total_stations"),
        F.count_if(F.col("fast") > 0).alias("fast_stations"),
        F.count_if(F.col("fast") == 0).alias("level2_only_stations"),
    )
