"""Trips to 5-minute demand per zone and cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabgrid.config import Settings

# Measures of a trip and the names of their averages in the demand table.
AVERAGES = {
    "trip_distance": "avg_trip_distance",
    "fare_amount": "avg_fare",
    "average_speed_mph": "avg_speed",
    "tip_percentage": "avg_tip_pct",
    "passenger_count": "avg_passengers",
}

def known_zone_trips(trips: DataFrame, unknown: tuple[int, ...]) -> DataFrame:
    """Trips with a known pickup zone; a NULL zone is dropped as well."""
    return trips.filter(~F.col("PULocationID").isin(*unknown))


def assign_cells(trips: DataFrame, zone_cells: DataFrame, key: Column | None = None) -> DataFrame:
    """Give each trip one cell of its pickup zone, picked by ``key``.

    Trips name only a zone, so a cell is picked. The pick depends on the trip
    alone, which keeps retries and reruns equal. Trips of an unmapped zone, or
    of one without cells, keep a NULL cell.

    ``zone_cells`` has numbered rows of zone and cell (``zonefill.zone_positions``), or one
    list of cells per zone; ``zonefill.positions_of`` makes the former of lists
    of which a zone may have several. Each zone's number of cells, two
    numbers a zone, picks the position; zone and position then pick the cell. A busy
    zone is thereby split over its cells, and no list of cells travels with a trip.
    """
    if key is None:
        key = F.xxhash64(*trips.columns)
    zone = F.col("LocationID").cast("bigint").alias("PULocationID")
    if "position" in zone_cells.columns:
        sizes = zone_cells.filter("position = 0").select(zone, "n_cells")
        cells = zone_cells.select(zone, "position", F.col("h3_cell").alias("pickup_h3"))
    else:
        sizes = zone_cells.select(zone, F.size("h3_cells").alias("n_cells"))
        cells = zone_cells.select(zone, F.posexplode("h3_cells").alias("position", "pickup_h3"))
    position = F.when(F.col("n_cells") > 0, F.pmod(key, F.col("n_cells"))).cast("int")
    placed = trips.join(sizes, "PULocationID", "left").withColumn("position", position)
    return placed.join(cells, ["PULocationID", "position"], "left").select(*trips.columns, "pickup_h3")


def demand_windows(trips: DataFrame, settings: Settings) -> DataFrame:
    """Pickups and averages per tumbling window, zone and cell.

    Rows are summed up before the shuffle, so a busy zone costs no more than
    its number of windows.
    """
    grid = settings.grid
    grouped = trips.groupBy(
        F.window("tpep_pickup_datetime", settings.window),
        F.col("PULocationID").alias("pickup_zone_id"),
        "pickup_h3",
    ).agg(
        F.count("*").alias("pickup_count"),
        *[F.avg(measure).alias(name) for measure, name in AVERAGES.items()],
    )
    return (
        grouped.withColumn("center", grid.center_of("pickup_h3"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "pickup_zone_id",
            F.col("center.lat").alias("pickup_lat"),
            F.col("center.lon").alias("pickup_lon"),
            "pickup_h3",
            "pickup_count",
            *AVERAGES.values(),
        )
        .withColumn("window_start_date", F.to_date("window_start"))
    )


def demand_from_trips(
    trips: DataFrame, zone_cells: DataFrame, settings: Settings, key: Column | None = None
) -> DataFrame:
    """Filter, cell assignment and window aggregate in one step."""
    known = known_zone_trips(trips, settings.unknown_zones)
    return demand_windows(assign_cells(known, zone_cells, key), settings)
