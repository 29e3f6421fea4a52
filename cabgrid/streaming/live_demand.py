"""The demand aggregate on a stream of trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabgrid.config import Settings
from cabgrid.operators.demand import assign_cells, demand_windows, known_zone_trips


def live_demand(
    trips: DataFrame,
    zone_cells: DataFrame,
    settings: Settings,
    key: Column | None = None,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Demand windows of a trip stream; a window is final once the watermark passes it.

    Event time must be a ``timestamp``: local timestamps cannot carry a watermark.
    """
    known = known_zone_trips(trips, settings.unknown_zones)
    timed = known.withColumn(
        "tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp")
    ).withWatermark("tpep_pickup_datetime", lateness)
    return demand_windows(assign_cells(timed, zone_cells, key), settings)


def write_available(demand: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all input that is available now to a Parquet table, then stop."""
    return (
        demand.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
