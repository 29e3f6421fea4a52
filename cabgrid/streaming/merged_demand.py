"""Demand of a trip stream in which no trip comes too late.

Each micro-batch is summed up and its partial sums are written to folders of
date and batch; the dates that a batch touches are then made again from all
of their partial sums and replace their folders of the demand table. Other
dates are neither read nor written.

A batch that runs again, because the stream stopped before it was committed,
holds the same trips by the stream's own log. It replaces the partial sums that it
wrote before and makes the same dates again, so nothing counts twice. There is no
watermark and no state on executors: whatever a lost executor held is computed again.

A date's partial sums grow by at most its cells and windows a batch, so the time between
batches decides what a date costs. Only the dates of a batch pass the driver.

Cases: an empty batch, or one of unknown zones only, writes nothing; trips without a zone are dropped and
trips without a cell keep a NULL cell, as in the batch aggregate; averages leave out NULL measures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabgrid.config import Settings
from cabgrid.operators.demand import AVERAGES, assign_cells, known_zone_trips
from cabgrid.sinks import writers

DATE, BATCH = "window_start_date", "batch_id"
KEYS = ("window_start", "window_end", "pickup_zone_id", "pickup_h3")


@dataclass(frozen=True)
class Layout:
    """Where the partial sums, the demand table and the stream's log live, all under one base folder."""

    base: str

    @property
    def partials(self) -> str:
        return f"{self.base}/partials"

    @property
    def demand(self) -> str:
        return f"{self.base}/demand"

    @property
    def log(self) -> str:
        return f"{self.base}/log"


def partial_sums(trips: DataFrame, settings: Settings) -> DataFrame:
    """Pickups, and the sum and count of each measure, per window, zone and cell."""
    window = F.window("tpep_pickup_datetime", settings.window)
    measures = [
        made
        for measure, name in AVERAGES.items()
        for made in (F.sum(F.col(measure).cast("double")).alias(f"{name}_sum"), F.count(measure).alias(f"{name}_count"))
    ]
    return (
        trips.groupBy(window.alias("window"), F.col("PULocationID").alias("pickup_zone_id"), "pickup_h3")
        .agg(F.count("*").alias("pickup_count"), *measures)
        .select("window.start", "window.end", "*")
        .withColumnsRenamed({"start": "window_start", "end": "window_end"})
        .drop("window")
        .withColumn(DATE, F.to_date("window_start"))
    )


def merged(partials: DataFrame, settings: Settings) -> DataFrame:
    """The demand table from partial sums of any number of batches."""
    totals = [f"{name}_{part}" for name in AVERAGES.values() for part in ("sum", "count")]
    grouped = partials.groupBy(*KEYS, DATE).agg(
        F.sum("pickup_count").alias("pickup_count"), *[F.sum(name).alias(name) for name in totals]
    )
    center = settings.grid.center_of("pickup_h3")
    return grouped.withColumn("center", center).select(
        "window_start",
        "window_end",
        "pickup_zone_id",
        F.col("center.lat").alias("pickup_lat"),
        F.col("center.lon").alias("pickup_lon"),
        "pickup_h3",
        "pickup_count",
        *[F.try_divide(f"{name}_sum", f"{name}_count").alias(name) for name in AVERAGES.values()],
        DATE,
    )


def merge_batch(
    batch: DataFrame, batch_id: int, zone_cells: DataFrame, layout: Layout, settings: Settings, key: Column | None = None
) -> list:
    """Merge one batch of trips into the table. Returns the dates that it touched, in order."""
    known = known_zone_trips(batch, settings.unknown_zones)
    sums = partial_sums(assign_cells(known, zone_cells, key), settings).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    writers.overwrite_partitioned(sums, layout.partials, [DATE, BATCH], dynamic=True)
    # With its schema, because no file may be there yet.
    partials = batch.sparkSession.read.schema(sums.schema).parquet(layout.partials)
    mine = partials.filter(F.col(BATCH) == batch_id).select(DATE).distinct()
    dates = sorted(row[0] for row in mine.collect())
    if dates:
        # Dates as values: the scan lists and reads their folders only.
        writers.write_demand(merged(partials.filter(F.col(DATE).isin(*dates)), settings), layout.demand, dynamic=True)
    return dates


def merge_available(
    trips: DataFrame, zone_cells: DataFrame, layout: Layout, settings: Settings, key: Column | None = None
) -> StreamingQuery:
    """Merge all trips of the stream that are available now, then stop."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, zone_cells, layout, settings, key)

    return (
        trips.writeStream.foreachBatch(merge)
        .option("checkpointLocation", layout.log)
        .trigger(availableNow=True)
        .start()
    )
