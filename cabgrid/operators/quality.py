"""Row counts and reject counts of the pipeline's tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def trip_rejects(trips: DataFrame, zone_cells: DataFrame, unknown: tuple[int, ...]) -> DataFrame:
    """Trips in total, without a zone, with an unknown zone and with a zone that has no cells."""
    with_cells = zone_cells.filter(F.size("h3_cells") > 0)
    mapped = with_cells.select(F.col("LocationID").cast("bigint").alias("PULocationID"), F.lit(True).alias("mapped"))
    mapped = mapped.distinct()
    # Few zones, many trips: count per zone first, then look zones up.
    per_zone = trips.groupBy("PULocationID").agg(F.count("*").alias("n")).join(mapped, "PULocationID", "left")
    zone = F.col("PULocationID")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return per_zone.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("trips"),
        total(zone.isNull()).alias("no_zone"),
        total(zone.isin(*unknown)).alias("unknown_zone"),
        total(zone.isNotNull() & ~zone.isin(*unknown) & F.col("mapped").isNull()).alias("unmapped_zone"),
    )


def zones_without_cells(zone_cells: DataFrame) -> DataFrame:
    """Zone ids whose list of cells is empty or missing; their trips get no cell."""
    return zone_cells.filter(F.coalesce(F.size("h3_cells"), F.lit(0)) <= 0).select("LocationID")


def repeated_zones(zone_cells: DataFrame) -> DataFrame:
    """Zone ids that occur more than once and would multiply trips in the join."""
    return zone_cells.groupBy("LocationID").agg(F.count("*").alias("row_count")).filter("row_count > 1")
