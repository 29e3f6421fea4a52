"""Typical demand of a cell per hour and day of week, whole or as a state per date that merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typical_demand(rows: DataFrame, value: str = "predicted_demand") -> DataFrame:
    """Mean and 75th percentile of ``value`` per cell, hour and day of week."""
    return (
        rows.filter(F.col("pickup_h3").isNotNull())
        .groupBy(
            "pickup_h3",
            F.hour("window_start").alias("hour_of_day"),
            F.dayofweek("window_start").alias("day_of_week"),
        )
        .agg(
            F.avg(value).alias("typical_demand"),
            F.percentile_approx(value, 0.75).alias("demand_p75"),
        )
    )


#: Values up to which a sketch of one group is exact; beyond, ranks are within about 0.7 % of the group.
SKETCH_SIZE = 400
STATE_KEYS = ("pickup_h3", "hour_of_day", "day_of_week")


def typical_state(rows: DataFrame, value: str = "predicted_demand") -> DataFrame:
    """Per date, cell and slot: number, exact sum, and a quantile sketch of ``value``.

    A date's rows make its state alone, so a new or corrected date replaces its own state
    and the history isn't read again.
    """
    number = F.col(value).cast("double")
    return (
        rows.filter(F.col("pickup_h3").isNotNull())
        .groupBy(
            F.to_date("window_start").alias("window_start_date"),
            "pickup_h3",
            F.hour("window_start").alias("hour_of_day"),
            F.dayofweek("window_start").alias("day_of_week"),
        )
        .agg(
            F.count(value).alias("n"),
            # Decimals add up to the same in any order.
            F.sum(number.cast("decimal(28,10)")).alias("total"),
            F.kll_sketch_agg_double(number, F.lit(SKETCH_SIZE)).alias("sketch"),
        )
    )


def merged_typical(states: DataFrame) -> DataFrame:
    """Typical demand from the states of any number of dates, one row per cell and slot."""
    merged = states.groupBy(*STATE_KEYS).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch")
    )
    return merged.select(
        *STATE_KEYS,
        F.when(F.col("n") > 0, F.col("total").cast("double") / F.col("n")).alias("typical_demand"),
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.75))).alias("demand_p75"),
    )
