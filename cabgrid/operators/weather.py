"""Hourly weather: one row per place and hour, with classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.functions import scalars

MEASURES = ("temp_2m", "precip", "rain", "snow", "wind")


def explode_hours(landed: DataFrame) -> DataFrame:
    """Parallel hourly arrays to one row per place and hour."""
    hours = F.arrays_zip("time", *MEASURES)
    return landed.select("borough", F.inline(hours))


def classify(hours: DataFrame) -> DataFrame:
    """Add rain and snow flags, weather type and temperature bucket."""
    return hours.withColumns(
        {
            "is_raining": scalars.is_raining("rain"),
            "is_snowing": scalars.is_snowing("snow"),
            "weather_type": scalars.weather_type("rain", "snow"),
            "temp_bucket": scalars.temp_bucket("temp_2m"),
        }
    )


def one_per_hour(hours: DataFrame) -> DataFrame:
    """One row per place and hour where landed files overlap.

    The row with the most measures wins, of those the one with the greater
    measures, compared in the order of ``MEASURES``.
    """
    known = sum((F.col(m).isNotNull().cast("int") for m in MEASURES), F.lit(0))
    best = F.max(F.struct(known.alias("known"), *MEASURES)).alias("best")
    return hours.groupBy("borough", "time").agg(best).select("borough", "time", *[f"best.{m}" for m in MEASURES])


def repeated_hours(landed: DataFrame) -> DataFrame:
    """Hours of a place that landed more than once, with how often."""
    hours = explode_hours(landed).groupBy("borough", "time").agg(F.count("*").alias("row_count"))
    return hours.filter("row_count > 1")


def hourly_weather(landed: DataFrame) -> DataFrame:
    """The weather table, one row per place and hour."""
    return classify(one_per_hour(explode_hours(landed)))


def missing_places(places: DataFrame, landed: DataFrame) -> DataFrame:
    """Places for which no hours arrived."""
    arrived = landed.filter(F.size("time") > 0).select("borough").distinct()
    return places.join(arrived, "borough", "left_anti")
