"""Model features: demand series joined with borough and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.config import Settings
from cabgrid.operators.demand import AVERAGES
from cabgrid.operators.series import calendar_lags, dense_lags, lag_name, row_lags

WEATHER_NUMBERS = ("temp_2m", "rain", "snow", "wind", "is_raining", "is_snowing")


def add_borough(demand: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough of the pickup zone; zone ids may be text in ``zones``.

    Of a zone listed more than once the first borough in the alphabet counts,
    so a repeat never multiplies demand.
    """
    lookup = zones.groupBy(F.col("LocationID").try_cast("bigint").alias("pickup_zone_id")).agg(
        F.min("Borough").alias("borough")
    )
    return demand.join(lookup, "pickup_zone_id", "left")


def add_weather(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of the borough in the hour a window starts."""
    hours = weather.withColumnRenamed("time", "weather_hour")
    return demand.withColumn("weather_hour", F.date_trunc("hour", "window_start")).join(
        hours, ["borough", "weather_hour"], "left"
    )


def add_slot(df: DataFrame, hour: str = "hour_of_day", day: str = "day_of_week") -> DataFrame:
    """Hour 0..23 and day of week 1..7, Sunday first, of ``window_start``."""
    return df.withColumns({hour: F.hour("window_start"), day: F.dayofweek("window_start")})


def lag_names(settings: Settings) -> list[str]:
    """Lag columns in the order of the settings."""
    return [lag_name(n) for n in settings.row_lags]


def lagged(demand: DataFrame, settings: Settings) -> DataFrame:
    """Target and lags by ``settings.lag_kind``; the columns have the same names for every kind."""
    if settings.lag_kind == "rows":
        return row_lags(demand, settings.row_lags)
    if settings.lag_kind == "calendar":
        step = window_seconds(settings)
        back = {n: n * step for n in settings.row_lags}
        # Looked back over before the next window is added, so both keep their own layout.
        earlier = calendar_lags(demand, list(back.values()))
        keys = [c for c in demand.columns if c in ("window_start", "pickup_zone_id", "pickup_h3")]
        named = earlier.select(*keys, *[F.col(f"demand_{s}s_ago").alias(lag_name(n)) for n, s in back.items()])
        return row_lags(demand, ()).join(named, keys)
    if settings.lag_kind == "dense":
        return dense_lags(demand, settings.row_lags, window_seconds(settings))
    raise ValueError(f"no kind of lags is called {settings.lag_kind}")


def window_seconds(settings: Settings) -> int:
    """Length of a demand window, given as ``<n> minutes`` or ``<n> seconds``."""
    number, unit = settings.window.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]


def demand_features(
    demand: DataFrame, zones: DataFrame, weather: DataFrame, settings: Settings
) -> DataFrame:
    """Feature rows with target. The series is shuffled while it is narrow, lookups follow."""
    rows = lagged(demand, settings).filter(F.col("target_pickup_count").isNotNull())
    joined = add_weather(add_borough(rows, zones), weather)
    filled = [*AVERAGES.values(), *WEATHER_NUMBERS, *lag_names(settings)]
    return add_slot(joined, "window_start_hour", "day_of_week").na.fill(0, subset=filled)
