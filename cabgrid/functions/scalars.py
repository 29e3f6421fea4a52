"""Small column helpers: tolerant casts, weather classes, scores, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabgrid.config import Box, Weights
from cabgrid.functions.hexgrid import double

# Thresholds in mm and cm, temperatures in degrees Celsius.
MEASURABLE_RAIN = 0.1
MEASURABLE_SNOW = 0.1
FREEZING_UP_TO = 0.0
COLD_BELOW = 15.0
MODERATE_BELOW = 25.0


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def in_box(lat: Column | str, lon: Column | str, box: Box) -> Column:
    """Whether a point lies in the closed box; NULL coordinates give NULL."""
    return _col(lat).between(box.lat_min, box.lat_max) & _col(lon).between(box.lon_min, box.lon_max)


def whole_number_sql(value: str) -> str:
    """Whole part of a number, also where text writes it with a point; NULL where there is none."""
    return f"try_cast(try_cast({value} AS DOUBLE) AS INT)"


def whole_number(value: str) -> Column:
    return F.expr(whole_number_sql(f"`{value}`"))


def zero_if_none(value: str) -> Column:
    """Whole part of a number; NULL, NaN and unreadable text become 0."""
    return F.coalesce(whole_number(value), F.lit(0))


def safe_int_sql(value: str) -> str:
    return f"coalesce(try_cast({value} AS INT), 0)"


def safe_int(value: str) -> Column:
    """Integer value; NULL, NaN and unreadable text become 0."""
    return F.expr(safe_int_sql(f"`{value}`"))


def number_or_null(value: Column | str) -> Column:
    """Double value; unreadable text becomes NULL."""
    return _col(value).try_cast("double")


def is_raining(rain: Column | str) -> Column:
    return F.when(_col(rain) > MEASURABLE_RAIN, 1).otherwise(0)


def is_snowing(snow: Column | str) -> Column:
    return F.when(_col(snow) > MEASURABLE_SNOW, 1).otherwise(0)


def weather_type(rain: Column | str, snow: Column | str) -> Column:
    """Snow over Rain over Clear; Clear needs both measurements."""
    return (
        F.when(_col(snow) > MEASURABLE_SNOW, "Snow")
        .when(_col(rain) > MEASURABLE_RAIN, "Rain")
        .when(_col(snow).isNotNull() & _col(rain).isNotNull(), "Clear")
    )


def temp_bucket(temp: Column | str) -> Column:
    """Temperature class; an unknown temperature has no class."""
    return (
        F.when(_col(temp) <= FREEZING_UP_TO, "Freezing")
        .when(_col(temp) < COLD_BELOW, "Cold")
        .when(_col(temp) < MODERATE_BELOW, "Moderate")
        .when(_col(temp).isNotNull(), "Hot")
    )


def charger_score(counts: list[tuple[str, str]], weights: Weights) -> Column:
    """Weighted charger count over the nearest stations, given as (fast, level 2) columns.

    Every station needs a discount of its own: a different number of both is an error.
    """
    if len(counts) != len(weights.by_priority):
        raise ValueError(f"{len(counts)} stations per cell, but {len(weights.by_priority)} discounts by priority")
    parts = [
        f"(coalesce({fast}, 0) * {double(weights.fast)} + coalesce({level2}, 0) * {double(weights.level2)})"
        f" * {double(discount)}"
        for (fast, level2), discount in zip(counts, weights.by_priority)
    ]
    return F.expr(" + ".join(parts))


def min_max(value: str, low: str, high: str, epsilon: float) -> Column:
    """Value scaled to [0, 1] between ``low`` and ``high``."""
    return F.expr(f"({value} - {low}) / ({high} - {low} + {double(epsilon)})")


def final_score(demand: str, distance: str, charger: str, weights: Weights) -> Column:
    """Weighted sum of the three scaled terms; distance counts against a cell."""
    return F.expr(
        f"{double(weights.demand)} * {demand} - {double(weights.distance)} * {distance}"
        f" + {double(weights.charger)} * {charger}"
    )


def shown(value: Column | str, digits: int) -> Column:
    """Round half to even, as answers are displayed."""
    return F.bround(_col(value), digits)
