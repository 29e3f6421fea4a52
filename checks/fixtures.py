"""The inputs of the analysis, derived from the given test tables.

Each function returns one input table as a DataFrame. ``oracle.py`` derives the
same inputs in SQL.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid.config import ModelConfig, Settings

SETTINGS = replace(Settings(), model=ModelConfig(cutoff="2024-01-22"))
HOURS = 720
#: Places whose hours one task makes, about 360,000 rows.
PLACES_A_TASK = 500

# Outlines in unit coordinates by kind: (kind, part, ring_no, vertices).
SHAPES = [
    (0, 0, 0, [(0.0, 0.0), (1.0, 0.0), (1.0, 0.4), (0.45, 0.4), (0.45, 1.0), (0.0, 1.0)]),
    (1, 0, 0, [(0.0, 0.0), (0.8, 0.1), (0.3, 0.9)]),
    (1, 1, 0, [(0.5, 0.3), (1.6, 0.5), (0.9, 1.3)]),
    (2, 0, 0, [(0.0, 0.0), (1.1, 0.05), (1.0, 1.1), (-0.1, 0.95)]),
    (2, 0, 1, [(0.3, 0.3), (0.35, 0.75), (0.8, 0.7), (0.7, 0.25)]),
    (3, 0, 0, [(0.0, 0.0), (0.02, 0.004), (0.006, 0.03)]),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return trips_from_events(table(spark, sf, "events"))


def trips_from_events(events: DataFrame) -> DataFrame:
    """Trips of three kinds by number: from one busy stand, in rushes of six hours, and scattered.

    The stand gives a long series, the rushes give windows with many pickups.
    Some scattered trips have a zone without cells or none at all.
    """
    user, kind, ts = F.col("user_id") % 27, F.col("event_id") % 5, F.col("ts").cast("timestamp")
    zone = (
        F.when(kind < 2, 1)
        .when(F.col("event_id") % 100 == 4, 263)
        .when((F.col("event_id") % 100 == 9), F.lit(None))
        .when(user == 25, 264)
        .when(user == 26, 265)
        .otherwise(user + 1)
    )
    rush = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / 21600) * 21600)
    return events.select(
        F.col("event_id").alias("trip_id"),
        F.when(kind.isin(2, 3), rush).otherwise(ts).alias("tpep_pickup_datetime"),
        zone.cast("bigint").alias("PULocationID"),
        (F.col("value") / 4).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        (F.col("event_id") % 30 + 5).cast("double").alias("average_speed_mph"),
        (F.col("event_id") % 31).cast("double").alias("tip_percentage"),
        (F.col("event_id") % 4 + 1).cast("bigint").alias("passenger_count"),
    )


def trip_key() -> Column:
    """The stand is one cell, rushes go to two cells of a zone, the rest to all."""
    kind = F.col("trip_id") % 5
    return F.when(kind < 2, F.lit(0)).when(kind < 4, F.floor(F.col("trip_id") / 5) % 2).otherwise(F.col("trip_id") * 7919)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        (F.col("n_nationkey") + 1).alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
    )


def _ring(*corners: tuple[Column, Column]) -> Column:
    return F.array(*[F.array(x, y) for x, y in corners])


def zone_rings(spark: SparkSession, sf: str) -> DataFrame:
    """A block of 5 x 5 rectangles; the last zone is too small to hold a cell centre."""
    n = F.col("n_nationkey")
    x0 = F.lit(-74.00) + F.lit(0.02) * (n % 5)
    y0 = F.lit(40.70) + F.lit(0.015) * F.floor(n / 5)
    width = F.when(n == 24, 0.0005).otherwise(0.02)
    height = F.when(n == 24, 0.0005).otherwise(0.015)
    return (
        table(spark, sf, "nation")
        .select((n + 1).alias("LocationID"), x0.alias("x0"), y0.alias("y0"), width.alias("w"), height.alias("h"))
        .select(
            "LocationID",
            F.lit(0).alias("part"),
            F.lit(0).alias("ring_no"),
            _ring(
                (F.col("x0"), F.col("y0")),
                (F.col("x0") + F.col("w"), F.col("y0")),
                (F.col("x0") + F.col("w"), F.col("y0") + F.col("h")),
                (F.col("x0"), F.col("y0") + F.col("h")),
            ).alias("ring"),
        )
    )


def supplier_rings(spark: SparkSession, sf: str) -> DataFrame:
    """One concave, two-part, holed or tiny outline per supplier."""
    shapes = spark.createDataFrame(
        [(kind, part, no, [list(v) for v in ring]) for kind, part, no, ring in SHAPES],
        "kind int, part int, ring_no int, unit array<array<double>>",
    )
    k = F.col("s_suppkey")
    placed = table(spark, sf, "supplier").select(
        k.cast("int").alias("LocationID"),
        (k % 4).cast("int").alias("kind"),
        (F.lit(-74.05) + ((k * 53) % 97) * F.lit(0.003) + F.lit(0.00037)).alias("cx"),
        (F.lit(40.58) + ((k * 37) % 89) * F.lit(0.0031) + F.lit(0.00053)).alias("cy"),
        (F.lit(0.011) + (k % 7) * F.lit(0.002)).alias("a"),
    )
    return placed.join(shapes, "kind").select(
        "LocationID",
        "part",
        "ring_no",
        F.transform(
            "unit",
            lambda v: F.array(
                F.col("cx") + F.col("a") * (v[0] + F.lit(0.13) * v[1]),
                F.col("cy") + F.col("a") * v[1],
            ),
        ).alias("ring"),
    )


def _weather(places: DataFrame) -> DataFrame:
    """Hourly arrays for places ``(borough, b, lat, lon)``; some hours and temperatures are missing."""
    b = F.col("b")
    hours = F.filter(F.sequence(F.lit(0), F.lit(HOURS - 1)), lambda i: i % 101 != 0)

    def each(fn) -> Column:
        return F.transform("i", fn)

    def rain(i: Column) -> Column:
        return ((i * 3 + b) % 10) / F.lit(10.0)

    def snow(i: Column) -> Column:
        return F.when((i + b) % 17 == 0, F.lit(0.5)).otherwise(F.lit(0.0))

    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return places.withColumn("i", hours).select(
        "borough",
        "lat",
        "lon",
        each(lambda i: F.timestamp_seconds(F.unix_timestamp(start) + i * 3600)).alias("time"),
        each(lambda i: F.when(i % 97 != 0, ((i * 7 + b * 11) % 45 - 10).cast("double"))).alias("temp_2m"),
        each(lambda i: rain(i) + snow(i)).alias("precip"),
        each(rain).alias("rain"),
        each(snow).alias("snow"),
        each(lambda i: ((i + b * 5) % 40).cast("double")).alias("wind"),
    )


def region_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Landed weather per borough; one borough landed twice, the second time without temperatures."""
    region = table(spark, sf, "region")
    landed = _weather(
        region.select(
            F.col("r_name").alias("borough"),
            F.col("r_regionkey").cast("bigint").alias("b"),
            (F.lit(40.6) + F.col("r_regionkey") * F.lit(0.05)).alias("lat"),
            F.lit(-73.9).alias("lon"),
        )
    )
    again = landed.filter(F.col("lat") < 40.62)
    none = F.transform("temp_2m", lambda t: F.lit(None).cast("double"))
    return landed.unionByName(again.withColumn("temp_2m", none))


def supplier_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Landed weather per supplier, a larger set of places."""
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    # A small file of suppliers is one task and makes 712 hours a row, so the rows are dealt out first, by turns as
    # names may repeat or be NULL; a stated number of partitions isn't merged again. The count reads footers only.
    supplier = supplier.repartition(supplier.count() // PLACES_A_TASK + 1)
    return _weather(
        supplier.select(
            F.col("s_name").alias("borough"),
            F.col("s_suppkey").alias("b"),
            (F.lit(40.6) + (F.col("s_suppkey") % 7) * F.lit(0.05)).alias("lat"),
            F.lit(-73.9).alias("lon"),
        )
    )


def stations_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Station file as text with its key: repeated coordinates, counts written in several ways, one broken row."""
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        k.cast("string").alias("station_key"),
        F.col("s_name").alias("Station Name"),
        (F.lit(40.60) + ((k % 80 * 37) % 100) * F.lit(0.005)).cast("string").alias("Latitude"),
        (F.lit(-74.10) + ((k % 80 * 53) % 100) * F.lit(0.005)).cast("string").alias("Longitude"),
        F.when(k % 5 != 0, (k % 4).cast("string")).alias("EV DC Fast Count"),
        F.when(k % 11 == 0, "2.0")
        .when(k % 13 == 0, "3.7")
        .when(k % 17 == 0, " 4 ")
        .when(k % 19 == 0, "nan")
        .when(k % 6 != 0, (k % 7).cast("string"))
        .alias("EV Level2 EVSE Num"),
    )
    broken = spark.createDataFrame([("-1", "broken row", "n/a", "-73.9", "1", "x")], rows.schema)
    return rows.unionByName(broken)


def station_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The station file line by line; every 23rd lacks its last two fields, every 29th has one more."""
    rows = stations_csv(spark, sf)
    k = F.col("station_key").cast("int")
    fields = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in rows.columns]
    line = F.when(k % 23 == 0, F.concat_ws(",", *fields[:4])).otherwise(F.concat_ws(",", *fields))
    return rows.select(F.when(k % 29 == 0, F.concat(line, F.lit(",more"))).otherwise(line).alias("value"))


def station_key() -> Column:
    return F.col("station_key")


def driver_points(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("driver_id"),
        (F.lit(40.38) + ((k * 41) % 100) * F.lit(0.006)).alias("lat"),
        (F.lit(-74.02) + ((k * 59) % 100) * F.lit(0.0015)).alias("lon"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp")) + k * 3600).alias("ts"),
    )
