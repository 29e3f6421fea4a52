"""Explicit schemas of every source; nothing is inferred from files."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names and types of all columns are fixed by the source files.
PLACES = StructType(
    [
        StructField("borough", StringType(), False),
        StructField("lat", DoubleType(), False),
        StructField("lon", DoubleType(), False),
    ]
)

# One record per place, hours as parallel arrays.
WEATHER_LANDED = StructType(
    [
        StructField("borough", StringType()),
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField("time", ArrayType(TimestampType())),
        StructField("temp_2m", ArrayType(DoubleType())),
        StructField("precip", ArrayType(DoubleType())),
        StructField("rain", ArrayType(DoubleType())),
        StructField("snow", ArrayType(DoubleType())),
        StructField("wind", ArrayType(DoubleType())),
    ]
)

# CSV files are read as text; the operators cast.
ZONE_LOOKUP_CSV = StructType([StructField(name, StringType()) for name in ("LocationID", "Borough", "Zone")])

STATIONS_CSV = StructType(
    [
        StructField(name, StringType())
        for name in ("Station Name", "Latitude", "Longitude", "EV DC Fast Count", "EV Level2 EVSE Num")
    ]
)

# One row per ring; ring 0 of a part is its outline, further rings are holes.
ZONE_RINGS = StructType(
    [
        StructField("LocationID", IntegerType()),
        StructField("part", IntegerType()),
        StructField("ring_no", IntegerType()),
        StructField("ring", ArrayType(ArrayType(DoubleType()))),
    ]
)

TRIPS = StructType(
    [
        StructField("trip_id", LongType()),
        StructField("tpep_pickup_datetime", TimestampType()),
        StructField("PULocationID", LongType()),
        StructField("trip_distance", DoubleType()),
        StructField("fare_amount", DoubleType()),
        StructField("average_speed_mph", DoubleType()),
        StructField("tip_percentage", DoubleType()),
        StructField("passenger_count", LongType()),
    ]
)
