"""Readers: tables by name or path, CSV text, landed weather files, places."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cabgrid import schemas
from cabgrid.config import WEATHER_PLACES


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table or view."""
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet folder, partitioned or flat."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_slots(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by hour and day of week, with both as integers."""
    return spark.read.parquet(path).withColumns(
        {"hour_of_day": F.col("hour_of_day").cast("int"), "day_of_week": F.col("day_of_week").cast("int")}
    )


def read_csv_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, every field as text."""
    return spark.read.schema(schema).option("header", True).csv(path)


class CsvRows(NamedTuple):
    """Rows of a CSV file: those with a field for each column, and the others as ``(file, record)`` in their own words."""

    rows: DataFrame
    rejects: DataFrame


def read_csv_rows(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> CsvRows:
    """CSV, every field as text, with rows of too few or too many fields set apart.

    ``read_csv_text`` fills up a short row with NULLs and cuts a long one.
    Empty lines are no rows. Both results parse whole lines, because a pruned
    reader doesn't count fields.
    """
    broken = "_corrupt_record"
    while broken in schema.fieldNames():
        broken += "_"
    whole = StructType([*schema.fields, StructField(broken, StringType())])
    read = (
        spark.read.schema(whole)
        .options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=broken, columnPruning=False)
        .csv(path)
    )
    # Spark refuses to read the record alone, so each filter names the columns; it is always true for them.
    named = F.length(F.concat_ws("", *[F.col(f"`{name}`") for name in schema.fieldNames()])) >= 0
    rows = read.filter(F.col(broken).isNull() & named).drop(broken)
    rejects = read.filter(F.col(broken).isNotNull() & named).select(
        F.col("_metadata.file_path").alias("file"), F.col(broken).alias("record")
    )
    return CsvRows(rows, rejects)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_text(spark, path, schemas.ZONE_LOOKUP_CSV)


def read_stations_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_text(spark, path, schemas.STATIONS_CSV)


def read_zone_lookup_rows(spark: SparkSession, path: str) -> CsvRows:
    return read_csv_rows(spark, path, schemas.ZONE_LOOKUP_CSV)


def read_stations_rows(spark: SparkSession, path: str) -> CsvRows:
    return read_csv_rows(spark, path, schemas.STATIONS_CSV)


def read_weather_landed(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as landed from a weather service, one place per record."""
    return spark.read.schema(schemas.WEATHER_LANDED).json(path)


def read_zone_rings(spark: SparkSession, path: str) -> DataFrame:
    """Zone outlines as rings of (longitude, latitude)."""
    return spark.read.schema(schemas.ZONE_RINGS).parquet(path)


def weather_places(
    spark: SparkSession, places: Iterable[tuple[str, float, float]] = WEATHER_PLACES
) -> DataFrame:
    """The places for which hourly weather is kept."""
    return spark.createDataFrame(list(places), schemas.PLACES)
