"""Lookup tables that answer by slot and cell without a shuffle.

Folders are slots, and within each the rows lie in buckets of the key, sorted by it. A
join that knows the slots asked for lists only their folders, and one by the key
finds each bucket whole, so the table is never exchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cabgrid.sinks import writers

KEY = "origin_h3"


def write(df: DataFrame, path: str, buckets: int, key: str = KEY) -> None:
    """Write ``df`` to the new folder ``path``: a folder per slot, in it at most one file per bucket of ``key``.

    Spark writes buckets only of tables, so a name of its own stands for the
    folder during the write; it is forgotten afterwards and the files stay.
    """
    name = f"lookup_{uuid.uuid4().hex}"
    try:
        (
            # The hash that deals rows to partitions is the one that picks the bucket.
            df.repartition(buckets, key)
            .write.partitionBy(*writers.SLOT_COLUMNS)
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", path)
            .format("parquet")
            .saveAsTable(name)
        )
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _bucketed(spark: SparkSession, name: str, buckets: int, key: str) -> bool:
    about = writers.described(spark, name)
    return about.get("Num Buckets") == str(buckets) and about.get("Bucket Columns") == f"[`{key}`]"


def publish(spark: SparkSession, name: str, path: str, buckets: int, key: str = KEY) -> DataFrame:
    """Let the table ``name`` stand for the folder that ``write`` made with the same ``buckets`` and ``key``.

    Where the table has these columns and buckets already, one change of its location
    does it. A name that stands for anything but an external table is refused.
    """
    quoted = writers.quoted(name)
    if spark.catalog.tableExists(name):
        writers.refuse_unless_external(spark, name)
        if writers.same_layout(spark, name, path) and _bucketed(spark, name, buckets, key):
            return writers.move(spark, name, path)
        spark.sql(f"DROP TABLE {quoted}")
    fields = spark.read.parquet(path).schema.fields
    columns = ", ".join(f"{writers.quoted_part(f.name)} {f.dataType.simpleString()}" for f in fields)
    writers.create(
        spark,
        f"CREATE TABLE {quoted} ({columns}) USING parquet PARTITIONED BY ({', '.join(writers.SLOT_COLUMNS)}) "
        f"CLUSTERED BY ({writers.quoted_part(key)}) SORTED BY ({writers.quoted_part(key)}) INTO {int(buckets)} BUCKETS",
        path,
    )
    return spark.table(name)
