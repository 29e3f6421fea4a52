"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid import session

#: A doc_id whose crc32 modulo 4 is this is held out of every fit.
HELD_OUT = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the whole text (null: empty) and the named further columns; all others are left behind."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: later steps never recompute it."""
    path = session.scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is held out of fits, from its id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == HELD_OUT


def parts(batches: Iterable[pa.RecordBatch], most: int = 4_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in parts of about ``most`` bytes of text, so that memory has a bound."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_numpy(zero_copy_only=False)
        at = np.cumsum(np.nan_to_num(sizes)) // most
        edges = [0, *(np.nonzero(np.diff(at))[0] + 1).tolist(), batch.num_rows]
        for first, after in zip(edges, edges[1:]):
            if after > first:
                yield batch.slice(first, after - first)


ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
}


def batch_of(ddl: str, *columns: Sequence) -> pa.RecordBatch:
    """A record batch of the schema ``name type, ...`` from its columns."""
    fields = [field.split(" ") for field in ddl.split(", ")]
    arrays = [pa.array(values, ARROW[kind], from_pandas=False) for values, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def rows_of(ddl: str, rows: list[tuple]) -> pa.RecordBatch:
    """The same from rows."""
    return batch_of(ddl, *(zip(*rows) if rows else [[] for _ in ddl.split(", ")]))
