"""Exact dedup by content sort, in DataFrame operations only.

Rows are range-partitioned by the beginning of their text with splitters that
Spark samples, and each partition is sorted by whole text and then by id, largest
first, outside memory where it must. Each row is compared in full with the row
before it: where texts differ, a run of equal texts begins, and its first row has the largest id.
A hash of the text and one of the id follow the
beginning in the range key: the first tells texts with a common beginning
apart, the second lets a text with very many copies fall into several cells of
neighbouring partitions, each sorted on its own. The runs of a text that splitters cut then meet by
its SHA-256 digest, without texts or ids, to agree on the row that stays.

Cases: a null text equals an empty one. Of equal texts the row with the largest
doc_id stays; a null doc_id stays only where the group has no other. Of rows
that repeat both text and doc_id one counts as kept. An empty table gives no
rows. Columns other than doc_id and text are ignored, and ``drop_exact_copies`` returns
them as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import partitions, stored

#: Characters at the beginning of a text by which splitters are sampled.
BEGINNING = 64


def content(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def cells(docs: DataFrame) -> DataFrame:
    """One row per run of equal texts in a cell: digest, cell number, largest id, number of rows, all ids."""
    n = partitions(docs.sparkSession)
    rows = docs.select("doc_id", content().alias("text")).select(
        "*",
        F.substring("text", 1, BEGINNING).alias("beginning"),
        F.pmod(F.xxhash64("text"), F.lit(1 << 16)).alias("mix"),
        F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("cell"),
    )
    key = ["beginning", "mix", "cell"]
    # The ranges are the window's partitions already, so the window only sorts them.
    in_order = Window.partitionBy(*key).orderBy("text", F.col("doc_id").desc_nulls_last())
    begins = F.coalesce(F.col("text") != F.lag("text").over(in_order), F.lit(True))
    compared = (
        rows.repartitionByRange(n, *key)
        .withColumn("begins", begins)
        .select(*key, "doc_id", F.when(F.col("begins"), F.sha2("text", 256)).alias("text_sha256"), "text", "begins")
        .withColumn("run", F.count_if("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    runs = compared.groupBy(*key, "run").agg(
        F.max("text_sha256").alias("text_sha256"),
        F.max("doc_id").alias("largest"),
        F.count(F.lit(1)).alias("rows"),
        F.collect_list(F.struct("doc_id")).alias("members"),
    )
    return runs.select("text_sha256", "cell", "largest", "rows", "members")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the id that stays, the size of its group, whether it stays, the text's digest."""
    found = stored(cells(docs), "text-cells")
    group = Window.partitionBy("text_sha256")
    agreed = found.select("text_sha256", "cell", "largest", "rows").select(
        "text_sha256",
        "cell",
        F.max("largest").over(group).alias("keep_id"),
        F.sum("rows").over(group).alias("group_size"),
    )
    # Repeated ids are neighbours in a sorted array; only the first of them can stay.
    members = F.transform(
        F.sort_array("members"),
        lambda m, at: F.struct(m["doc_id"].alias("doc_id"), at.alias("at")),
    )
    numbered = found.select("text_sha256", "cell", members.alias("members")).select(
        "text_sha256",
        "cell",
        F.explode(
            F.transform(
                "members",
                lambda m: F.struct(
                    m["doc_id"].alias("doc_id"),
                    F.coalesce(~m["doc_id"].eqNullSafe(F.get("members", m["at"] - 1)["doc_id"]), F.lit(True)).alias("first"),
                    m["at"].alias("at"),
                ),
            )
        ).alias("row"),
    )
    rows = numbered.join(agreed, ["text_sha256", "cell"])
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        "keep_id",
        "group_size",
        ((F.col("row.first") | (F.col("row.at") == 0)) & F.col("row.doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs).filter("kept").select(row_key("doc_id", F.col("text_sha256")).alias("key"))
    return first_rows(docs, kept, F.sha2(content(), 256))


def first_rows(docs: DataFrame, kept: DataFrame, digest: Column) -> DataFrame:
    """One row of ``docs`` for each ``key`` of ``kept``; all columns travel in one struct, so none can clash."""
    rows = docs.select(F.struct("*").alias("row"), row_key("doc_id", digest).alias("key"))
    repeat = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    return (
        rows.join(kept, "key", "left_semi")
        .withColumn("repeat", F.row_number().over(repeat))
        .filter("repeat = 1")
        .select("row.*")
    )


def row_key(doc_id: str, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), digest)
