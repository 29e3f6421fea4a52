"""A corpus from documents to packed sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabgrid import session
from cabgrid.llm import exact_dedup, language_id, mixing, near_dedup, packing
from cabgrid.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those that no learned language explains, go."""
    session.prepare(spark)
    return language_id.accepted(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    session.prepare(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies stays."""
    session.prepare(spark)
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled towards tempered source and language shares."""
    session.prepare(spark)
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is cut into pieces and packed into sequences."""
    session.prepare(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_stage),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't say language ID, near-duplicates and tokens; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
