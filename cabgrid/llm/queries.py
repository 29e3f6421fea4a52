"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabgrid import session
from cabgrid.llm import (
    exact_dedup,
    fingerprints,
    html_text,
    language_id,
    merkle,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    simhash,
    substring_dedup,
    token_files,
    toxicity,
)
from cabgrid.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return query(spark, sf_dir)

        run.__name__, run.__doc__ = name, query.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


@register("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence of at most 2048 ids and its place there."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register("op2_minhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near-copies and whether it stays."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


@register("op3_document_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that aren't held out."""
    found = language_id.identified(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages")


@register("op5_token_id_planes")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to plane shards and read back from them."""
    return token_files.write_and_read(table(spark, sf_dir, "documents"))


@register("op6_substring_dedup", substring_dedup.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words, how many of them repeat an earlier document, and the rest's digest."""
    found = substring_dedup.cleaned(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@register("op7_exact_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts and the id that stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@register("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that aren't held out."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_mixing", mixing.mixing_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its margins, its calibrated probability, and whether it is kept."""
    return mixing.mixing_rows(table(spark, sf_dir, "documents"))


@register("op11_merkle_manifest", merkle.manifest_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots, proof, and whether the tampered document still verifies."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


@register("op12_simhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the least id of its component of linked fingerprints."""
    return simhash.near_components(table(spark, sf_dir, "documents"))


@register("op13_conversation_trie", prefix_trie.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with its members, leaves and savings."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
