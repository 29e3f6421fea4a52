"""Substring dedup by relative Lempel-Ziv parsing against all earlier documents.

Every document is a reference block for those with a larger id. The index holds
phrases of 13 words. Parsing a document, a factor begins at the first word whose
phrase starts in an earlier block and grows greedily while the next phrase does,
too; what lies between factors is literal. Factors are never shorter than a
phrase, so every word of a factor is a duplicate.

Indexing each phrase on its own would move one row a word. Instead neighbouring
phrases travel as one run: of the five-word grams in a phrase the one with the
least hash is its key (a minimizer), and consecutive phrases with the same key
are a run, some five phrases long. Equal phrases have equal keys wherever they
stand, so two documents can only share phrases of runs with the same key.

1. Runs are hashed whole. Of equal runs in the same part of a batch only the one
   with the smallest id is moved on; the others are known to repeat it.
2. Runs meet by key. Keys that occur in one document only go. A run whose words
   occur whole in an earlier document is part of a factor.
3. At factor boundaries a run repeats an earlier document in part: keys with
   several different runs are looked at phrase by phrase, one run for each
   wording, again with one row per part and phrase.
4. Runs and phrases found are merged to factors per document.

Phrases count as equal when the 64-bit hashes of their key and of their words
are both equal.

Cases: a null text has no words; texts under 13 words have no phrase; copies
within one document or under the same id are no duplicates; a row without id is
neither changed nor a reference; repeated rows give a row each; an empty table
gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import batch_of, partitions, parts, rows_of, stored, texts
from cabgrid.llm.words import Rolling, as_long, mixed, split, words_of

PHRASE = 13
GRAM = 5
RUNS = "key long, run long, doc_id long, start int, phrases int, known boolean"
PHRASES = "phrase long, doc_id long, start int, known boolean"
CLEANED = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, spans array<int>"


def least_grams(gram: np.ndarray) -> np.ndarray:
    """For each phrase, by its first word: the place of its gram with the least hash, the leftmost of equals."""
    n, width = len(gram), PHRASE - GRAM + 1
    bits = np.uint64(max(1, n - 1).bit_length())
    least = (mixed(gram) >> bits << bits) | np.arange(n, dtype=np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    rest = width - span
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least & mask).astype(np.int64)


def first_of_equals(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> np.ndarray:
    """Whether a row has the least id among the rows with equal keys."""
    order = np.lexsort((doc, *keys))
    same = np.ones(max(0, len(doc) - 1), dtype=bool)
    for k in keys:
        same &= np.diff(k[order]) == 0
    new = np.append([True], ~same)[: len(doc)]
    least = doc[order][new][np.cumsum(new) - 1]
    out = np.empty(len(doc), dtype=bool)
    out[order] = doc[order] == least
    return out


def runs_in(doc_ids: np.ndarray, found: list[str]) -> tuple[np.ndarray, ...]:
    """Columns of RUNS for some documents."""
    words = words_of(found)
    n = len(words.hashes)
    empty = tuple(np.zeros(0, np.int64) for _ in range(5)) + (np.zeros(0, bool),)
    if n < PHRASE:
        return empty
    rolling = Rolling(words.hashes)
    gram = rolling.of(np.arange(n - GRAM + 1), GRAM)
    key_at = least_grams(gram)
    at = np.nonzero(words.end[words.of[: n - PHRASE + 1]] - np.arange(n - PHRASE + 1) >= PHRASE)[0]
    if not len(at):
        return empty
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(key_at[at]) != 0) | (np.diff(at) != 1) | (np.diff(words.of[at]) != 0)
    edge = np.nonzero(new)[0]
    phrases = np.diff(np.append(edge, len(at)))
    begin = at[edge]
    run = rolling.of(begin, phrases + PHRASE - 1)
    key = gram[key_at[begin]]
    doc = doc_ids[words.of[begin]]
    first = first_of_equals((run, key), doc)
    # A known repeat needs no partner; a key of its own spreads it evenly.
    own = mixed(run ^ mixed(doc.astype(np.uint64)) ^ begin.astype(np.uint64))
    key = np.where(first, key, own)
    return as_long(key), as_long(run), doc, begin - words.begin[words.of[begin]], phrases, ~first


def runs(docs: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc_ids, found = batch.columns
            yield batch_of(RUNS, *runs_in(doc_ids.to_numpy(), found.to_pylist()))

    return texts(docs).filter("doc_id IS NOT NULL").mapInArrow(emit, RUNS)


def shared_runs(docs: DataFrame) -> DataFrame:
    """Runs whose key occurs in several documents, with the smallest id among equal runs."""
    n = partitions(docs.sparkSession)
    by_key, by_run = Window.partitionBy("key"), Window.partitionBy("key", "run")
    met = runs(docs).repartition(n, "key").select(
        "*", F.min("doc_id").over(by_run).alias("first"), F.min("doc_id").over(by_key).alias("low"),
        F.max("doc_id").over(by_key).alias("high"), F.min("run").over(by_key).alias("one"),
        F.max("run").over(by_key).alias("other"),
    )
    return met.filter("known OR low < high").select(
        "doc_id", "start", "phrases", (F.col("known") | (F.col("doc_id") > F.col("first"))).alias("repeats"),
        ((F.col("doc_id") == F.col("first")) & (F.col("one") != F.col("other")) & ~F.col("known")).alias("boundary"),
    )


def boundary_phrases(docs: DataFrame, runs_of: DataFrame) -> DataFrame:
    """The phrases of the listed runs that start in an earlier document, too."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc_ids, found, starts, counts = batch.columns
            words = words_of(found.to_pylist())
            rolling = Rolling(words.hashes)
            sizes = pc.list_value_length(starts).to_numpy()
            text = np.repeat(np.arange(batch.num_rows), sizes)
            first, count = (x.flatten().to_numpy().astype(np.int64) for x in (starts, counts))
            of = np.repeat(text, count)
            start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            phrase = rolling.of(words.begin[of] + start, PHRASE)
            doc = doc_ids.to_numpy()[of]
            least = first_of_equals((phrase,), doc)
            yield batch_of(PHRASES, as_long(np.where(least, phrase, mixed(phrase ^ doc.astype(np.uint64)))), doc, start, ~least)

    wanted = docs.join(runs_of, "doc_id", "left").filter("starts IS NOT NULL").select("doc_id", "text", "starts", "counts")
    met = wanted.mapInArrow(emit, PHRASES).withColumn("first", F.min("doc_id").over(Window.partitionBy("phrase")))
    return met.filter("known OR doc_id > first").select("doc_id", "start", F.lit(1).alias("phrases"))


def per_document(rows: DataFrame) -> DataFrame:
    """Starts and numbers of phrases as arrays, one row per document."""
    lists = rows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "phrases")).alias("runs"))
    return lists.select("doc_id", F.col("runs.start").alias("starts"), F.col("runs.phrases").alias("counts"))


def cover(n: int, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which of ``n`` words some phrase covers."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts + PHRASE - 1, -1)
    return np.cumsum(change[:n]) > 0


def cleaned(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Each document with the words of its factors removed, and the factors as pairs of first word and length.

    ``kept_text`` joins the kept words by one blank; it is null without ``with_text``.
    """
    n = partitions(docs.sparkSession)
    shared = stored(shared_runs(docs), "shared-runs")
    # Both joins below read the same exchange of the texts.
    dealt = texts(docs).filter("doc_id IS NOT NULL").repartition(n, "doc_id")
    no_id = texts(docs).filter("doc_id IS NULL")
    found = boundary_phrases(dealt, per_document(shared.filter("boundary")))
    repeats = shared.filter("repeats").select("doc_id", "start", "phrases")
    factors = per_document(repeats.unionByName(found))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows = []
            starts, counts = batch.column("starts"), batch.column("counts")
            for at, (doc_id, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")))):
                words = split(text)
                spans: list[int] = []
                kept = words
                if starts[at].is_valid:
                    gone = cover(len(words), *(x[at].values.to_numpy().astype(np.int64) for x in (starts, counts)))
                    kept = [w for w, out in zip(words, gone.tolist()) if not out]
                    edges = np.nonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))[0]
                    spans = np.stack([edges[::2], edges[1::2] - edges[::2]], axis=1).ravel().tolist()
                joined = b" ".join(kept)
                rest = joined.decode("utf-8", "surrogatepass") if with_text else None
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), rest, spans))
            yield rows_of(CLEANED, rows)

    columns = ["doc_id", "text", "starts", "counts"]
    none = no_id.select("*", *(F.lit(None).cast("array<int>").alias(c) for c in columns[2:]))
    joined = dealt.join(factors, "doc_id", "left").select(*columns)
    return joined.mapInArrow(emit, CLEANED).unionByName(none.mapInArrow(emit, CLEANED))


#: The digest columns over ``documents``, in DuckDB SQL.
SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), phrases AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)
), repeats AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY phrase) AS first FROM phrases) WHERE first < doc_id
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM repeats) GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
         [w[x] FOR x IN range(1, len(w) + 1) IF ps IS NULL OR NOT list_contains(ps, x)] AS words
  FROM docs LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""
