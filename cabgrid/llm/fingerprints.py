"""Document fingerprints by locally consistent parsing.

A text is parsed level by level, starting from its code points. Runs of one
symbol become one symbol. Then every symbol gets a label by deterministic coin
tossing: twice the lowest bit in which it differs from its left neighbour, plus
its own value there; repeated four times, labels shrink to 0 to 5 and neighbours
still differ. A phrase begins at each local maximum of the labels, and its name,
a hash of its symbols, is a symbol of the next level. Where a phrase begins
depends on a few neighbours only, so equal substrings get equal phrase names
inside, wherever they stand.

The fingerprint keeps, for each of ``LEVELS``, the ``KEPT`` least distinct
names (32 bits in hex). Likeness of two fingerprints is, level by level, the
share of common names among the least of both together, an estimate of the
Jaccard index, averaged over the levels.

Neighbours in doc_id order are brought together without a global sort in one
task: splitters cut the ids into ranges, each range is sorted on its own, and
the first row of a range is copied to the range that precedes it.

Cases: a null text is an empty one; an empty text has empty names, alike to an
empty text only. Equal ids follow one another in text order, null ids come last.
A single row is its own next. An empty table gives no rows. Columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import partitions, parts, rows_of, texts
from cabgrid.llm.words import BASE, INVERSE, mixed

LEVELS = (2, 3, 4)
KEPT = 16
#: Code points parsed at once.
AT_ONCE = 400_000
U = np.uint64
PRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
ONE = U(1)


def tossed(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing; the first symbol of a text is told from its complement."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[first] = ~x[first]
    differ = x ^ left
    bit = np.bitwise_count((differ & (~differ + x.dtype.type(1))) - x.dtype.type(1))
    return 2 * bit + ((x >> bit.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)


def phrase_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where phrases begin: at texts' first symbols and local maxima of their labels, the last symbol never."""
    label = tossed(symbols, first)
    for _ in range(3):
        label = tossed(label, first)
    top = np.zeros(len(label), dtype=bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    top[first[1:] - 1] = False
    top[first] = True
    return np.nonzero(top)[0]


class Powers:
    """Powers of the rolling hash's base and of its inverse, made once per worker."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, AT_ONCE)
            made = []
            for base in (BASE, INVERSE):
                power = np.full(size, U(base))
                power[0] = 1
                made.append(np.cumprod(power, dtype=U))
            self.up, self.down = made
        return self.up[:n], self.down[:n]


POWERS = Powers()


def named(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of the phrases that begin at ``starts`` and reach to the next one."""
    up, down = POWERS.get(len(symbols))
    total = np.add.reduceat(symbols * up, starts) * down[starts]
    return mixed(total + np.diff(np.append(starts, len(symbols))).astype(U))


def next_level(symbols: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the next level and the text of each."""
    new = np.append([True], (symbols[1:] != symbols[:-1]) | (of[1:] != of[:-1]))[: len(symbols)]
    start = np.nonzero(new)[0]
    length = np.diff(np.append(start, len(symbols)))
    symbols, of = symbols[start], of[start]
    again = length > 1
    symbols[again] = mixed(symbols[again] + length[again].astype(U) * U(BASE))
    first = np.nonzero(np.append([True], of[1:] != of[:-1]))[0]
    start = phrase_starts(symbols, first)
    return named(symbols, start), of[start]


def least_names(names: np.ndarray, of: np.ndarray, n: int) -> list[np.ndarray]:
    """The least distinct 32-bit names of each of ``n`` texts, ascending."""
    short = (of.astype(U) << U(32)) | (names >> U(32))
    short = np.unique(short)
    at = np.searchsorted(short, np.arange(n + 1, dtype=U) << U(32))
    low = (short & U(0xFFFFFFFF)).astype(np.uint32)
    return [low[a : min(b, a + KEPT)] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def fingerprints(found: list[str]) -> list[tuple[np.ndarray, ...]]:
    """For each text, the kept names of each level."""
    sizes = np.array([len(t) for t in found], dtype=np.int64)
    points = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U)
    of = np.repeat(np.arange(len(found)), sizes)
    out = []
    for level in range(1, max(LEVELS) + 1):
        if len(points):
            points, of = next_level(points, of)
        if level in LEVELS:
            out.append(least_names(points, of, len(found)))
    return list(zip(*out))


def written(names: tuple[np.ndarray, ...]) -> str:
    return "-".join(x.astype(">u4").tobytes().hex() for x in names)


def likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """From 0 (nothing in common) to 1 (equal)."""
    total = 0.0
    for x, y in zip(a, b):
        both = sorted({*x.tolist(), *y.tolist()})[:KEPT]
        common = set(x.tolist()) & set(y.tolist())
        total += sum(v in common for v in both) / len(both) if both else 1.0
    return total / len(LEVELS)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint_rows(doc_ids: list[int | None], found: list[str]) -> list[tuple]:
    """Rows for all but the last text, which is there as the next of the one before it."""
    changed = [edited(a, b) for a, b in zip(found, found[1:])]
    own, other = fingerprints(found), fingerprints(changed)
    return [
        (
            doc_id,
            len(text),
            hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
            written(own[at]),
            written(other[at]),
            likeness(own[at], other[at]),
            likeness(own[at], own[at + 1]),
        )
        for at, (doc_id, text, new) in enumerate(zip(doc_ids, found, changed))
    ]


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ids, each followed by a copy (``extra`` 1) of the row after its last."""
    spark = docs.sparkSession
    n = partitions(spark)
    # At most n - 1 splitters and n first ids come to the driver.
    shares = [at / n for at in range(1, n)]
    edges = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10_000)).first()[0] or []
    edges = F.array(*(F.lit(e) for e in sorted(set(edges)))).cast("array<long>")
    rows = texts(docs).withColumn("bucket", F.coalesce(F.size(F.filter(edges, lambda e: e < F.col("doc_id"))), F.lit(0)))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("bucket")))
    heads = sorted((r["bucket"], r["head"]) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())
    copies = spark.createDataFrame(
        [(bucket, head, heads[(at + 1) % len(heads)][0]) for at, (bucket, head) in enumerate(heads)],
        "bucket int, head long, target int",
    )
    target = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.col("target"))
    places = F.array(
        F.struct(F.col("bucket"), F.lit(0).alias("extra")),
        F.struct(target.alias("bucket"), F.lit(1).alias("extra")),
    )
    # One row per range: its size has a bound.
    marked = rows.join(F.broadcast(copies), "bucket").select("doc_id", "text", F.explode(places).alias("place"))
    dealt = marked.filter("place.bucket IS NOT NULL").select("doc_id", "text", "place.bucket", "place.extra")
    return dealt.repartitionByRange(n, "bucket").sortWithinPartitions(
        "bucket", "extra", F.col("doc_id").desc_nulls_last(), "text"
    )


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next text's."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        bucket, closed, size = None, False, 0
        for batch in parts(batches, most=AT_ONCE):
            rows: list[tuple] = []
            for doc_id, text, at, extra in zip(*(c.to_pylist() for c in batch.columns)):
                if at != bucket:
                    bucket, closed, size = at, False, 0
                    held = ([], [])
                if closed:
                    continue
                held[0].append(doc_id)
                held[1].append(text)
                size += len(text)
                if extra or size > AT_ONCE:
                    rows += fingerprint_rows(*held)
                    held, size, closed = ([doc_id], [text]), len(text), bool(extra)
            yield rows_of(PRINTS, rows)

    return neighbours(docs).mapInArrow(emit, PRINTS)
