"""Best-fit packing of documents into fixed-length sequences.

Pattern packing by non-negative least squares. Only the histogram of piece
lengths, at most one number per length up to the capacity, reaches the driver:

1. patterns of few documents whose lengths fill a sequence are enumerated;
2. their repeat counts are fitted to the histogram by non-negative least squares;
3. the counts are rounded, each to what the histogram still holds;
4. residual pieces are packed largest first, each into the best-fitting rest of
   a pattern, and every pattern found is repeated as often as the counts allow.

The plan says which ranks of each length go where. Pieces are ranked by
length without gathering a length anywhere: each task counts its own, and the
counts of all tasks are added up.

Cases: a null text is an empty one and holds only the end id. Equal lengths are
taken in the order of the stored pieces. Repeated rows are packed each. An
empty table gives no rows. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import batch_of, parts, rows_of, stored, texts
from cabgrid.llm.encoding import encoder

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces_of(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids, end id included, cut only where they exceed ``capacity``.

    ``task`` and ``place`` number the pieces of each length within a task.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in parts(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            yield rows_of(PIECES, rows)

    return texts(docs).mapInArrow(cut, PIECES)


@dataclass(frozen=True)
class Pattern:
    lengths: tuple[int, ...]
    repeats: int


def patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, middles: int = 8, waste: float = 0.01) -> np.ndarray:
    """Patterns of two, three or four lengths, as rows padded with 0, that leave at most ``waste`` of the capacity.

    The last length is always the best fit for what the others leave; the one
    or two in the middle come from ``middles`` lengths spread evenly over the pieces.
    """
    fits = np.zeros(capacity + 1, dtype=np.int64)
    fits[lengths] = lengths
    fits = np.maximum.accumulate(fits)
    spread = np.unique(lengths[np.searchsorted(np.cumsum(counts), np.linspace(0, counts.sum() - 1, middles), "right")])
    some = np.concatenate([[0], spread])
    first, one, two = (x.ravel() for x in np.meshgrid(lengths, some, some, indexing="ij"))
    room = capacity - first - one - two
    keep = (room >= 0) & (one >= two)
    first, one, two, room = first[keep], one[keep], two[keep], room[keep]
    last = fits[room]
    rows = np.stack([first, one, two, last], axis=1)[room - last <= waste * capacity]
    return np.unique(-np.sort(-rows, axis=1), axis=0)


def fit_counts(rows: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative repeat counts whose pieces come closest to the histogram, by accelerated projected gradient."""
    column, length = np.nonzero(rows)[0], rows[rows > 0]
    size = len(histogram)

    def made(x: np.ndarray) -> np.ndarray:
        return np.bincount(length, x[column], size)

    def back(r: np.ndarray) -> np.ndarray:
        return np.bincount(column, r[length], len(rows))

    probe = np.ones(len(rows))
    for _ in range(20):
        probe = back(made(probe / np.linalg.norm(probe)))
    step = 1 / np.linalg.norm(probe)
    x = ahead = np.zeros(len(rows))
    speed = 1.0
    for _ in range(rounds):
        new = np.maximum(0, ahead + step * back(histogram - made(ahead)))
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - x)
        x, speed = new, faster
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use every piece of the histogram exactly once. Work depends on the capacity, not on the data."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    out: list[Pattern] = []

    def use(lengths: tuple[int, ...], most: int) -> None:
        need = Counter(lengths)
        repeats = min([most, *(int(left[x]) // k for x, k in need.items())])
        if repeats > 0:
            for x, k in need.items():
                left[x] -= k * repeats
            out.append(Pattern(lengths, repeats))

    if left[capacity]:
        use((capacity,), int(left[capacity]))
    present = np.nonzero(left)[0]
    if len(present):
        rows = patterns(present, left[present], capacity)
        if len(rows):
            counts = fit_counts(rows, left.astype(float))
            for at in np.argsort(-counts, kind="stable"):
                if counts[at] < 0.5:
                    break
                use(tuple(int(x) for x in rows[at] if x), int(np.rint(counts[at])))
    while left.any():
        room, lengths, taken = capacity, [], Counter()
        length = int(np.nonzero(left)[0][-1])
        while length:
            times = min(room // length, int(left[length]))
            lengths += [length] * times
            taken[length] += times
            room -= times * length
            fit = np.nonzero(left[: min(room, length - 1) + 1])[0]
            length = int(fit[-1]) if len(fit) else 0
        use(tuple(lengths), max(1, int(min(left[x] // k for x, k in taken.items()))))
    return out


def places(found: list[Pattern]) -> dict[str, np.ndarray]:
    """For each stretch of ranks of one length: where it begins, its first sequence and its offset there."""
    taken: Counter[int] = Counter()
    rows, base = [], 0
    for pattern in found:
        offset = 0
        for length in pattern.lengths:
            rows.append((length, taken[length], base, offset))
            taken[length] += pattern.repeats
            offset += length
        base += pattern.repeats
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They must be stored: places are only as stable as their rows."""
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    at = places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["task", "length"]).withColumn("rank", F.col("first") + F.col("place"))
    shift = 1 << 40
    key = at["length"] * shift + at["rank"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            row = np.searchsorted(key, length * shift + rank, "right") - 1
            sequence = at["sequence"][row] + rank - at["rank"][row]
            yield batch_of(PACKED, *batch.columns[:-1], sequence, at["offset"][row])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(put, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut, and pack ``docs``: one row per piece with its sequence and its place there."""
    return pack(stored(pieces_of(docs, tokenizer, capacity), "pieces"), capacity)
