"""Language identification by mixture inference over letter n-grams.

Each language is a distribution over three-letter grams (letters in lower case,
everything else a blank), counted over all texts that carry its label. A
document is a mixture of languages: expectation-maximisation estimates the
proportions that make its grams likeliest. Languages enter in the order of
their share in the mixture of all, and the set with the highest likelihood less
``PENALTY`` times the logarithm of the number of grams per language is chosen.
Its largest member is the prediction, its share in that mixture the score.

Beside the languages there is a flat component for grams of none of them. A
document that it explains better than half is not accepted: its language is
none of the learned ones.

The counts, one number per gram bucket and language, are all that reaches the
driver; ``BUCKETS`` bounds them.

Cases: texts without a letter, null or empty included, are ``und`` with score 0
and not accepted. Null labels teach nothing. Without any label all texts are
``und``. Of equal proportions the language first in the alphabet counts.
Repeated rows get a row each, an empty table gives none. Columns other than
doc_id, text and, for learning, lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import batch_of, held_out, parts, rows_of, texts

BUCKETS = 1 << 15
PENALTY = 2.0
SMOOTHING = 0.2
ROUNDS = 12
UNKNOWN = "und"
COUNTS = "lang string, bucket int, n long"
GUESSES = "doc_id long, lang_pred string, score double, languages string, accepted boolean"


class Letters:
    """Whether a code point is a letter; filled as code points are met."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, dtype=np.int8)

    def of(self, points: np.ndarray) -> np.ndarray:
        state = self.known[points]
        if not state.all():
            for point in np.unique(points[state == 0]).tolist():
                self.known[point] = 2 if chr(point).isalpha() else 1
            state = self.known[points]
        return state == 2


LETTERS = Letters()


def grams(text: str) -> np.ndarray:
    """Buckets of all three-letter grams with at least two letters; none for a text without letters."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = LETTERS.of(points)
    c = np.where(letter, points, np.uint32(32))
    h = c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77) ^ c[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    enough = letter[1:-1] & (letter[:-2] | letter[2:])
    if not enough.any():
        enough = letter[1:-1]
    return (h[enough] >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages, and for each bucket its likelihood in each language and in the flat component (last column)."""

    languages: tuple[str, ...]
    chance: np.ndarray


def learn(docs: DataFrame) -> Model:
    """Counts over every labelled text that isn't held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in parts(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang not in seen:
                    seen[lang] = np.zeros(BUCKETS, dtype=np.int64)
                seen[lang] += np.bincount(grams(text), minlength=BUCKETS)
        for lang, n in seen.items():
            at = np.nonzero(n)[0]
            yield batch_of(COUNTS, [lang] * len(at), at.astype(np.int32), n[at])

    labelled = texts(docs, "lang").filter(F.col("lang").isNotNull() & ~held_out()).select("text", "lang")
    rows = labelled.mapInArrow(count, COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    table = np.zeros((BUCKETS, len(languages) + 1))
    table[rows["bucket"], [languages.index(x) for x in rows["lang"]]] = rows["n"]
    # Half of the smoothing follows what all languages have in common, half is even.
    common = table.sum(axis=1) / max(1.0, table.sum())
    total = table.sum(axis=0)
    table = (table + SMOOTHING * total * (common[:, None] + 1 / BUCKETS) / 2) / np.maximum(1.0, total * (1 + SMOOTHING))
    table[:, -1] = 1 / BUCKETS
    return Model(languages, table)


def fit(chance: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log-likelihood."""
    k = chance.shape[1]
    part = np.full(k, 1 / k)
    if k == 1:
        return part, float(n @ np.log(chance[:, 0]))
    weight = n / n.sum()
    for _ in range(rounds):
        part = part * ((weight / (chance @ part)) @ chance)
    return part / part.sum(), float(n @ np.log(chance @ part))


def guess(model: Model, text: str) -> tuple[str, float, str, bool]:
    """Prediction, score, all chosen languages by share, and whether a learned language explains the text."""
    found = grams(text)
    if not len(found) or not model.languages:
        return UNKNOWN, 0.0, "", False
    n = np.bincount(found, minlength=BUCKETS)
    at = np.nonzero(n)[0]
    chance, n = model.chance[at], n[at].astype(float)
    full, _ = fit(chance, n)
    order = np.argsort(-full[:-1], kind="stable")
    penalty = PENALTY * np.log(len(found) + 1)
    best, chosen, shares = -np.inf, order[:1], np.ones(1)
    for k in range(1, len(order) + 1):
        part, likely = fit(chance[:, order[:k]], n)
        if likely - k * penalty <= best:
            break
        best, chosen, shares = likely - k * penalty, order[:k], part
    ranked = chosen[np.lexsort((chosen, -shares))]
    named = ",".join(model.languages[x] for x in ranked)
    return model.languages[ranked[0]], float(min(1.0, full[ranked[0]])), named, bool(full[-1] <= 0.5)


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: predicted language, score, chosen languages, whether it is accepted."""
    model = model or learn(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc_ids, found = (c.to_pylist() for c in batch.columns)
            yield rows_of(GUESSES, [(d, *guess(shared.value, t)) for d, t in zip(doc_ids, found)])

    return texts(docs).mapInArrow(emit, GUESSES)


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is a learned one, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs))
    at = docs.columns.index("text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            keep = [guess(shared.value, t or "")[3] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(emit, docs.schema)
