"""Toxic spans by a linear-chain conditional random field.

The tables label documents, so tokens get their labels from them: in a toxic
document a token is labelled toxic if it, or failing that its first letters,
occurs far more often in toxic documents than in clean ones, and than chance
among so many tokens explains. Documents are
cut, whole, into stretches of tokens; on these a chain with the states clean
and toxic is fitted by maximum likelihood, with evidence of the token and of
its first letters as emission features and a weight for each transition.

A document is then read whole. Forward and backward messages give every token's
marginal probability of being toxic, for many documents side by side, token by
token. The expected number of toxic tokens and the largest marginal are turned
into the document's score by a logistic fit to the document labels. Offsets of
stretches of tokens with a marginal over one half are the offending spans.

Learning sees at most ``SAMPLE`` labelled documents of each class, those with
the least MD5 digest of their id; evidence comes from all of these, the chain
and the score from at most ``CHAIN_SAMPLE`` of each. The sampled share of each
class is made up for by weights.

Cases: null and empty texts have no token and get the score of a text without
evidence. Null labels teach nothing; without documents of both classes every score
is 1 or 0, whichever class there is (0 without any). Of repeated labels of a
document each counts. Repeated documents get a row each, an empty table gives
none. Columns other than doc_id, text and toxic are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import held_out, is_held_out, parts, rows_of, stored, texts

SAMPLE = 8_000
CHAIN_SAMPLE = 500
STRETCH = 64
THRESHOLD = 0.3
#: Least number of sampled documents that know a token, and least log ratio for a toxic label.
LEAST_DOCUMENTS = 4
LEAST_EVIDENCE = 4.5
#: Tokens expected to get evidence by chance alone.
CHANCE = 0.05
#: Tokens remembered by one worker.
REMEMBERED = 300_000
PREFIXES = (6, 5, 4)
EVIDENCE = "token string, toxic long, clean long"
SCORES = "doc_id long, held_out boolean, score double, predicted int, spans array<int>"
TOKENS = re.compile(r"\w+").findall
TOKENS_AT = re.compile(r"\w+").finditer


def features_of(token: str) -> list[str]:
    """The token in lower case and its beginnings, marked by a star."""
    token = token.lower()
    return [token, *(f"{token[:n]}*" for n in PREFIXES if len(token) > n)]


@dataclass
class Chain:
    """Evidence of tokens and beginnings, chain weights, and the logistic score."""

    evidence: dict[str, float] = field(default_factory=dict)
    #: Emission weights of a constant, a token's evidence and its beginnings' evidence.
    emit: np.ndarray = field(default_factory=lambda: np.array([-4.0, 2.0, 1.0]))
    #: Log weights of the transitions [from][to], and of beginning toxic.
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    score: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 0.0]))
    fixed: float | None = None

    def inputs(self, token: str) -> tuple[float, float]:
        whole, *begins = (self.evidence.get(x, 0.0) for x in features_of(token))
        return whole, max(begins, default=0.0)


class Reader:
    """Emission inputs of tokens, each distinct token looked up once per worker."""

    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.known: dict[str, int] = {}
        self.pairs: dict[tuple[float, float], int] = {(0.0, 0.0): 0}

    def codes(self, text: str) -> list[int]:
        known = self.known
        tokens = TOKENS(text)
        found = list(map(known.get, tokens))
        if None in found:
            if len(known) > REMEMBERED:
                known.clear()
            for at, code in enumerate(found):
                if code is None:
                    pair = self.chain.inputs(tokens[at])
                    found[at] = known[tokens[at]] = self.pairs.setdefault(pair, len(self.pairs))
        return found

    def table(self) -> np.ndarray:
        return np.array(list(self.pairs))


def log_odds(chain: Chain, pairs: np.ndarray) -> np.ndarray:
    """How far each kind of token speaks for toxic."""
    return chain.emit[0] + pairs @ chain.emit[1:]


def marginals(score: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of toxic per token given its whole sequence, and the two messages that they add up.

    ``score`` holds the sequences end to end. All sequences advance side by
    side, longest first, so that each step is one operation on those still running.
    """
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    running = np.searchsorted(-ordered, -np.arange(int(ordered.max(initial=0))), "left")
    forward, backward = np.array(score), np.zeros_like(score)
    stay, leave = np.exp(move[1]), np.exp(move[0])

    def pushed(x: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        odds = np.exp(np.clip(x, -50, 50))
        return np.log((one[1] + two[1] * odds) / (one[0] + two[0] * odds))

    for t in range(1, len(running)):
        at = begin[: running[t]] + t
        forward[at] += pushed(forward[at - 1], leave, stay)
    across, back = np.exp(move[:, 0]), np.exp(move[:, 1])
    for t in range(len(running) - 2, -1, -1):
        at = begin[: running[t + 1]] + t
        backward[at] = pushed(backward[at + 1] + score[at + 1], across, back)
    return forward + backward, forward, backward


def fit_chain(chain: Chain, pairs: np.ndarray, codes: np.ndarray, labels: np.ndarray, sizes: np.ndarray, rounds: int = 60) -> None:
    """Maximum likelihood by gradient steps (Adam), lightly regularised."""
    x = np.concatenate([np.ones((len(pairs), 1)), pairs], axis=1)[codes]
    first = np.cumsum(sizes) - sizes
    inner = np.ones(len(codes), dtype=bool)
    inner[first[sizes > 0]] = False
    after = np.nonzero(inner)[0]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[after - 1], labels[after]), 1)
    weights = np.concatenate([chain.emit, chain.move.ravel()])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        emit, move = weights[:3], weights[3:].reshape(2, 2)
        score = x @ emit
        both, forward, backward = marginals(score, sizes, move)
        p = 1 / (1 + np.exp(-np.clip(both, -50, 50)))
        # Expected transitions: both ends' messages and the weight between them.
        a, b = forward[after - 1], backward[after] + score[after]
        pair = np.stack([move[0, 0] + 0 * a, move[0, 1] + b, move[1, 0] + a, move[1, 1] + a + b], axis=1)
        pair = np.exp(pair - pair.max(axis=1, keepdims=True))
        expected = (pair / pair.sum(axis=1, keepdims=True)).sum(axis=0)
        slope = np.concatenate([x.T @ (labels - p), seen.ravel() - expected]) / len(codes) - 1e-5 * weights
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        weights = weights + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    chain.emit, chain.move = weights[:3], weights[3:].reshape(2, 2)


def summed(both: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per sequence: a constant, the log of the expected number of toxic tokens, and the largest marginal."""
    p = 1 / (1 + np.exp(-np.clip(both, -50, 50)))
    out = np.zeros((len(sizes), 3))
    out[:, 0] = 1
    full = np.nonzero(sizes > 0)[0]
    if len(full):
        begin = (np.cumsum(sizes) - sizes)[full]
        out[full, 1] = np.log1p(np.add.reduceat(p, begin))
        out[full, 2] = np.maximum.reduceat(p, begin)
    return out


def fit_score(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, ridge 0.1 but for the constant."""
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-3, 0.1, 0.1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        beta = beta + np.linalg.solve(curve, slope)
    return beta


def learn(docs: DataFrame, labels: DataFrame) -> Chain:
    """The chain from a bounded sample of labelled documents; see the module's text."""
    spark = docs.sparkSession
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()
    )
    totals = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return Chain(fixed=float(totals.get(1, 0) > 0))
    by_chance = F.md5(F.col("doc_id").cast("string"))
    picked = {c: usable.filter(F.col("toxic") == c).orderBy(by_chance).limit(SAMPLE).collect() for c in (0, 1)}
    # At most twice SAMPLE rows of two numbers, whatever the table's size.
    sample = spark.createDataFrame([r for c in (0, 1) for r in picked[c]], "doc_id long, toxic int")
    # Copies of a text say no more than the text.
    sampled = texts(docs).join(F.broadcast(sample), "doc_id").select("text", "toxic").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, most=1_000_000):
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                for name in {x for token in set(TOKENS(text)) for x in features_of(token)}:
                    seen.setdefault(name, [0, 0])[1 - toxic] += 1
            yield rows_of(EVIDENCE, [(name, *n) for name, n in seen.items()])

    n = {c: max(1, len(picked[c])) for c in (0, 1)}
    counted = sampled.mapInArrow(count, EVIDENCE).groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    t, c, share = F.col("toxic"), F.col("clean"), n[1] / (n[0] + n[1])
    counted = stored(counted.filter(t >= LEAST_DOCUMENTS), "toxic-tokens")
    # How much likelier the counts are than by chance; so high that among all tokens chance makes next to none.
    gain = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    ratio = F.log((t + 0.1) / n[1]) - F.log((c + 0.1) / n[0])
    sure = math.log(max(1, counted.count()) / CHANCE)
    known = counted.filter((gain >= sure) & (ratio >= LEAST_EVIDENCE)).select("token", ratio.alias("ratio"))
    chain = Chain(evidence={r["token"]: min(8.0, r["ratio"]) for r in known.collect()})

    small = spark.createDataFrame([r for c in (0, 1) for r in picked[c][:CHAIN_SAMPLE]], "doc_id long, toxic int")
    rows = texts(docs).join(F.broadcast(small), "doc_id").select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    reader = Reader(chain)
    coded = [np.array(reader.codes(r["text"]), dtype=np.int64) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], dtype=np.int64)
    if len(set(toxic.tolist())) < 2:
        return Chain(fixed=float(toxic.any()))
    pairs = reader.table()
    strong = pairs.max(axis=1) >= LEAST_EVIDENCE
    codes = np.concatenate(coded)
    label = (strong[codes] & np.repeat(toxic == 1, [len(c) for c in coded])).astype(np.int64)
    sizes = np.array([min(STRETCH, len(c) - at) for c in coded for at in range(0, len(c), STRETCH)], dtype=np.int64)
    if len(codes):
        fit_chain(chain, pairs, codes, label, sizes)
    whole = np.array([len(c) for c in coded], dtype=np.int64)
    both = marginals(log_odds(chain, pairs)[codes], whole, chain.move)[0]
    share = {c: totals[c] / max(1, int((toxic == c).sum())) for c in (0, 1)}
    weight = np.array([share[c] for c in toxic.tolist()])
    chain.score = fit_score(summed(both, whole), toxic.astype(float), weight / weight.mean())
    return chain


def scored(docs: DataFrame, labels: DataFrame, chain: Chain | None = None) -> DataFrame:
    """One row per row of ``docs``: score, prediction, and offending spans as pairs of first and next character."""
    shared = docs.sparkSession.sparkContext.broadcast(chain or learn(docs, labels))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        reader = Reader(chain)
        for batch in parts(batches, most=6_000_000):
            doc_ids, found = (c.to_pylist() for c in batch.columns)
            coded = [np.array(reader.codes(t), dtype=np.int32) for t in found]
            sizes = np.array([len(c) for c in coded], dtype=np.int64)
            score = log_odds(chain, reader.table())[np.concatenate(coded)]
            both = marginals(score, sizes, chain.move)[0]
            odds = summed(both, sizes) @ chain.score
            value = 1 / (1 + np.exp(-np.clip(odds, -50, 50))) if chain.fixed is None else np.full(len(found), chain.fixed)
            begin = np.cumsum(sizes) - sizes
            bad = np.nonzero(both > 0)[0]
            edges = np.searchsorted(bad, np.append(begin, len(both)))
            rows = []
            for at, (doc_id, text) in enumerate(zip(doc_ids, found)):
                where = (bad[edges[at] : edges[at + 1]] - begin[at]).tolist()
                held = doc_id is not None and is_held_out(doc_id)
                rows.append((doc_id, held, float(value[at]), int(value[at] >= THRESHOLD), spans(text, where)))
            yield rows_of(SCORES, rows)

    return texts(docs).mapInArrow(emit, SCORES)


def spans(text: str, tokens: list[int]) -> list[int]:
    """First and next character of each stretch of the numbered tokens."""
    if not tokens:
        return []
    wanted, out, last = set(tokens), [], -2
    for at, match in enumerate(TOKENS_AT(text)):
        if at in wanted:
            if at == last + 1:
                out[-1] = match.end()
            else:
                out += [match.start(), match.end()]
            last = at
    return out
