"""Near-duplicates by SimHash: every link between fingerprints a few bits apart, and the components they form.

Vantage-point trees deal the fingerprints to shards by Hamming distance. Whole
fingerprints of unlike texts are about 32 bits from any vantage point, give or take 4, so a
radius of 4 would reach both sides of most splits. Hence a tree for each third of
the bits: of 4 differing bits, some third has at most one, so in that third's
tree a radius of 1 finds the pair. A node's vantage point is drawn from its
number and splits its points at half the bits, so a tree needs no sample and
its depth alone follows the number of fingerprints.

A fingerprint lives in one shard of each tree. It also visits each shard with a larger
number that holds a point at most one bit from it, which are the shards that
the triangle bounds leave open. Within a shard a vantage-point tree over
whole fingerprints answers: inner and outer halves around the median distance, each
searched only where distance and radius allow, leaves compared directly. A shard
gives back links that join what it linked, no more than it has fingerprints;
links become components by alternating stars.

A shard with very many fingerprints (a third that many texts share) is cut into blocks, and
its fingerprints visit every block with a larger number, so a task
holds one block however large the shard is.

Cases: a null or empty text, and one of white space, has fingerprint zero,
which links like any other; a text of fewer words than a shingle is one
shingle; equal fingerprints are one point; rows of null id take part, and a
component of such rows only has no id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import batch_of, partitions, parts, stored, texts
from cabgrid.llm.near_dedup import stars
from cabgrid.llm.words import U, as_long, mixed

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Bits of the parts, the lowest first. With three of them a pair within ``RADIUS`` is within one bit in some part.
THIRDS = (21, 21, 22)
#: Fingerprints a shard is meant for, and those of a larger one that one task holds.
SHARD, BLOCK = 1024, 1 << 16
#: Points of a leaf within a shard, and points that are searched for at once.
LEAF, QUERIES = 256, 1 << 13
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
FINGERPRINTS = "doc_id long, point long"
ROUTED = "part int, shard long, home boolean, point long"
LINKS = "a long, b long"


def fingerprint(text: bytes) -> int:
    """SimHash of the lower-cased text's shingles."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    number = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return number(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends[:-SHINGLE] + 1).tolist()
    hashes = [number(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        some = np.array(hashes[at : at + (1 << 14)], dtype="<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed number."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = np.array([fingerprint(text) for text in batch.column(1).to_pylist()], dtype=U)
            yield batch_of(FINGERPRINTS, batch.column(0), as_long(found))

    keyed = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return keyed.mapInArrow(emit, FINGERPRINTS)


def thirds_of(points: np.ndarray) -> list[np.ndarray]:
    out, shift = [], 0
    for bits in THIRDS:
        out.append((points >> U(shift)) & U((1 << bits) - 1))
        shift += bits
    return out


def shards_of(values: np.ndarray, part: int, depth: int) -> np.ndarray:
    """Where values of one part end in its tree: at each node the distance to its vantage point picks the side."""
    bits, node = THIRDS[part], np.ones(len(values), dtype=U)
    for _ in range(depth):
        vantage = mixed(node + U(part << 56)) & U((1 << bits) - 1)
        node = 2 * node + (np.bitwise_count(values ^ vantage) > bits // 2).astype(U)
    return node


def routed(points: DataFrame, depth: int) -> DataFrame:
    """Each point's shard in each tree, and the shards with larger numbers that its ball reaches."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy().view(U)
            for part, values in enumerate(thirds_of(found)):
                home = shards_of(values, part, depth)
                columns = [home]
                for bit in range(THIRDS[part]):
                    there = shards_of(values ^ U(1 << bit), part, depth)
                    columns.append(np.where(there > home, there, home))
                reached = np.sort(np.stack(columns, axis=1), axis=1)
                new = np.ones(reached.shape, dtype=bool)
                new[:, 1:] = reached[:, 1:] != reached[:, :-1]
                row, place = np.nonzero(new)
                shard = reached[row, place]
                yield batch_of(ROUTED, np.full(len(row), part, dtype=np.int32), as_long(shard), shard == home[row], as_long(found[row]))

    return points.select("point").mapInArrow(emit, ROUTED)


class Joined:
    """Links among the points of one shard, each only if it joins what wasn't joined."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        root = self.root
        top = x
        while top in root:
            top = root[top]
        while x != top:
            root[x], x = top, root[x]
        return top

    def add(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.find(a), self.find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((a, b))


def compared(homes: np.ndarray, queries: np.ndarray, joined: Joined, radius: int) -> None:
    """Joins each query with the homes within ``radius``, by at most as many pairs as there are points and pairs of homes."""
    near = np.bitwise_count(queries[:, None] ^ homes[None, :]) <= radius
    row, column = np.nonzero(near)
    if not len(row):
        return
    # A query links its first home, and each home the next one that it is near to.
    first = np.append(True, row[1:] != row[:-1])
    pairs = np.stack([queries[row[first]], homes[column[first]]], axis=1)
    chained = np.unique(column[:-1][~first[1:]] * len(homes) + column[1:][~first[1:]])
    chain = np.stack([homes[chained // len(homes)], homes[chained % len(homes)]], axis=1)
    both = np.concatenate([pairs, chain])
    joined.add(both[both[:, 0] != both[:, 1]])


def search(homes: np.ndarray, queries: np.ndarray, joined: Joined, radius: int = RADIUS) -> None:
    """Joins all queries with all homes within ``radius``, by a vantage-point tree over the homes."""
    todo = [(homes, queries)]
    while todo:
        homes, queries = todo.pop()
        if not len(homes) or not len(queries):
            continue
        if len(homes) <= LEAF:
            for at in range(0, len(queries), QUERIES):
                compared(homes, queries[at : at + QUERIES], joined, radius)
            continue
        vantage = homes[len(homes) // 2]
        there, here = np.bitwise_count(homes ^ vantage).astype(np.int64), np.bitwise_count(queries ^ vantage).astype(np.int64)
        middle = int(np.partition(there, len(there) // 2)[len(there) // 2])
        inner = there <= middle
        if inner.all():  # most are equally far
            inner = there < middle
            middle -= 1
        if not inner.any():  # all are
            half = len(homes) // 2
            near = queries[np.abs(here - middle - 1) <= radius]
            todo += [(homes[:half], near), (homes[half:], near)]
            continue
        todo += [(homes[inner], queries[here <= middle + radius]), (homes[~inner], queries[here > middle - radius])]


def links_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (part, shard, block); its homes come before its visitors."""
    key, homes, held, joined = None, None, [], Joined()

    def answered() -> None:
        nonlocal homes, held
        points = np.concatenate(held) if held else np.empty(0, dtype=U)
        if homes is None:
            homes = points
        search(homes, points, joined)
        held = []

    def links() -> pa.RecordBatch:
        found = np.array(joined.links, dtype=U).reshape(-1, 2)
        return batch_of(LINKS, as_long(found[:, 0].copy()), as_long(found[:, 1].copy()))

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]]
        points = batch.column(4).to_numpy().view(U)
        changes = np.zeros(batch.num_rows, dtype=bool)
        for values in columns:
            changes[1:] |= values[1:] != values[:-1]
        edges = [0, *np.nonzero(changes)[0].tolist(), batch.num_rows]
        for first, after in zip(edges, edges[1:]):
            if first == after:
                continue
            part, shard, block, visiting = (values[first] for values in columns)
            now = (part, shard, block)
            if now != key:
                if key is not None:
                    answered()
                    yield links()
                key, homes, held, joined = now, None, [], Joined()
            if visiting and homes is None:
                answered()  # what was held so far are the homes, and now all of them
            held.append(points[first:after])
            if homes is not None and sum(map(len, held)) >= BLOCK:
                answered()
    if key is not None:
        answered()
        yield links()


def links_of(points: DataFrame, count: int) -> DataFrame:
    """Links that join all fingerprints within ``RADIUS`` of another; ``points`` are ``count`` distinct ones, stored."""
    n = partitions(points.sparkSession)
    depth = max(0, (count // SHARD).bit_length())
    rows = stored(routed(points, depth), "simhash-shards")
    by = ["part", "shard"]
    large = rows.filter("home").groupBy(*by).agg(F.count(F.lit(1)).alias("homes")).filter(F.col("homes") > BLOCK)
    large = large.select(*by, F.ceil(F.col("homes") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(large, by, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.when(F.col("home"), F.expr("CAST(pmod(xxhash64(point), blocks) AS INT)")).otherwise(0))
    dealt = rows.withColumn("block", F.explode(F.expr("sequence(own, blocks - 1)")))
    dealt = dealt.withColumn("visiting", ~(F.col("home") & (F.col("own") == F.col("block"))))
    group = [*by, "block"]
    spread = dealt.repartition(n, *group).sortWithinPartitions(*group, "visiting")
    return spread.select(*group, "visiting", "point").mapInArrow(links_of_blocks, LINKS)


def near_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, and the least id that it is linked to, over any number of links."""
    rows = stored(fingerprints(docs), "simhash-fingerprints")
    points = stored(rows.groupBy("point").agg(F.min("doc_id").alias("least")), "simhash-points")
    links = stars(links_of(points, points.count()))
    root = F.coalesce("b", "point").alias("root")
    rooted = points.join(links.select(F.col("a").alias("point"), "b"), "point", "left").select("point", "least", root)
    rooted = stored(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.join(least, "root").select("point", "component_id")
    return rows.join(component, "point").select(
        "doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id"
    )
