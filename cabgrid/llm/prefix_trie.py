"""Prefix trie of conversations: who shares which first turns, and what storing them once saves.

Distinct turns get dictionary ids, so a conversation is a short row of
numbers and texts travel no further than their hash. Equal conversations become one
sequence with a count. The sequences are dealt to ranges of their order, so a
popular beginning is split by what follows it; each range builds a ternary
search tree: per node a turn id, smaller and larger siblings, and the next turns. Sequences are
inserted median first, which balances the sibling trees. A node is made after
its parent, so one pass from the last node to the first adds up
members, leaves and savings without recursion.

A node that lies in several ranges is a prefix of the first or of the last
sequence of each of them. These paths leave their range as partial sums. Two neighbouring ranges
count what they share twice (children, and a turn's own bytes), and a
sequence that ends a range isn't childless if it begins the next one's first; a row per shared
prefix puts that right, and then all of them are added up by prefix.

Cases: rows without conv_id belong to no conversation; a null turn comes first;
equal turn numbers are ordered by the turn's hash; null role and text are
empty; repeated rows are turns of their own. The remainder of a negative id has
its sign, as in SQL. An empty table has no nodes. Other columns are ignored. One
conversation's ids, 16 bytes a turn, are held at once, and the ids of all conversations
with the same turns pass one task in order, because their digest is sequential.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import partitions, rows_of, stored
from cabgrid.llm.merkle import CRC32

#: A conversation borrows from the one with the next smaller id that this divides, fewer turns than ``BORROWED``.
STRIDE, BORROWED = 5, 9
SEQUENCES = "ids array<long>, sizes array<long>, n long, conv_id long, ends_sha256 string"
NODES = (
    "shard int, key binary, up binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, first array<long>, first_sizes array<long>,"
    " last array<long>, last_sizes array<long>"
)
SUMS = "key binary, n_children long, n_leaves long, saved_tokens long"
ROOT = b""


def turns_of(conversations: DataFrame) -> DataFrame:
    """Conversation, turn, what was said by whom as a hash, and the bytes of the text."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(said, 256)).alias("said"),
        F.octet_length(text).cast("long").alias("size"),
    )


def encoded(turns: DataFrame) -> DataFrame:
    """A row per conversation: its turns in order as dictionary ids with their sizes. ``turns`` must be stored."""
    dictionary = turns.groupBy("said").agg(F.first("size").alias("size"))
    dictionary = stored(dictionary.select("said", F.monotonically_increasing_id().alias("id")), "trie-dictionary")
    coded = turns.join(dictionary, "said").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "said", "id", "size"))).alias("turns"))
    return coded.select("conv_id", F.expr("transform(turns, x -> struct(x.id AS id, x.size AS size))").alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from its base."""
    base = lists.select(F.col("conv_id").alias("base"), F.col("turns").alias("lent"))
    taken = F.expr(f"CAST(crc32(CAST(conv_id AS STRING)) % {BORROWED} AS INT)")
    rows = lists.withColumn("base", F.expr(f"conv_id - conv_id % {STRIDE}")).withColumn("h", taken).join(base, "base", "left")
    turns = F.expr("concat(slice(coalesce(lent, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, greatest(size(turns) - h, 0)))")
    return rows.select("conv_id", turns.alias("turns")).select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


def sequences(conversations: DataFrame) -> DataFrame:
    """Each distinct sequence with its conversations' number, least id and digest of ids."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = sizes = least = None
        n, ends, out = 0, sha256(), []
        for batch in batches:
            for ids, now, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if ids != last:
                    if last is not None:
                        out.append((last, sizes, n, least, ends.hexdigest()))
                    last, sizes, least, n, ends = ids, now, conv_id, 0, sha256()
                n += 1
                ends.update(b"%d" % conv_id if n == 1 else b",%d" % conv_id)
            yield rows_of(SEQUENCES, out)
            out = []
        if last is not None:
            yield rows_of(SEQUENCES, [(last, sizes, n, least, ends.hexdigest())])

    dealt = conversations.repartition(partitions(conversations.sparkSession), "ids").sortWithinPartitions("ids", "conv_id")
    return dealt.select("ids", "sizes", "conv_id").mapInArrow(add_up, SEQUENCES)


class TernaryTree:
    """A trie whose children form a search tree; node 0 is the root, and every node comes after its parent."""

    def __init__(self) -> None:
        self.turn, self.lower, self.next, self.higher, self.parent = (array("q", [x]) for x in (0, -1, -1, -1, -1))
        self.depth, self.size, self.n, self.end = (array("q", [x]) for x in (0, 0, 0, -1))
        self.least: list[int | None] = [None]

    def _new(self, turn: int, parent: int, size: int) -> int:
        for values, value in (
            (self.turn, turn), (self.lower, -1), (self.next, -1), (self.higher, -1), (self.parent, parent),
            (self.depth, self.depth[parent] + 1), (self.size, size), (self.n, 0), (self.end, -1), (self.least, None),
        ):
            values.append(value)
        return len(self.turn) - 1

    def insert(self, ids: Sequence[int], sizes: Sequence[int], n: int, least: int, end: int) -> None:
        node = 0
        for turn, size in zip(ids, sizes):
            links, at = self.next, node
            while True:
                below = links[at]
                if below < 0:
                    below = links[at] = self._new(turn, node, size)
                    break
                here = self.turn[below]
                if here == turn:
                    break
                links, at = (self.lower if turn < here else self.higher), below
            node = below
        self.n[node], self.least[node], self.end[node] = n, least, end

    def path(self, ids: Sequence[int]) -> list[int]:
        """The nodes of a sequence in the tree, the root first."""
        nodes = [0]
        for turn in ids:
            at = self.next[nodes[-1]]
            while self.turn[at] != turn:
                at = (self.lower if turn < self.turn[at] else self.higher)[at]
            nodes.append(at)
        return nodes

    def totals(self) -> tuple[array, array, array]:
        """Children, leaves and savings of every node; members and their least id are added up as well."""
        count = len(self.turn)
        children, leaves, saved = (array("q", bytes(8 * count)) for _ in range(3))
        for at in range(count - 1, -1, -1):
            if not children[at]:
                leaves[at] = 1
            saved[at] += (self.n[at] - 1) * self.size[at]
            up = self.parent[at]
            if up >= 0:
                self.n[up] += self.n[at]
                if self.least[up] is None or self.least[at] < self.least[up]:
                    self.least[up] = self.least[at]
                children[up] += 1
                leaves[up] += leaves[at]
                saved[up] += saved[at]
        return children, leaves, saved


def median_first(count: int) -> Iterator[int]:
    """0 to ``count`` - 1, the middle before the middles of both halves."""
    spans = [(0, count)]
    while spans:
        low, high = spans.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(middle + 1, high), (low, middle)]


def prefix_keys(ids: Sequence[int]) -> list[bytes]:
    """A key of 16 bytes for each prefix, the empty one first."""
    keys = [ROOT]
    for turn in ids:
        keys.append(blake2b(keys[-1] + turn.to_bytes(8, "little"), digest_size=16).digest())
    return keys


def range_nodes(shard: int, rows: list[tuple[list[int], list[int], int, int, str]]) -> Iterator[tuple]:
    """The nodes of one range of sequences in order, and a row with its first and its last sequence."""
    tree = TernaryTree()
    for at in median_first(len(rows)):
        ids, sizes, n, least, _ = rows[at]
        tree.insert(ids, sizes, n, least, at)
    children, leaves, saved = tree.totals()
    (first, first_sizes, *_), (last, last_sizes, *_) = rows[0], rows[-1]
    keys = {}
    for ids in (first, last):
        keys.update(zip(tree.path(ids), prefix_keys(ids)))
    for at in range(len(tree.turn)):
        up, ends = tree.parent[at], tree.end[at]
        open_above = up in keys
        yield (
            shard,
            keys.get(at),
            keys[up] if open_above else None,
            tree.depth[at],
            tree.least[at],
            None if open_above or up < 0 else tree.least[up],
            tree.n[at],
            children[at],
            leaves[at],
            saved[at],
            rows[ends][4] if ends >= 0 else None,
            None, None, None, None,
        )
    yield (shard, *[None] * 10, first, first_sizes, last, last_sizes)


def corrections(before: list[int], before_sizes: list[int], first: list[int]) -> list[tuple[bytes, int, int, int]]:
    """What two neighbouring ranges counted twice, for each prefix that they share."""
    shared = 0
    while shared < min(len(before), len(first)) and before[shared] == first[shared]:
        shared += 1
    keys, rows, bytes_below = prefix_keys(first[:shared]), [], 0
    for depth in range(shared, -1, -1):
        bytes_below += before_sizes[depth - 1] if depth else 0
        rows.append((keys[depth], -1 if depth < shared else 0, -1 if shared == len(before) else 0, bytes_below))
    return rows


def trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations."""
    spark = conversations.sparkSession
    whole = stored(rebuilt(stored(encoded(stored(turns_of(conversations), "trie-turns")), "trie-lists")), "trie-rebuilt")
    ranged = stored(sequences(whole), "trie-sequences").repartitionByRange(partitions(spark), "ids").sortWithinPartitions("ids")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        out = []
        for row in range_nodes(TaskContext.get().partitionId(), rows) if rows else ():
            out.append(row)
            if len(out) == 4096:
                yield rows_of(NODES, out)
                out = []
        yield rows_of(NODES, out)

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield rows_of(SUMS, corrections(*row))

    nodes = stored(ranged.select("ids", "sizes", "n", "conv_id", "ends_sha256").mapInArrow(build, NODES), "trie-nodes")
    in_order = Window.orderBy("shard")  # a row per range
    edges = nodes.filter("first IS NOT NULL").select(
        F.lag("last").over(in_order).alias("before"), F.lag("last_sizes").over(in_order).alias("before_sizes"), "first"
    )
    twice = edges.filter("before IS NOT NULL").mapInArrow(correct, SUMS)
    parts = nodes.filter("key IS NOT NULL").select(
        "key", "up", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    merged = parts.unionByName(twice, allowMissingColumns=True).groupBy("key").agg(
        F.min("up").alias("up"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    merged = stored(merged, "trie-merged")
    inner = nodes.filter("key IS NULL AND first IS NULL")
    below = inner.filter("up IS NOT NULL").drop("parent_conv_id").unionByName(merged, allowMissingColumns=True)
    above = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    found = inner.filter("up IS NULL").unionByName(below.join(above, "up", "left"), allowMissingColumns=True)
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )


#: Every prefix as text, each node's subtree by comparing all pairs of nodes.
SQL = f"""
WITH turns AS (
  SELECT conv_id, strlen(coalesce(text, '')) AS size, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said, turn
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS place FROM turns),
convs AS (SELECT DISTINCT conv_id, {CRC32.format("conv_id")} % {BORROWED} AS h FROM turns),
again AS (
  SELECT c.conv_id, 0 AS part, b.place, b.said, b.size
  FROM convs c JOIN numbered b ON b.conv_id = c.conv_id - c.conv_id % {STRIDE} AND b.place <= c.h
  UNION ALL SELECT conv_id, 1, place, said, size FROM numbered JOIN convs USING (conv_id) WHERE place > h),
paths AS (
  SELECT conv_id, size, row_number() OVER w AS depth, string_agg(said, '') OVER w AS path
  FROM again WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
reached AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths),
nodes AS (
  SELECT path, left(path, length(path) - 64) AS up, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM reached GROUP BY path, depth),
children AS (SELECT up AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
sums AS (
  SELECT a.path, sum((b.n - 1) * b.size) AS saved, count(*) FILTER (b.n_children = 0) AS n_leaves
  FROM counted a JOIN counted b ON starts_with(b.path, a.path) GROUP BY a.path)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s USING (path) LEFT JOIN counted p ON c.depth > 0 AND p.path = c.up
"""
