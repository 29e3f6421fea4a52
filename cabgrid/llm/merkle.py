"""Merkle manifest of a dataset: a leaf per row, a 16-ary tree per source, a tree over the sources' roots.

Bitmap-rank indexing places the leaves without sorting them. Per source the ids
form a compressed bitmap: a row per word of 64 ids that holds any, merged with
bitwise or. Above the words lies a directory of counts, 512 entries to one
entry of the next level, as many levels as the range of ids needs; no group of it
exceeds 512 rows. A leaf's place is what the directory counts before its word
plus the ones below its bit.

Places are keyed slots: rows with the same ``place >> 8`` fill an array of 256
slots, in any order, which two levels of hashing reduce to one node. Rounds of
this end at one node a source, and the same over sources gives the root. Proofs
come down the same way: the nodes of a block share all that lies above it, so
that travels once a block and not once a leaf.

Cases: null columns hash as ``-``; a null source is the first tree; leaves of
null ids come first in their source; rows of one id and source, and of null
ids, are ordered by leaf and each is a leaf of its own (equal ones are counted before
they are shuffled and dealt out again). An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import partitions, rows_of, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
#: Children of a node, and levels that one round reduces.
WIDTH, LEVELS = 16, 2
SLOT_BITS = 8
#: Ids a word, and words or entries an entry of the next level, as powers of two.
WORD_BITS, FAN_BITS = 6, 9
#: Copies of one row that one task deals out.
COPIES = 4096
DIGITS = 64
NODES = "tree string, place long, n long, digest string"
ABOVE = "tree string, place long, n long, tail string, path array<int>, subroot string, root string"
PROVED = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def hashed_leaves(docs: DataFrame) -> DataFrame:
    """``tree`` (sorts like the source, null first), id, leaf, and the leaf of the tampered row where it is tampered with."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    def leaf(text: Column) -> Column:
        return F.sha2(F.concat(*(field(F.col(name)) for name in FIELDS[:-1]), field(text)), 256)

    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), "source"), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("leaf"),
        F.when(chosen & F.col("text").isNotNull(), leaf(lowered)).alias("changed"),
    )


def _before(of: str, *by: str) -> Column:
    """What ``of`` sums to in the rows before, in the order of the last column and within all others."""
    *groups, order = by
    window = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(of).over(window), F.lit(0))


def bitmaps(leaves: DataFrame) -> DataFrame:
    """Each tree's words: the ones in it, what lies before it, and ids that more than one row has."""
    ids = leaves.filter("doc_id IS NOT NULL").groupBy("tree", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    bit = F.expr(f"CAST(doc_id & {(1 << WORD_BITS) - 1} AS INT)")
    repeated = F.when(F.col("rows") > 1, F.struct(bit.alias("bit"), "rows"))
    words = ids.groupBy("tree", F.shiftright("doc_id", WORD_BITS).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(doc_id & {(1 << WORD_BITS) - 1} AS INT))")).alias("bits"),
        F.sum("rows").alias("rows"),
        F.collect_list(repeated).alias("repeated"),  # at most 64
    )
    return stored(words, "merkle-words")


def directory(words: DataFrame, totals: DataFrame) -> DataFrame:
    """``words`` with ``before``, the leaves of its tree before it, and ``n``, all of them."""
    low, high = words.agg(F.min("word"), F.max("word")).first()
    levels = [words.select("tree", F.col("word").alias("entry"), "rows")]
    while low is not None and (high >> FAN_BITS * (len(levels) - 1)) - (low >> FAN_BITS * (len(levels) - 1)) >= 1 << FAN_BITS:
        finer = levels[-1].withColumn("entry", F.shiftright("entry", FAN_BITS))
        levels.append(finer.groupBy("tree", "entry").agg(F.sum("rows").alias("rows")))
    top = levels.pop().withColumn("inside", _before("rows", "tree", "entry")).join(totals, "tree")
    known = top.select("tree", "entry", (F.col("inside") + F.col("nulls")).alias("before"), "n")
    while levels:
        finer = levels.pop().withColumn("above", F.shiftright("entry", FAN_BITS))
        finer = finer.withColumn("inside", _before("rows", "tree", "above", "entry"))
        coarse = known.select("tree", F.col("entry").alias("above"), F.col("before").alias("base"), "n")
        known = finer.join(coarse, ["tree", "above"]).select("tree", "entry", (F.col("base") + F.col("inside")).alias("before"), "n")
    return words.join(known.withColumnRenamed("entry", "word"), ["tree", "word"]).drop("rows")


def placed(leaves: DataFrame) -> DataFrame:
    """Every leaf with its place in its tree and the tree's leaves ``n``."""
    totals = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    index = directory(bitmaps(leaves), totals)
    bit = f"CAST(doc_id & {(1 << WORD_BITS) - 1} AS INT)"
    ranked = leaves.withColumn("word", F.shiftright("doc_id", WORD_BITS)).join(index, ["tree", "word"]).select(
        "tree",
        "doc_id",
        "leaf",
        "changed",
        "n",
        F.expr(
            f"before + bit_count(bits & ~shiftleft(-1L, {bit}))"
            f" + aggregate(filter(repeated, x -> x.bit < {bit}), 0L, (s, x) -> s + x.rows - 1)"
        ).alias("place"),
        F.expr(f"exists(repeated, x -> x.bit = {bit})").alias("tied"),
    )
    ranked = stored(ranked, "merkle-ranked")
    nulls = leaves.filter("doc_id IS NULL").join(totals, "tree").select("tree", "doc_id", "leaf", "changed", "n", F.lit(0).cast("long").alias("place"))
    tied = ranked.filter("tied").drop("tied").unionByName(nulls)
    return ranked.filter("NOT tied").drop("tied").unionByName(in_leaf_order(tied))


def in_leaf_order(tied: DataFrame) -> DataFrame:
    """Rows that share a place, moved on by the rows of it with smaller leaves: first by the leaf's head, then within."""
    rows = tied.withColumn("head", F.substring("leaf", 1, 4)).groupBy(*tied.columns, "head").agg(F.count(F.lit(1)).alias("rows"))
    heads = rows.groupBy("tree", "place", "head").agg(F.sum("rows").alias("rows"))
    heads = heads.withColumn("base", _before("rows", "tree", "place", "head")).drop("rows")
    rows = rows.join(heads, ["tree", "place", "head"])
    first = F.col("place") + F.col("base") + _before("rows", "tree", "place", "head", "leaf")
    rows = rows.withColumn("place", first).withColumn("copy", F.explode(F.expr(f"sequence(0, rows - 1, {COPIES})")))
    spread = rows.repartition(partitions(tied.sparkSession), "tree", "place", "copy")
    copies = F.explode(F.expr(f"sequence(copy, least(copy + {COPIES}, rows) - 1)"))
    return spread.withColumn("copy", copies).withColumn("place", F.col("place") + F.col("copy")).select(*tied.columns)


def digest(run: str) -> str:
    return sha256(run.encode()).hexdigest()


def runs_of(slots: list[str], count: int) -> list[list[str]]:
    """The runs of each level that a block reduces: its nodes joined by sixteen, then those runs' hashes likewise.

    ``count`` is the tree's number of nodes at the block's own level; a tree of one node isn't reduced any more.
    """
    levels, nodes = [], slots
    while len(levels) < LEVELS and count > 1:
        levels.append(["".join(nodes[at : at + WIDTH]) for at in range(0, len(nodes), WIDTH)])
        nodes = [digest(run) for run in levels[-1]]
        count = -(-count // WIDTH)
    return levels


def blocks_of(batches: Iterator[pa.RecordBatch], key: tuple[str, str] = ("tree", "block")) -> Iterator[list[dict]]:
    """The rows of each run of equal keys; a block has at most 256 nodes and one row of what lies above."""
    last, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = row[key[0]], row[key[1]]
            if now != last and held:
                yield held
                held = []
            last = now
            held.append(row)
    if held:
        yield held


def _dealt(nodes: DataFrame) -> DataFrame:
    """Blocks side by side."""
    by = ["tree", "block"]
    return nodes.withColumn("block", F.shiftright("place", SLOT_BITS)).repartition(partitions(nodes.sparkSession), *by).sortWithinPartitions(*by)


def slots_of(rows: list[dict]) -> list[str]:
    slots = [""] * len(rows)
    for row in rows:
        slots[row["place"] & (1 << SLOT_BITS) - 1] = row["digest"]
    return slots


def nodes_at(n: int, at: int) -> int:
    """How many nodes a tree of ``n`` leaves has after ``at`` rounds."""
    return -(-n // WIDTH ** (LEVELS * at))


def climbed(nodes: DataFrame, at: int) -> DataFrame:
    """The nodes after one more round."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in blocks_of(batches):
            levels = runs_of(slots_of(rows), nodes_at(rows[0]["n"], at))
            (top,) = [digest(run) for run in levels[-1]] if levels else [rows[0]["digest"]]
            out.append((rows[0]["tree"], rows[0]["block"], rows[0]["n"], top))
            if len(out) == 4096:
                yield rows_of(NODES, out)
                out = []
        yield rows_of(NODES, out)

    return _dealt(nodes.select("tree", "place", "n", "digest")).mapInArrow(reduce, NODES)


def rounds_of(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored nodes that enter each round, and the one node that each tree ends with."""
    entering, ended, most = [nodes], [], nodes.agg(F.max("n")).first()[0]
    while True:
        after = stored(climbed(entering[-1], len(entering) - 1), "merkle-nodes")
        reach = WIDTH ** (LEVELS * len(entering))
        ended.append(after.filter(F.col("n") <= reach))
        if most is None or most <= reach:
            break
        entering.append(after.filter(F.col("n") > reach))
    roots = ended[0]
    for more in ended[1:]:
        roots = roots.unionByName(more)
    return entering, roots


def _without(run: str, slot: int) -> str:
    return run[: slot * DIGITS] + run[(slot + 1) * DIGITS :]


def _with(others: str, slot: int, own: str) -> str:
    return others[: slot * DIGITS] + own + others[slot * DIGITS :]


def fold(own: str, tail: str, path: list[int]) -> str:
    """The root that a node and its siblings give; ``path`` has its slot and the run's length, level by level."""
    at = 0
    for slot, length in zip(path[::2], path[1::2]):
        after = at + (length - 1) * DIGITS
        own, at = digest(_with(tail[at:after], slot, own)), after
    return own


def came_down(nodes: DataFrame, above: DataFrame, at: int, schema: str, emit: Callable[[dict, str, list[int], dict], tuple]) -> DataFrame:
    """Rows that ``emit`` makes of each node, its siblings from its own level to the root, its path, and its block's top."""
    own = [name for name in nodes.columns if name not in ("tree", "place", "n", "digest")]
    tops = above.withColumn("block", F.col("place")).drop("place")
    members = nodes.withColumn("block", F.shiftright("place", SLOT_BITS))
    by = ["tree", "block"]
    both = members.unionByName(tops, allowMissingColumns=True)
    both = both.repartition(partitions(nodes.sparkSession), *by).sortWithinPartitions(*by)
    wanted = ["tree", "block", "place", "n", "digest", *own, "tail", "path", "subroot", "root"]

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in blocks_of(batches):
            (top,) = [row for row in rows if row["place"] is None]
            rows = [row for row in rows if row["place"] is not None]
            levels = runs_of(slots_of(rows), nodes_at(rows[0]["n"], at))
            for row in rows:
                slot, tail, path = row["place"] & (1 << SLOT_BITS) - 1, [], []
                for runs in levels:
                    slot, inside = divmod(slot, WIDTH)
                    tail.append(_without(runs[slot], inside))
                    path += [inside, len(runs[slot]) // DIGITS]
                out.append(emit(row, "".join(tail) + top["tail"], path + top["path"], top))
                if len(out) == 1024:
                    yield rows_of(schema, out)
                    out = []
        yield rows_of(schema, out)

    return both.select(*wanted).mapInArrow(descend, schema)


def _carried(row: dict, tail: str, path: list[int], top: dict) -> tuple:
    return row["tree"], row["place"], row["n"], tail, path, top["subroot"], top["root"]


def _crowned(row: dict, tail: str, path: list[int], top: dict) -> tuple:
    return row["name"], 0, row["leaves"], tail, path, row["digest"], top["root"]


def _proved(row: dict, tail: str, path: list[int], top: dict) -> tuple:
    folded = fold(row["changed"] or row["digest"], tail, path)
    source = row["tree"][1:] if row["tree"] else None
    return row["doc_id"], source, row["digest"], top["subroot"], top["root"], digest(tail), folded, folded == top["root"]


def numbered(roots: DataFrame) -> DataFrame:
    """The trees' roots as nodes of one tree, in the order of their sources: numbers within ranges, then ranges' counts."""
    spread = roots.repartitionByRange(partitions(roots.sparkSession), "tree").sortWithinPartitions("tree")
    spread = stored(spread.withColumn("at", F.monotonically_increasing_id()), "merkle-roots")
    spread = spread.withColumn("range", F.shiftright("at", 33)).withColumn("at", F.expr(f"at & {(1 << 33) - 1}"))
    counts = spread.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    window = Window.orderBy("range")  # a row per range
    counts = counts.select("range", F.coalesce(F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return spread.join(counts, "range").select(
        F.lit("").alias("tree"),
        (F.col("first") + F.col("at")).alias("place"),
        F.lit(spread.count()).cast("long").alias("n"),
        "digest",
        F.col("tree").alias("name"),
        F.col("n").alias("leaves"),
    )


def _descended(entering: list[DataFrame], ends: DataFrame, last: Callable[..., tuple], schema: str) -> DataFrame:
    """From the roots of trees (``ends``) down to their leaves, round by round."""
    down = None
    for at in reversed(range(len(entering))):
        reach = WIDTH ** (LEVELS * at), WIDTH ** (LEVELS * (at + 1))
        here = ends.filter((F.col("n") <= reach[1]) & ((F.col("n") > reach[0]) | F.lit(at == 0)))
        above = here if down is None else here.unionByName(down)
        if at == 0:
            return came_down(entering[0], above, 0, schema, last)
        down = stored(came_down(entering[at], above, at, ABOVE, _carried), "merkle-above")
    raise ValueError("no rounds")


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its leaf, its tree's root, the root, its proof, and the check of the tampered row."""
    leaves = stored(hashed_leaves(docs), "merkle-leaves")
    nodes = placed(leaves).withColumnRenamed("leaf", "digest")
    nodes = stored(nodes.select("tree", "place", "n", "digest", "doc_id", "changed"), "merkle-placed")
    entering, subroots = rounds_of(nodes)
    sources = stored(numbered(subroots), "merkle-sources")
    of_sources, root = rounds_of(sources)
    crown = root.select(
        "tree", "place", "n", F.lit("").alias("tail"), F.expr("CAST(array() AS array<int>)").alias("path"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    tops = stored(_descended(of_sources, crown, _crowned, ABOVE), "merkle-above")
    return _descended(entering, tops, _proved, PROVED)


#: crc32 of a number's decimal text, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def manifest_sql(levels: int = 8) -> str:
    """The same for DuckDB, level by level; ``levels`` of them reach 16**levels leaves a source."""

    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join([*map(field, FIELDS[:-1]), field(text)])})"

    def climb(name: str) -> list[str]:
        steps = []
        for k in range(levels):
            steps += [
                f"{name}_run{k} AS (SELECT tree, place // {WIDTH} AS run, n, list(digest ORDER BY place) AS digests"
                f" FROM {name}{k} WHERE n > 1 GROUP BY ALL)",
                f"{name}{k + 1} AS (SELECT tree, run AS place, (n + {WIDTH - 1}) // {WIDTH} AS n,"
                f" sha256(array_to_string(digests, '')) AS digest FROM {name}_run{k})",
            ]
        ends = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
        return [*steps, f"{name}_end AS ({ends})"]

    def walk(name: str, start: str) -> list[str]:
        steps = [f"{name}_walk0 AS ({start})"]
        for k in range(levels):
            own = f"CAST(w.place // {WIDTH**k} % {WIDTH} AS BIGINT)"
            steps.append(
                f"{name}_walk{k + 1} AS (SELECT w.* REPLACE (CASE WHEN digests IS NULL THEN tail ELSE"
                f" tail || array_to_string(list_concat(digests[1:{own}], digests[{own} + 2:]), '') END AS tail,"
                f" CASE WHEN digests IS NULL THEN folded ELSE"
                f" sha256(array_to_string(list_concat(digests[1:{own}], [folded], digests[{own} + 2:]), '')) END AS folded)"
                f" FROM {name}_walk{k} w LEFT JOIN {name}_run{k} r ON r.tree = w.tree AND r.run = w.place // {WIDTH ** (k + 1)})"
            )
        return steps

    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    chosen = f"{CRC32.format('doc_id')} % {TAMPERED} = 0 AND text IS NOT NULL"
    steps = [
        f"hashed AS (SELECT coalesce('+' || source, '') AS tree, source, doc_id, {leaf('text')} AS leaf,"
        f" CASE WHEN {chosen} THEN {leaf(lowered)} END AS changed FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed)",
        "leaf0 AS (SELECT tree, place, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest FROM placed)",
        *climb("leaf"),
        "source0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n, digest FROM leaf_end)",
        *climb("source"),
        *walk("leaf", "SELECT *, '' AS tail, coalesce(changed, leaf) AS folded FROM placed"),
        *walk(
            "source",
            "SELECT w.* EXCLUDE (tree, place), '' AS tree, s.place, e.digest AS subroot"
            f" FROM leaf_walk{levels} w JOIN leaf_end e ON e.tree = w.tree"
            " JOIN (SELECT tree AS name, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM leaf_end) s ON s.name = w.tree",
        ),
    ]
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, source, leaf, subroot, (SELECT digest FROM source_end) AS root,"
        " sha256(tail) AS proof_sha256, folded AS folded_root, folded = (SELECT digest FROM source_end) AS verified"
        f" FROM source_walk{levels}"
    )
