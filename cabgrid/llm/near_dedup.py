"""Near-duplicate documents by Order MinHash and banded alignment.

A text is its sequence of five-word shingles (all words, where it has fewer
than five). For the sketches each is labelled with how often it has occurred so far. For each of
``SKETCHES`` hash functions the ``LEAST`` labelled shingles with the least
hashes are taken and put back into text order; one hash of that short sequence
is the sketch. A text in which shingles recur has further sketches, whose labels
count from its end, as an edit renumbers the copies behind it. Two texts agree in a sketch about as often as a random few of
their shingles are common to both and stand in the same order.

Texts that agree in a sketch are compared by a banded alignment of their
shingle sequences, without labels: a passage that recurs aligns with any of its copies. With ``m`` shingles aligned out of ``a`` and ``b`` their
likeness is ``m / (a + b - m)``; from 0.8 on they are linked. The band is no
approximation: texts that alike differ by at most (a + b) / 9 shingles, so an
alignment never leaves it. Linked texts form classes. A pair of long texts
at the threshold without recurring shingles is missed by all sketches three times in 10**5.

Of few shingles a sketch tells too little, so texts of up to ``SHORT`` have an exact way in place of
sketches. Alike texts have at least 0.8 of the longer one's labelled shingles in common. So if all
are sorted by how many texts have them, the rarest first, two alike texts share one of the
first ``size - ceil(0.8 size) + 1``, and those are their buckets. Texts up to ``SHORT / 0.8`` long, which may be alike to a
short one, have both kinds. A frequent passage is nobody's rarest and makes no bucket.

Members of a bucket are sorted into steps of length, of which only neighbours
can be alike. First every member is compared with one anchor of its step and of
the steps beside it, its bucket's least digest there; buckets left with a single class, such as those of
near copies of one text, are done, and the work was linear. In the others each
remaining pair of different classes is looked at in blocks of bounded size,
whose common shingles are counted at once; only pairs that may reach the
threshold are aligned, and only links, never pairs, leave a task.

Cases: a null text equals an empty one. Equal texts are always one class. A
text without words is linked to no other text. Rows that repeat an id stay or
go by their text; of rows that repeat both, one counts as kept. A class is named after
its least id (null where it has none). An empty table gives no rows. Columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.llm.common import batch_of, partitions, parts, rows_of, stored, texts
from cabgrid.llm.exact_dedup import first_rows, row_key
from cabgrid.llm.words import Rolling, as_long, mixed, split, words_of

SHINGLE = 5
LIKENESS = 0.8
SKETCHES = 20
LEAST = 4
#: Texts of up to so many shingles have no sketches, but buckets by their rarest shingles.
SHORT = 20
#: Texts and shingles of a block, and shingles counted at once for all pairs of two blocks.
BLOCK_TEXTS = 512
BLOCK_SHINGLES = 400_000
COLUMNS = 4096
SKETCHED = "doc_id long, digest string, size int, sketches array<long>, few array<long>"
VERDICTS = "a string, b string, alike boolean"
U = np.uint64


def labelled(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Shingle hashes mixed with their occurrence number within their text."""
    key = mixed(hashes + of.astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    new = np.append([True], np.diff(key[order]) != 0)[: len(key)]
    start = np.nonzero(new)[0]
    nth = np.arange(len(key)) - start[np.cumsum(new) - 1]
    if nth.any():
        count = np.empty(len(key), dtype=U)
        count[order] = nth.astype(U)
        return mixed(hashes + count * U(0xD6E8FEB86659FD93))
    return mixed(hashes)


def shingles_of(texts_: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all texts end to end, the text of each, and the number of each text."""
    words = words_of(texts_)
    n = words.end - words.begin
    sizes = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    of = np.repeat(np.arange(len(texts_)), sizes)
    first = words.begin[of] + np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of]
    return Rolling(words.hashes).of(first, np.minimum(SHINGLE, n)[of]), of, sizes


def sketches(shingles: np.ndarray, of: np.ndarray, sizes: np.ndarray, count: int = SKETCHES, least: int = LEAST, back: bool = False) -> np.ndarray:
    """One row of ``count`` sketches per text, with labels from its start or its end; texts without shingles give zeros."""
    out = np.zeros((len(sizes), count), dtype=U)
    shingles = labelled(shingles[::-1], of[::-1])[::-1] if back else labelled(shingles, of)
    # Some 40 of a text's shingles lie below its bound; where fewer than needed do, all are looked at.
    share = np.minimum(1.0, 40 / np.maximum(sizes, 1))
    bound = np.where(share < 1, share * 2.0**64, 2.0**64 - 2048).astype(U)[of]
    for turn in range(count):
        value = shingles * U(2 * (turn * 0x9E3779B97F4A7C15 % (1 << 62)) + 1)
        value = value ^ (value >> U(29))
        value = value * U(0xD6E8FEB86659FD93)
        value = value ^ (value >> U(32))
        low = np.nonzero(value <= bound)[0]
        few = np.bincount(of[low], minlength=len(sizes)) < np.minimum(sizes, least)
        if few.any():
            low = np.union1d(low, np.nonzero(few[of])[0])
        text = of[low]
        order = np.lexsort((value[low], text))
        text, place = text[order], low[order]
        begin = np.searchsorted(text, np.arange(len(sizes)))
        rank = np.arange(len(text)) - begin[text]
        text, place = text[rank < least], place[rank < least]
        order = np.lexsort((place, text))
        text, place = text[order], place[order]
        rank = np.arange(len(text)) - np.searchsorted(text, np.arange(len(sizes)))[text]
        sign = np.full(len(sizes), turn, dtype=U)
        for at in range(least):
            now = rank == at
            sign[text[now]] = mixed(sign[text[now]] * U(31) + shingles[place[now]])
        out[:, turn] = mixed(sign + U(turn))
    return out


def all_sketches(shingles: np.ndarray, of: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The sketches of each text, from both ends where shingles recur in it."""
    out = list(as_long(sketches(shingles, of, sizes)))
    again = np.unique(of[labelled(shingles, of) != mixed(shingles)])
    if len(again):
        some = np.isin(of, again)
        more = as_long(sketches(shingles[some], np.searchsorted(again, of[some]), sizes[again], back=True))
        for text, row in zip(again, more):
            out[text] = np.append(out[text], row)
    return out


def sketched(docs: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc_ids, digests, found = batch.columns
            shingles, of, sizes = shingles_of(found.to_pylist())
            signs: list = [[]] * len(sizes)
            long = np.nonzero(sizes > SHORT)[0]
            if len(long):
                some = np.isin(of, long)
                for text, row in zip(long, all_sketches(shingles[some], np.searchsorted(long, of[some]), sizes[long])):
                    signs[text] = row
            names, begin = as_long(labelled(shingles, of)), np.cumsum(sizes) - sizes
            few = [names[b : b + n] if n <= SHORT / LIKENESS else [] for b, n in zip(begin.tolist(), sizes.tolist())]
            yield batch_of(SKETCHED, doc_ids, digests, sizes, signs, few)

    keyed = texts(docs).select("doc_id", F.md5("text").alias("digest"), "text")
    return keyed.mapInArrow(emit, SKETCHED)


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Longest common subsequence of two sequences within ``band`` of the diagonal, bit-parallel."""
    if not a or not b:
        return 0
    places: dict[int, int] = {}
    for at, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << at
    full = (1 << len(a)) - 1
    row, width = full, (1 << (2 * band + 1)) - 1
    for at, x in enumerate(b):
        match = places.get(x)
        if match is None:
            continue
        match &= width << (at - band) if at >= band else width >> (band - at)
        hit = row & match
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def alike(a: np.ndarray, b: np.ndarray, likeness: float = LIKENESS) -> bool:
    """Whether two sequences of shingles reach ``likeness``."""
    need = likeness / (1 + likeness) * (len(a) + len(b)) - 1e-9
    if min(len(a), len(b)) < need:
        return False
    # Labels make the shingles of a text differ, so this counts what is common with repeats.
    once = (labelled(x, np.zeros(len(x), dtype=np.int64)) for x in (a, b))
    if len(np.intersect1d(*once, assume_unique=True)) < need:
        return False
    short = min(len(a), len(b))
    differ = np.nonzero(a[:short] != b[:short])[0]
    head = int(differ[0]) if len(differ) else short
    a, b, short = a[head:], b[head:], short - head
    differ = np.nonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])[0]
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    band = int(len(a) + len(b) + 2 * (head + tail) - 2 * need) + 1
    return head + tail + aligned(a.tolist(), b.tolist(), band) >= need


def compared(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """``pairs`` of digests with whether their texts are alike."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, most=2_000_000, column="text_a"):
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            rows, cache = [], {}
            for x, y, tx, ty in zip(a, b, text_a, text_b):
                if y not in cache:
                    cache = {y: shingles_of([ty])[0]}
                rows.append((x, y, alike(shingles_of([tx])[0], cache[y])))
            yield rows_of(VERDICTS, rows)

    left = contents.select(F.col("digest").alias("a"), F.col("text").alias("text_a"))
    right = contents.select(F.col("digest").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(emit, VERDICTS)


def stars(links: DataFrame) -> DataFrame:
    """Each node beside the least node of its connected component, from ``a``, ``b`` links; roots are left out.

    Alternates large stars and small stars until nothing changes; each result is stored.
    """
    links = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    state = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return links
        state = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        large = stored(large, "stars")
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").filter("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        links = stored(small.unionByName(least.select("a", F.col("root").alias("b"))).distinct(), "stars")


def links_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Stars that join the digests of linked texts."""
    spark = docs.sparkSession
    kinds = [c for c in ("sketches", "few") if c in found.columns]
    texts_ = found.filter("size > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), *(F.first(c).alias(c) for c in kinds)
    )
    # A sketch holds its turn, and the same from either end.
    sketch = F.explode(F.array_distinct("sketches"))
    spread = texts_.select("digest", "doc_id", "size", sketch.alias("sketch")).withColumn("bucket", F.xxhash64("sketch")).drop("sketch")
    if "few" in kinds:
        spread = spread.unionByName(rarest(texts_))
    # Texts that are alike are at most one step of length apart.
    spread = spread.withColumn("step", F.floor(F.log("size") / math.log(1 / LIKENESS)).cast("int"))
    shared = spread.groupBy("bucket").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low < high")
    members = stored(spread.join(shared.select("bucket"), "bucket"), "near-buckets")
    # One row of each text is fetched, by its id, so that copies of a text don't travel; by digest where it has no id.
    wanted = members.select("digest", "doc_id").distinct()
    rows = texts(docs).select("doc_id", F.md5("text").alias("digest"), "text")
    by_id = rows.join(wanted.select("doc_id", F.col("digest").alias("wanted")), "doc_id").filter("digest = wanted")
    no_id = rows.filter("doc_id IS NULL").join(wanted.filter("doc_id IS NULL").select("digest"), "digest", "left_semi")
    found_texts = by_id.select("digest", "text").unionByName(no_id.select("digest", "text"))
    contents = stored(found_texts.dropDuplicates(["digest"]), "near-texts")
    members = members.drop("doc_id")
    members = still_open(members, spark.createDataFrame([], "a string, b string"))
    anchors = members.groupBy("bucket", "step").agg(F.min(F.struct("digest", "size")).alias("anchor"))
    near_steps = F.explode(F.array(*(F.col("step") + d for d in (-1, 0, 1))))
    fits = F.least("size", "anchor.size") >= LIKENESS * F.greatest("size", "anchor.size")
    pairs = (
        members.join(anchors.select("bucket", near_steps.alias("step"), "anchor"), ["bucket", "step"])
        .filter((F.col("digest") != F.col("anchor.digest")) & fits)
        .select(F.greatest("digest", "anchor.digest").alias("a"), F.least("digest", "anchor.digest").alias("b"))
        .distinct()
    )
    links = stars(compared(pairs, contents).filter("alike").select("a", "b"))
    return stars(links.unionByName(compared_in_blocks(still_open(members, links), contents)))


def rarest(texts_: DataFrame) -> DataFrame:
    """Buckets of texts of few shingles: any two that are alike share one."""
    each = texts_.select("digest", "doc_id", "size", F.explode("few").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("digest").orderBy("often", "shingle")
    return (
        each.join(often, "shingle")
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= F.col("size") - F.ceil(F.col("size") * LIKENESS - 1e-9) + 1)
        # What one text alone has is in its order, but in no bucket.
        .filter("often > 1")
        .select("digest", "doc_id", "size", F.xxhash64(F.lit("few"), "shingle").alias("bucket"))
    )


def still_open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members, with the class each is in, of the buckets that hold more than one class."""
    label = links.select(F.col("a").alias("digest"), F.col("b").alias("label"))
    labels = members.select("bucket", "step", "digest", "size").join(label, "digest", "left")
    labels = labels.withColumn("label", F.coalesce("label", "digest"))
    still = labels.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y")
    return stored(labels.join(still.select("bucket"), "bucket", "left_semi"), "near-buckets")


def compared_in_blocks(members: DataFrame, contents: DataFrame) -> DataFrame:
    """Links between members of a bucket that are in different classes; every such pair is looked at.

    A bucket of at most ``BLOCK_TEXTS`` texts and ``BLOCK_SHINGLES`` shingles is
    one block. A larger one is dealt to blocks of that size by step and hash,
    and each pair of blocks of the same or of neighbouring steps is a group of its own,
    so no group outgrows two blocks. Pairs never become rows: a group
    counts the common shingles of all its pairs at once, aligns those that may
    reach the threshold, and gives back no more links than it has texts.
    """
    n = partitions(members.sparkSession)
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    whole = members.groupBy("bucket").agg(blocks.alias("blocks"))
    small = members.join(whole.filter("blocks = 1"), "bucket").select(
        "bucket", "digest", "label", F.expr("array(struct(-1 AS low, -1 AS high, 0 AS i, 0 AS j, 0 AS side)) AS places")
    )
    large = members.join(whole.filter("blocks > 1").select("bucket"), "bucket", "left_semi")
    units = large.groupBy("bucket", "step").agg(blocks.alias("blocks"))
    dealt = large.join(units, ["bucket", "step"])
    for name, d in (("above", 1), ("below", -1)):
        dealt = dealt.join(
            units.select("bucket", (F.col("step") - d).alias("step"), F.col("blocks").alias(name)), ["bucket", "step"], "left"
        )
    places = """concat(
      transform(sequence(0, blocks - 1), x -> struct(
        step AS low, step AS high, least(x, block) AS i, greatest(x, block) AS j, IF(block < x, 0, 1) AS side)),
      IF(above > 0, transform(sequence(0, above - 1), x -> struct(
        step AS low, step + 1 AS high, block AS i, x AS j, 0 AS side)), array()),
      IF(below > 0, transform(sequence(0, below - 1), x -> struct(
        step - 1 AS low, step AS high, x AS i, block AS j, 1 AS side)), array())) AS places"""
    dealt = dealt.withColumn("block", F.expr("CAST(pmod(xxhash64(digest), blocks) AS INT)"))
    rows = small.unionByName(dealt.select("bucket", "digest", "label", F.expr(places)))
    rows = rows.select("bucket", "digest", "label", F.explode("places").alias("place")).select(
        "bucket", "digest", "label", "place.*"
    )
    group = ["bucket", "low", "high", "i", "j"]
    spread = rows.join(contents, "digest").repartition(n, *group).sortWithinPartitions(*group, "digest")
    return spread.select(*group, "side", "digest", "label", "text").mapInArrow(linked_groups, "a string, b string")


def linked_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links found in each run of rows with the same group."""
    last, held = None, []
    for batch in parts(batches):
        found: list[tuple[str, str]] = []
        for *key, side, digest, label, text in zip(*(c.to_pylist() for c in batch.columns)):
            if key != last:
                found += links_in(held, last)
                last, held = key, []
            held.append((side, digest, label, text))
        yield rows_of("a string, b string", found)
    yield rows_of("a string, b string", links_in(held, last))


def links_in(rows: list[tuple[int, str, str, str]], key: list | None) -> list[tuple[str, str]]:
    """Links that join different classes among ``rows``; between two blocks, only pairs across them are looked at."""
    if len({label for _, _, label, _ in rows}) < 2:
        return []
    across = key[1] != key[2] or key[3] != key[4]
    shingles, of, sizes = shingles_of([text for *_, text in rows])
    bounds = np.append(0, np.cumsum(sizes))
    names, place, often = np.unique(labelled(shingles, of), return_inverse=True, return_counts=True)
    twice = np.cumsum(often > 1) - 1
    keep = often[place] > 1
    column, row = twice[place[keep]], of[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((len(rows), len(rows)), dtype=np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        there = np.zeros((len(rows), COLUMNS), dtype=np.float32)
        there[row[a:b], column[a:b] - first] = 1
        common += there @ there.T
    need = LIKENESS / (1 + LIKENESS) * (sizes[:, None] + sizes[None, :]) - 1e-6
    side = np.array([r[0] for r in rows])
    may = np.triu((common >= need) & ((side[:, None] != side[None, :]) | (not across)), 1)
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while x in root:
            x = root[x]
        return x

    out = []
    for x, y in np.argwhere(may).tolist():
        one, two = find(rows[x][2]), find(rows[y][2])
        if one != two and alike(shingles[bounds[x] : bounds[x + 1]], shingles[bounds[y] : bounds[y + 1]]):
            root[one] = two
            out.append((rows[x][1], rows[y][1]))
    return out


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its class (the least id in it), the class's rows, whether it is the one that stays."""
    found = stored(sketched(docs), "near-sketches")
    links = links_of(docs, found)
    rows = found.select("doc_id", "digest").join(links.select(F.col("a").alias("digest"), "b"), "digest", "left")
    rows = rows.select("doc_id", "digest", F.coalesce("b", "digest").alias("class"))
    sums = rows.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("least"), F.count(F.lit(1)).alias("class_size"))
    first = Window.partitionBy(row_key("doc_id", F.col("digest"))).orderBy(F.lit(0))
    return (
        rows.join(sums, "class")
        .withColumn("repeat", F.row_number().over(first))
        .select(
            "doc_id",
            F.col("least.doc_id").alias("class_id"),
            "class_size",
            (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("digest") == F.col("least.digest")) & (F.col("repeat") == 1)).alias("kept"),
            F.col("digest").alias("text_md5"),
        )
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    kept = near_classes(docs).filter("kept").select(row_key("doc_id", F.col("text_md5")).alias("key"))
    return first_rows(docs, kept, F.md5(F.coalesce(F.col("text"), F.lit(""))))
