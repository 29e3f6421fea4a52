import zlib
from collections import Counter, defaultdict
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SCHEMA

from cabgrid.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    fields = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return h(*("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root, and each node's siblings and places on the way to it."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[at : at + 16] for at in range(0, len(nodes), 16)]
        levels.append(runs)
        nodes = [h(*run) for run in runs]

    def up(at):
        for runs in levels:
            at, slot = divmod(at, 16)
            yield runs[at][:slot], runs[at][slot + 1 :]

    return nodes[0], up


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        groups[source].sort(key=lambda x: x[:3])
        trees[source] = tree([x[2] for x in groups[source]])
    root, above = tree([trees[s][0] for s in sources]) if sources else (None, None)
    out = Counter()
    for at, source in enumerate(sources):
        for place, (_, _, own, row) in enumerate(groups[source]):
            siblings = [*trees[source][1](place), *above(at)]
            doc_id, text, *_ = row
            tampered = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            folded = leaf(row, lowered(text)) if tampered else own
            for left, right in siblings:
                folded = h(*left, folded, *right)
            proof = h(*(x for left, right in siblings for x in left + right))
            out[doc_id, source, own, trees[source][0], root, proof, folded, folded == root] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in merkle.manifest(df).collect())


def test_whole_corpus(docs, wide, rows):
    want = brute(rows)
    assert got(docs) == want
    assert got(wide) == want
    verified = Counter(row[-1] for row in want.elements())
    assert verified[True] and sum(verified.values()) == len(rows)


def test_many_levels_sources_and_upper_case(spark):
    """Several rounds in one source, lone leaves, ids far apart and negative, more sources than one run holds."""
    rows = [(i * 7 - 2000, f"Text {i} ÄÉ", "en", "big", i) for i in range(700)]
    rows += [(i, f"T{i}", None, f"s{i % 40}", None) for i in range(60)]
    rows += [((-1) ** i * 3**i, "FAR", "en", "far", i) for i in range(39)]
    rows += [(1, "A", "en", None, 1), (1, "A", "en", "", 1), (2, "B", "en", "é", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = brute(rows)
    assert got(frame) == want
    assert {row[-1] for row in want} == {True, False}


def test_ties_nulls_and_empty(spark, repeated, empty):
    assert got(repeated) == brute([tuple(r) for r in repeated.collect()])
    assert got(empty) == Counter()
    rows = [(None, f"t{i % 30}", "en", "s", i % 3) for i in range(300)] + [(4, f"u{i % 9}", "en", "s", 0) for i in range(90)]
    rows += [(5, "same", "en", "s", 0)] * 50
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 7)
    rows = [(5, "same", "en", "s", 0)] * 40 + [(6, "x", "en", "s", 0)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@given(st.lists(st.integers(-(2**63), 2**63 - 1) | st.integers(-300, 300), min_size=1, max_size=40))
@settings(max_examples=5, deadline=None)
def test_places_are_ranks(spark, ids):
    leaves = spark.createDataFrame([("+s", i, f"{at:064x}", None) for at, i in enumerate(ids)], "tree string, doc_id long, leaf string, changed string")
    found = sorted((r["place"], r["doc_id"]) for r in merkle.placed(leaves).collect())
    assert found == list(enumerate(sorted(ids)))
