import random
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cabgrid.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def key(role, text):
    role, text = role or "", text or ""
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), len(text.encode())


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, *key(role, text)))
    lists = {c: [(x[2], x[3]) for x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole[c] = tuple(lists.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = Counter(seq[:-1] for seq in members if seq)
    leaves, saved = Counter(), Counter()
    for seq, cs in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not children[seq]
            saved[seq[:d]] += (len(cs) - 1) * (seq[-1][1] if seq else 0)
    out = Counter()
    for seq, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(whole[c]) == len(seq))
        parent = min(members[seq[:-1]]) if seq else None
        digest = sha256(ends.encode()).hexdigest()
        out[min(cs), len(seq), parent, len(cs), children[seq], leaves[seq], saved[seq], digest] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in prefix_trie.trie(df).collect())


def made(seed, convs, texts, most):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 3 * convs), convs):
        for turn in range(rng.randrange(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), f"té{rng.randrange(texts)}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, texts, most", [(1, 120, 2, 7), (2, 60, 1, 12), (3, 200, 50, 4)])
def test_against_all_prefixes(spark, conf, seed, convs, texts, most):
    rows = made(seed, convs, texts, most)
    conf(spark__sql__shuffle__partitions="13")
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_hot_beginnings_and_copies(spark, conf):
    """Many conversations with the same turns, and many that differ after a common beginning."""
    rows = [(c, t, "user", f"common {t}") for c in range(80) for t in range(4)]
    rows += [(c, t, "user", f"common {t}" if t < 3 else f"{c}") for c in range(100, 180) for t in range(5)]
    conf(spark__sql__shuffle__partitions="11")
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_nulls_repeats_long_and_empty(spark):
    rows = [(5, None, None, None), (5, None, "user", None), (5, 1, None, "x"), (5, 1, None, "x"), (6, 2, "user", "")]
    rows += [(None, 1, "user", "lost"), (7, 1, "user", "y" * 200_000), (0, 0, "a", "b"), (1, 0, "a", "b"), (-3, 0, "a", "b")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS said", "1 AS id", "2 AS n", "3 AS key")
    assert got(frame) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == Counter()
    long = [(10, t, "user", f"{t % 7}") for t in range(150)] + [(11, t, "user", f"{t % 7}") for t in range(120)]
    assert got(spark.createDataFrame(long, SCHEMA)) == brute(long)


@given(st.lists(st.lists(st.integers(0, 3), max_size=5).map(tuple), min_size=1, max_size=25, unique=True), st.integers(1, 25))
@settings(max_examples=200, deadline=None)
def test_ranges_add_up(found, cuts):
    """However sorted sequences are cut into ranges, partial sums and corrections give each prefix's totals."""
    found = sorted(found)
    n = {seq: at % 3 + 1 for at, seq in enumerate(found)}
    edges = sorted({0, len(found), *(i * len(found) // cuts for i in range(cuts))})
    sums, before = Counter(), None
    for shard, (a, b) in enumerate(zip(edges, edges[1:])):
        rows = [(list(s), [abs(x) + 1 for x in s], n[s], 0, "") for s in found[a:b]]
        *nodes, edge = prefix_trie.range_nodes(shard, rows)
        keys = {}
        for seq in found[a:b]:
            keys.update(zip((seq[:d] for d in range(len(seq) + 1)), prefix_trie.prefix_keys(seq)))
        assert {x[1] for x in nodes} <= {*keys.values(), None}
        for x in nodes:
            if x[1] is not None:
                for name, value in zip("nclv", (x[6], x[7], x[8], x[9])):
                    sums[x[1], name] += value
        if before:
            for k, *values in prefix_trie.corrections(*before, edge[11]):
                for name, value in zip("clv", values):
                    sums[k, name] += value
        before = edge[13], edge[14]
    prefixes = {s[:d] for s in found for d in range(len(s) + 1)}
    of = {}
    for seq in found:
        of.update(zip((seq[:d] for d in range(len(seq) + 1)), prefix_trie.prefix_keys(seq)))
    for p in prefixes:
        if not any(k == of[p] for k, _ in sums):
            continue
        below = [q for q in prefixes if q[: len(p)] == p]
        count = {q: sum(n[s] for s in found if s[: len(q)] == q) for q in below}
        assert sums[of[p], "n"] == count[p]
        assert sums[of[p], "c"] == sum(len(q) == len(p) + 1 for q in below)
        assert sums[of[p], "l"] == sum(not any(r[:-1] == q for r in prefixes if r) for q in below)
        assert sums[of[p], "v"] == sum((count[q] - 1) * (abs(q[-1]) + 1 if q else 0) for q in below)


def test_sibling_trees_are_balanced():
    tree = prefix_trie.TernaryTree()
    for at in prefix_trie.median_first(1023):
        tree.insert([at], [1], 1, at, at)
    depth = {0: 0}
    for at in range(1, len(tree.turn)):
        for links in (tree.lower, tree.higher):
            if links[at] >= 0:
                depth[links[at]] = depth.get(at, 0) + 1
    assert max(depth.values()) == 9
