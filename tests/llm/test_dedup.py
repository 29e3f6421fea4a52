import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cabgrid.llm import exact_dedup, near_dedup, substring_dedup


def test_exact_groups(rows, wide):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    want = {
        (i, max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }
    got = exact_dedup.exact_groups(wide).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


def test_exact_repeats_and_nulls(repeated, empty):
    got = Counter(map(tuple, exact_dedup.exact_groups(repeated).select("doc_id", "keep_id", "group_size", "kept").collect()))
    assert got == Counter(
        [(5, 5, 4, True), (5, 5, 4, False), (5, 5, 4, False), (None, 5, 4, False), (None, 9, 2, False), (9, 9, 2, True), (5, 5, 1, True)]
    )
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_many_copies(spark):
    rows = [(i, "copy" if i % 3 else f"t{i}", "en", "s", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = exact_dedup.exact_groups(df).filter("kept").collect()
    assert len(got) == 1001 and {r.group_size for r in got} == {1, 2000}


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, near_dedup.drop_near_copies])
def test_dropping_keeps_columns_and_one_row(wide, repeated, empty, drop):
    kept = drop(wide)
    assert kept.columns == wide.columns and drop(kept).count() == kept.count()
    # Kept: one of the repeated rows, one of the two empty texts, and the other text.
    assert drop(repeated).count() == 3
    assert drop(empty).count() == 0


def shingles(text):
    words = text.encode().split()
    if len(words) < 5:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for at, y in enumerate(b):
            row.append(last[at] + 1 if x == y else max(last[at + 1], row[-1]))
    return row[-1]


def near_classes(rows):
    """Classes by comparing all pairs that share a shingle."""
    by_text = defaultdict(list)
    for doc_id, text, *_ in rows:
        by_text[text or ""].append(doc_id)
    texts = list(by_text)
    made = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            x, y = made[a], made[b]
            both = sum((Counter(x) & Counter(y)).values())
            if both and both / (len(x) + len(y) - both) >= 0.8:
                m = common(x, y)
                if m / (len(x) + len(y) - m) >= 0.8:
                    root[find(a)] = find(b)
    classes = defaultdict(list)
    for at, text in enumerate(texts):
        classes[find(at)] += by_text[text]
    return {i: (min(ids), len(ids), i == min(ids)) for ids in classes.values() for i in ids}


def test_near_classes(rows, wide):
    got = near_dedup.near_classes(wide).collect()
    assert {r.doc_id: (r.class_id, r.class_size, r.kept) for r in got} == near_classes(rows) and len(got) == len(rows)
    assert max(r.class_size for r in got) >= 9


def test_near_empty(empty):
    assert near_dedup.near_classes(empty).count() == 0


@pytest.mark.parametrize("block", [3, 512])
def test_buckets_of_several_classes_lose_no_link(spark, monkeypatch, block):
    """All texts share one bucket, of one block or of many, and still every pair is compared."""
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    rows = []
    for family in range(7):
        body = [f"f{family}x{i}" for i in range(60 + family)]
        for copy in range(4):
            body[10 * copy] = f"c{family}{copy}"
            rows.append((family * 10 + copy, " ".join(body)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.sketched(df).selectExpr("doc_id", "digest", "size", "array(1L) AS sketches")
    links = near_dedup.links_of(df, found).collect()
    assert len(links) == 21 and len({r.b for r in links}) == 7


def test_alike_equals_the_full_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), 2)) if len(a) > 4 else a.copy()
        a = near_dedup.labelled(a, np.zeros(len(a), np.int64))
        b = near_dedup.labelled(b, np.zeros(len(b), np.int64))
        m = common(a.tolist(), b.tolist())
        assert near_dedup.alike(a, b) == (m / (len(a) + len(b) - m) >= 0.8)


def test_sketches_see_order():
    one, two = "a b c d e f g h i j", "f g h i j a b c d e"
    shingles_, of, sizes = near_dedup.shingles_of([one, two, one, ""])
    found = near_dedup.sketches(shingles_, of, sizes)
    assert (found[0] == found[2]).all() and (found[0] != found[1]).mean() > 0.5


def recurring():
    """Pairs of near copies in which a passage recurs and its first copy was dropped or edited."""
    rng = np.random.default_rng(11)
    word = lambda n: [f"r{x}" for x in rng.integers(0, 10**9, n)]
    chorus, header, sentence, line = word(30), word(20), word(12), word(30)
    verses, bodies = [word(60), word(70), word(80)], [word(40) for _ in range(6)]
    song, sheet = [w for v in verses for w in v + chorus], [w for x in bodies for w in header + x]
    return {
        "chorus": (song, song[:60] + song[90:]),
        "header": (sheet, sheet[20:]),
        "sentence": (sentence * 10, sentence[:5] + ["edited"] + sentence[6:] + sentence * 9),
        "line": (line * 8, line[:3] + ["edited"] + line[4:] + line * 7),
    }


@pytest.mark.parametrize("name", ["chorus", "header", "sentence", "line"])
def test_recurring_passages_stay_alike(name):
    one, two = (" ".join(x) for x in recurring()[name])
    a, b = shingles(one), shingles(two)
    m = common(a, b)
    assert m / (len(a) + len(b) - m) >= 0.8
    found, _, sizes = near_dedup.shingles_of([one, two])
    assert near_dedup.alike(found[: sizes[0]], found[sizes[0] :])
    key = ["bucket", 1, 1, 0, 0]
    assert near_dedup.links_in([(0, "a", "a", one), (0, "b", "b", two)], key) == [("a", "b")]


def test_recurring_passages_are_one_class(spark):
    rows = [(2 * i + at, " ".join(x)) for i, pair in enumerate(recurring().values()) for at, x in enumerate(pair)]
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 for i in range(8)}


def test_sketches_from_the_end_survive_a_dropped_first_copy():
    one, two = (" ".join(x) for x in recurring()["chorus"])
    front, back = (
        np.mean(x[0] == x[1]) for x in (near_dedup.sketches(*near_dedup.shingles_of([one, two]), count=400, back=b) for b in (False, True))
    )
    assert back > front + 0.1
    found = near_dedup.all_sketches(*near_dedup.shingles_of([one, "a text of its own without any repeat"]))
    assert [len(x) for x in found] == [2 * near_dedup.SKETCHES, near_dedup.SKETCHES]


def removed(rows, n=13):
    first = {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        w = (text or "").encode().split()
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), doc_id)
    out = {}
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < doc_id:
                gone.update(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id] = (len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def test_substrings(rows, wide):
    got = substring_dedup.cleaned(wide).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got} == removed(rows)
    assert sum(r.n_removed for r in got) > 1000
    assert all(sum(r.spans[1::2]) == r.n_removed and min(r.spans[1::2], default=13) >= 13 for r in got)


def test_substrings_across_parts(rows, docs, monkeypatch):
    """The same result where every document is a part of its own."""
    one = lambda batches, most=0, column="text": (b.slice(i, 1) for b in batches for i in range(b.num_rows))
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    want = {k: v[:3] for k, v in removed(rows).items()}
    monkeypatch.setattr(substring_dedup, "parts", one)
    runs = [substring_dedup.runs_in(np.array([r[0]]), [r[1] or ""]) for r in rows]
    assert all(not x[5].any() for x in runs)
    got = substring_dedup.cleaned(docs.filter("length(coalesce(text, '')) < 20000").repartition(40)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_substrings_empty_and_repeated(empty, repeated):
    assert substring_dedup.cleaned(empty).count() == 0
    got = substring_dedup.cleaned(repeated).collect()
    assert len(got) == repeated.count() and all(r.n_removed == 0 for r in got)


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, near_dedup.drop_near_copies])
def test_columns_of_the_user_come_back_as_they_are(docs, drop):
    names = ["__row", "__repeat", "row", "key", "repeat", "run", "begins", "cell", "beginning", "mix", "members", "a.b", "text_md5"]
    plain = {(r.doc_id, r.text) for r in drop(docs).collect()}
    got = drop(docs.selectExpr("*", *[f"concat('{i}/', doc_id) AS `{name}`" for i, name in enumerate(names)]))
    assert got.columns == [*docs.columns, *names]
    rows = got.collect()
    assert {(r["doc_id"], r["text"]) for r in rows} == plain and len(rows) == len(plain)
    assert all(r[name] == f"{i}/{r['doc_id']}" for r in rows for i, name in enumerate(names))


def test_runs_are_found_by_sorting_one_exchange(repeated):
    """Ranges are sorted and neighbours compared without a second shuffle of texts."""
    plan = exact_dedup.cells(repeated)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan
    assert "lag(text" in plan and "Sort [beginning" in plan


def test_texts_of_one_beginning_and_many_copies(spark):
    """Texts that differ after the sampled beginning, with copies in every cell and null ids among them."""
    same = "x" * 200
    rows = [(i if i % 7 else None, same + str(i % 5)) for i in range(400)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = Counter()
    groups = {}
    for i, text in rows:
        groups.setdefault(text, []).append(i)
    for text, ids in groups.items():
        keep = max(i for i in ids if i is not None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, keep, len(ids), i == keep, digest) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == expected


def short_pairs(rng, n, size, drop):
    """Pairs of a text of so many words and the same without its last ones, each at 0.8 or more."""
    for at in range(n):
        text = [f"p{at}x{x}" for x in rng.integers(0, 10**6, size)]
        yield " ".join(text), " ".join(text[:-drop])


def test_short_texts_are_compared_exactly(spark):
    """Of 4 against 5 shingles some pairs in a hundred share no sketch; their rarest shingles find all of them."""
    rng = np.random.default_rng(3)
    pairs = [*short_pairs(rng, 300, 9, 1), *short_pairs(rng, 100, 14, 2), *short_pairs(rng, 100, 29, 5)]
    rows = [(2 * i + at, text) for i, pair in enumerate(pairs) for at, text in enumerate(pair)]
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 for i in range(len(rows))}


def test_short_texts_of_few_words_and_a_frequent_passage(spark):
    """Edited texts around one passage, with words that recur, against all pairs."""
    rng = np.random.default_rng(8)
    rows = []
    for at in range(400):
        if at % 4 and rows:
            words = rows[-1][1].split()
            words[int(rng.integers(0, len(words)))] = f"e{rng.integers(0, 3)}"
            words = words[: len(words) - int(rng.integers(0, 2))] or words
        else:
            words = [f"w{x}" for x in rng.integers(0, 6, int(rng.integers(1, 26)))]
            if at % 8:
                words[len(words) // 2 : len(words) // 2] = "read on about this in our".split()
        rows.append((at, " ".join(words)))
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.class_size, r.kept) for r in got} == near_classes(rows)


def test_a_frequent_passage_makes_no_bucket(spark):
    texts = [" ".join([f"a{i}", f"b{i}", *"read on about this in our shop".split(), f"c{i}", f"d{i}"]) for i in range(200)]
    found = near_dedup.sketched(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert near_dedup.rarest(found.select("digest", "doc_id", "size", "few")).count() == 0
