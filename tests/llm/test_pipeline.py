from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cabgrid.llm import mixing
from checks.compare import difference, duck
from tests.conftest import SF_SMALL
from tests.llm.conftest import SCHEMA
from tests.llm.test_dedup import near_classes


@pytest.fixture(scope="module")
def small():
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF_SMALL}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline"))
def test_registered_queries(spark, name):
    made = entry.queries()[name](spark, SF_SMALL)
    if name in entry.oracle_sql():
        assert difference(made, duck(SF_SMALL), entry.oracle_sql()[name]) is None
    else:
        assert made.count() > 0


def test_all_operators_are_registered():
    numbers = Counter(n.split("_")[0] for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == Counter(f"op{n}" for n in range(1, 14))


def test_mixing_meets_its_targets(spark, wide):
    rows = mixing.measured(wide, None, "doc_id")
    targets = mixing.Targets(rounds=200, cut_every=20)
    cells = mixing.fitted_cells(rows, targets)
    fitted = rows.groupBy("__source", "__lang", "__topic").sum("__tokens").join(cells, ["__source", "__lang", "__topic"]).collect()
    for margin, power in (("__source", targets.source), ("__lang", targets.lang), ("__topic", targets.topic)):
        seen, made = Counter(), Counter()
        for r in fitted:
            seen[r[margin]] += r["sum(__tokens)"]
            made[r[margin]] += r["sum(__tokens)"] * r["__probability"]
        total = sum(seen.values())
        aim = {k: (v / total) ** power for k, v in seen.items()}
        for k in seen:
            assert made[k] / sum(made.values()) == pytest.approx(aim[k] / sum(aim.values()), rel=1e-3, abs=1e-6)
    assert max(r["__probability"] for r in fitted) == pytest.approx(1)


def test_mixing_rows_equal_sql(wide, empty, repeated):
    for docs in (wide, repeated):
        con = duckdb.connect()
        con.register("documents", pa.Table.from_pandas(docs.toPandas().astype({"doc_id": "Int64"})))
        assert difference(mixing.mixing_rows(docs), con, mixing.mixing_sql()) is None
        kept = mixing.mix(docs)
        assert kept.columns == docs.columns
        want = Counter(r.doc_id for r in mixing.mixing_rows(docs).filter("kept").collect())
        assert Counter(r.doc_id for r in kept.collect()) == want
    assert mixing.mixing_rows(empty).count() == 0 and mixing.mix(empty).count() == 0


def scaled(cells, least):
    """The smallest scale that keeps ``least`` of the tokens, by halving, and never one below that of the largest factor."""
    low, high = 1 / max(f for _, f in cells), 1e9
    need = least * sum(n for n, _ in cells)
    for _ in range(200):
        middle = (low + high) / 2
        if sum(n * min(1, middle * f) for n, f in cells) < need:
            low = middle
        else:
            high = middle
    return low


@pytest.mark.parametrize("least", [0.05, 0.5, 0.9, 1.0])
def test_scale_keeps_the_budget(spark, least):
    cells = [(100.0, 0.4), (1.0, 90.0), (50.0, 1.0), (3.0, 20.0), (700.0, 0.01), (20.0, 5.0)]
    frame = spark.createDataFrame([(n, f, n * f) for n, f in cells], "seen double, factor double, fit double")
    got, want = mixing.scale_of(frame, least), scaled(cells, least)
    for n, f in cells:
        assert min(1, got * f) == pytest.approx(min(1, want * f), rel=1e-6)


def test_one_rare_source_costs_nothing(spark):
    """Equal documents keep their number, and the rest of the margins their targets, whatever one document is called."""
    same = [(i, "one two three four", "en", "s", 18) for i in range(20_000)]
    plain = mixing.mix(spark.createDataFrame(same, SCHEMA)).count()
    rare = spark.createDataFrame([*same[1:], (0, "one two three four", "en", "rare", 18)], SCHEMA)
    kept = mixing.mix(rare)
    assert kept.count() > 0.45 * 20_000 and plain == 20_000
    assert kept.filter("source = 'rare'").count() == 1
    told = {(r["margin"], r["value"]): r for r in mixing.reached(rare).collect()}
    assert told["source", "rare"]["target"] > told["source", "rare"]["kept"] > told["source", "rare"]["seen"]
    assert told["lang", "en"]["kept"] == pytest.approx(told["lang", "en"]["target"])


def test_no_column_is_lost(spark):
    names = ["own", "__source", "__lang", "__topic", "__tokens", "__probability", "seen", "topic", "value.with dot"]
    docs = spark.createDataFrame([(i, f"w{i} x y", "en", f"s{i % 2}", 5, *[f"{n}{i}" for n in names]) for i in range(40)], SCHEMA + "".join(f", `{n}` string" for n in names))
    kept = mixing.mix(docs)
    assert kept.columns == docs.columns
    whole = {tuple(r) for r in docs.collect()}
    rows = [tuple(r) for r in kept.collect()]
    assert rows and set(rows) <= whole


def test_pipeline_equals_brute_force(spark, small):
    """Letters, exact and near copies by comparison of all pairs; the draw by SQL; then every piece is packed once."""
    rows = [r for r in small if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for r in rows:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    rows = [r for r in rows if r[0] == last[r[1]]]
    stays = near_classes(rows)
    rows = [r for r in rows if stays[r[0]][2]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    want = {x for x, in con.sql(f"SELECT doc_id FROM ({mixing.mixing_sql()}) WHERE kept").fetchall()}
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == want
    assert len({(r.doc_id, r.piece) for r in got}) == len(got)
    assert max(r.offset + r.length for r in got) <= 2048


def test_stages_keep_columns(spark, wide, empty, repeated):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near dedup", "mixing", "packing"]
    for docs in (wide.limit(30), empty, repeated):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF_SMALL)
            assert after.columns == docs.columns and after.count() <= docs.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()
