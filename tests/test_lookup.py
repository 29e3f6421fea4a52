"""Recommendations bucketed by origin cell in slot folders."""

import re

import pytest
from pyspark.sql import functions as F

from cabgrid.operators import serving
from cabgrid.sinks import lookup
from checks import fixtures as fx
from checks import registry as reg
from tests.conftest import SF_SMALL
from tests.test_plans import executed, plan

S = fx.SETTINGS
BUCKETS = 8


@pytest.fixture(scope="module")
def recs(spark):
    return reg.recs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def table(spark, recs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "v-1")
    lookup.write(recs, path, BUCKETS)
    yield lookup.publish(spark, "looked_up", path, BUCKETS)
    spark.sql("DROP TABLE looked_up")


@pytest.fixture(scope="module")
def points(spark):
    odd = spark.sql("SELECT -1L AS driver_id, 40.7D AS lat, NULL AS lon, TIMESTAMP'2024-01-01' AS ts UNION ALL SELECT -2L, 1D, 1D, NULL")
    given = fx.driver_points(spark, SF_SMALL)
    return given.unionByName(given.limit(3)).unionByName(odd)


def no_broadcast(conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


@pytest.mark.parametrize("broadcast", [True, False])
def test_same_answers(points, recs, table, conf, broadcast):
    want = sorted(map(str, serving.recommend(points, recs, S).collect()))
    if not broadcast:
        no_broadcast(conf)
    got = serving.look_up(points, table, S, BUCKETS).collect()
    assert sorted(map(str, got)) == want and any(r.status == "ok" for r in got)


def moved(text):
    """Why rows are dealt by cell; the points asked for are, the table is not."""
    return set(re.findall(r"Exchange hashpartitioning\(origin_h3#\d+L?, \d+\), (\w+)", text))


def test_slots_prune_folders_and_the_table_stays(spark, points, table, conf):
    conf(spark__sql__maxMetadataStringLength="1000")
    some = serving.recommend(points, table, S).filter("status = 'ok'").first()
    one = points.join(spark.createDataFrame([(some.driver_id,)], "driver_id long"), "driver_id", "left_semi")
    text = executed(serving.look_up(one, table, S, BUCKETS)).split("Initial Plan")[0]
    assert "Bucketed: true" in text and moved(text) <= {"REPARTITION_BY_NUM"}
    found = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    pruned = " ".join(f for f in found if "dynamicpruning" in f)
    assert "hour_of_day" in pruned and "day_of_week" in pruned


def test_many_points_meet_buckets_where_they_lie(points, table, conf):
    no_broadcast(conf)
    text = plan(serving.look_up(points, table, S, BUCKETS))
    assert "Bucketed: true" in text and moved(text) == {"REPARTITION_BY_NUM"}
    assert "SortMergeJoin [origin_h3" in text and "dynamicpruning" in text


def test_files_are_buckets_in_slots(recs, table):
    files = table.select(F.input_file_name().alias("f"), "origin_h3").distinct().collect()
    by_cell = {}
    for r in files:
        by_cell.setdefault(r.origin_h3, set()).add(re.search(r"_(\d{5})\.c\d+", r.f).group(1))
    assert all(len(b) == 1 for b in by_cell.values()) and len(by_cell) > BUCKETS
    assert all("/hour_of_day=" in r.f and "/day_of_week=" in r.f for r in files)
    assert sorted(map(str, table.select(recs.columns).collect())) == sorted(map(str, recs.collect()))


def test_a_name_moves_and_readers_keep_their_files(spark, recs, tmp_path):
    for at, rows in (("v-1", recs), ("v-2", recs.filter("rank = 1"))):
        lookup.write(rows, str(tmp_path / at), BUCKETS)
    before = lookup.publish(spark, "moved", str(tmp_path / "v-1"), BUCKETS)
    before.count()
    after = lookup.publish(spark, "moved", str(tmp_path / "v-2"), BUCKETS)
    assert before.count() == recs.count() and after.count() == recs.filter("rank = 1").count()
    # Another number of buckets is another table.
    lookup.write(recs, str(tmp_path / "v-3"), 3)
    assert lookup.publish(spark, "moved", str(tmp_path / "v-3"), 3).count() == recs.count()
    assert (tmp_path / "v-1" / "_SUCCESS").exists()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lookup_") and t.name != "looked_up"]
    spark.sql("DROP TABLE moved")


def test_empty_table_and_foreign_names(spark, recs, points, tmp_path):
    lookup.write(recs.limit(0), str(tmp_path / "none"), BUCKETS)
    with pytest.raises(ValueError, match="not an external table"):
        recs.limit(1).createOrReplaceTempView("a_view")
        lookup.publish(spark, "a_view", str(tmp_path / "none"), BUCKETS)
    spark.catalog.dropTempView("a_view")
