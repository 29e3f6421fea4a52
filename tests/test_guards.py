"""Nothing is cut or multiplied in silence, and growth is spread over tasks."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cabgrid.config import Settings, Weights
from cabgrid.functions import scalars
from cabgrid.operators import features, recommend, series, weather
from cabgrid.operators.series import lag_name
from checks import fixtures as fx
from checks.registry import QUERIES
from tests.test_operators import pack

S = Settings()
T0 = datetime(2024, 1, 1)


def counts_of(n):
    return [(f"fast_{i}", f"slow_{i}") for i in range(n)]


def test_every_station_counts(spark):
    row = spark.createDataFrame([(1, 1, 1, 1, 1, 10, 10, 10, 10, 10)], [f"fast_{i}" for i in range(5)] + [f"slow_{i}" for i in range(5)])
    weights = Weights(by_priority=(1.0, 0.5, 0.25, 0.125, 0.0625))
    got = row.select(scalars.charger_score(counts_of(5), weights).alias("s")).first().s
    assert got == pytest.approx((2.5 + 10) * sum(weights.by_priority))


@pytest.mark.parametrize("n", [2, 5])
def test_stations_without_a_discount_are_an_error(n):
    with pytest.raises(ValueError):
        scalars.charger_score(counts_of(n), Weights())


def test_counts_in_text(spark):
    rows = spark.createDataFrame([(x,) for x in ("3", "2.0", "3.7", " 4 ", "nan", "x", None, "1e400", "-1.5")], "x string")
    got = rows.select(scalars.whole_number("x").alias("n"), scalars.zero_if_none("x").alias("z")).collect()
    assert [r.n for r in got] == [3, 2, 3, 4, None, None, None, None, -1]
    assert [r.z for r in got] == [3, 2, 3, 4, 0, 0, 0, 0, -1]


def test_lookups_never_multiply(spark):
    demand = spark.createDataFrame([(T0, 1, pack(0, 0), 3)], "window_start timestamp, pickup_zone_id bigint, pickup_h3 bigint, pickup_count bigint")
    zones = spark.createDataFrame([("1", "B"), ("1", "A"), ("x", "C")], "LocationID string, Borough string")
    assert [r.borough for r in features.add_borough(demand, zones).collect()] == ["A"]
    hours = ["A", 0.0, 0.0, [T0, T0 + timedelta(hours=1)]]
    landed = spark.createDataFrame(
        [(*hours, [None, 5.0], *[[1.0, 1.0]] * 4), (*hours, [7.0, None], *[[1.0, 1.0]] * 4)],
        "borough string, lat double, lon double, time array<timestamp>, temp_2m array<double>, precip array<double>,"
        " rain array<double>, snow array<double>, wind array<double>",
    )
    got = weather.hourly_weather(landed)
    assert sorted(r.temp_2m for r in got.collect()) == [5.0, 7.0]
    assert weather.repeated_hours(landed).count() == 2
    assert features.add_weather(features.add_borough(demand, zones), got).count() == 1


def tasks_with_rows(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def test_pairs_are_made_by_several_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="true", spark__sql__adaptive__coalescePartitions__enabled="true", spark__sql__shuffle__partitions="4")
    cells = [pack(q, r) for q in range(5) for r in range(5)]
    rows = [(c, h, 1, 1.0 * h, h) for c in cells for h in range(3)]
    typical = spark.createDataFrame(rows, "pickup_h3 bigint, hour_of_day int, day_of_week int, typical_demand double, demand_p75 bigint").coalesce(1)
    made = []
    for tasks in (4, 9):
        pairs = recommend.candidates(typical, 2, tasks)
        text = pairs._jdf.queryExecution().toString()
        assert f"hashpartitioning(pickup_h3" in text and f", {tasks}), REPARTITION_BY_NUM" in text
        made.append(sorted(map(str, pairs.collect())))
    assert made[0] == made[1] and len(made[0]) > len(rows)


def test_windows_are_made_by_several_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="true", spark__sql__adaptive__coalescePartitions__enabled="true", spark__sql__autoBroadcastJoinThreshold="10m")
    rows = [(T0 + timedelta(days=d), 1, pack(c, 0), 1) for c in range(3) for d in range(9)]
    demand = spark.createDataFrame(rows, "window_start timestamp, pickup_zone_id bigint, pickup_h3 bigint, pickup_count bigint")
    dense = series.densify(demand, tasks=6)
    assert ", 6), REPARTITION_BY_NUM" in dense._jdf.queryExecution().toString()
    assert tasks_with_rows(dense) > 1
    assert dense.count() == 3 * (8 * 288 + 1)


@pytest.fixture
def suppliers(spark, tmp_path):
    """Tables with one small file of suppliers; some names repeat, some are NULL."""
    rows = [(k, None if k % 7 == 0 else f"s{k % 30}") for k in range(60)]
    spark.createDataFrame(rows, "s_suppkey bigint, s_name string").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_weather_hours_are_made_by_several_tasks(spark, conf, suppliers, monkeypatch):
    conf(spark__sql__adaptive__enabled="true", spark__sql__adaptive__coalescePartitions__enabled="true")
    assert fx.table(spark, suppliers, "supplier").rdd.getNumPartitions() == 1
    made = []
    for places, tasks in ((16, 4), (7, 9)):
        monkeypatch.setattr(fx, "PLACES_A_TASK", places)
        landed = fx.supplier_weather(spark, suppliers)
        hours = weather.explode_hours(landed)
        by_task = [r["count"] for r in hours.groupBy(F.spark_partition_id()).count().collect()]
        # Rows with repeated or missing names are dealt out like any other.
        assert len(by_task) == tasks and max(by_task) <= places * 712
        assert sum(by_task) == 60 * 712
        made.append(sorted(map(str, weather.hourly_weather(landed).collect())))
    assert made[0] == made[1]
    # The NULLs are one place.
    assert len(made[0]) == len({None if k % 7 == 0 else k % 30 for k in range(60)}) * 712
    for name in ("f1_weather_flags", "f2_weather_classes", "f3_exploded_hours"):
        assert "RoundRobinPartitioning(9), REPARTITION_BY_NUM" in QUERIES[name](spark, suppliers)._jdf.queryExecution().toString()


def test_weather_lands_in_several_files(spark, suppliers, monkeypatch):
    monkeypatch.setattr(fx, "PLACES_A_TASK", 16)
    hours = QUERIES["s2_landed_weather"](spark, suppliers)
    assert len(hours.inputFiles()) == 4
    assert hours.count() == 60 * 712
    assert hours.filter("borough IS NULL").count() == 9 * 712


@pytest.mark.parametrize("kind", ["rows", "calendar", "dense"])
def test_every_kind_of_lags(spark, kind):
    rows = [(T0 + timedelta(minutes=5 * i), 1, pack(0, 0), i) for i in (0, 1, 2, 4, 5, 9)]
    demand = spark.createDataFrame(rows, "window_start timestamp, pickup_zone_id bigint, pickup_h3 bigint, pickup_count bigint")
    settings = replace(S, row_lags=(1, 2), lag_kind=kind)
    got = {r.pickup_count: r for r in features.lagged(demand, settings).collect()}
    assert len(got) == 6
    last = {"rows": (4, 2), "calendar": (4, None), "dense": (4, 0)}[kind]
    assert (got[5][lag_name(1)], got[5][lag_name(2)]) == last
    assert got[2].target_pickup_count == (0 if kind == "dense" else 4)


def test_an_unknown_kind_of_lags_is_refused(spark):
    with pytest.raises(ValueError):
        features.lagged(spark.range(1), replace(S, lag_kind="moon"))
