"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.operators import demand as dm
from cabgrid.operators import recommend, serving, stations, zonefill
from cabgrid.operators import series as sr
from cabgrid.sinks import writers
from checks import fixtures as fx
from checks import registry as reg
from tests.conftest import SF_SMALL

S = fx.SETTINGS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan after adaptive execution has changed it."""
    df._jdf.collectToPython()
    return plan(df)


def shuffles(text):
    """Distinct shuffles of a plan; reused ones count once."""
    return len(re.findall(r"(?<!Reused)Exchange (?:hash|range|round|single|Single)", text))


@pytest.fixture(scope="module")
def steps(spark):
    """Every operator's DataFrame, over stored inputs."""
    session.prepare(spark)
    trips = dm.known_zone_trips(fx.trips(spark, SF_SMALL), S.unknown_zones)
    cells, demand = reg.zone_cells(spark, SF_SMALL), reg.demand(spark, SF_SMALL)
    typical, nearest = reg.typical(spark, SF_SMALL), reg.nearest(spark, SF_SMALL)
    return {
        "fill": lambda: zonefill.zone_cells(fx.zone_rings(spark, SF_SMALL), S.grid),
        "demand": lambda: dm.demand_windows(dm.assign_cells(trips, cells, fx.trip_key()), S),
        "lags": lambda: sr.row_lags(demand, S.row_lags),
        "calendar": lambda: sr.calendar_lags(demand),
        "dense": lambda: sr.densify(demand),
        "features": lambda: reg.features.live(spark, SF_SMALL),
        "nearest": lambda: stations.nearest_table(reg.cell_rows(spark, SF_SMALL), reg.clean(spark, SF_SMALL)),
        "recommendations": lambda: recommend.recommendations(typical, stations.cell_scores(nearest, S), S),
        "answers": lambda: serving.recommend(fx.driver_points(spark, SF_SMALL), reg.recs(spark, SF_SMALL), S),
        "chargers": lambda: serving.charger_rows(fx.driver_points(spark, SF_SMALL), nearest, S),
        "intensity": lambda: serving.intensity(typical),
    }


NAMES = (
    "fill demand lags calendar dense features nearest recommendations answers chargers intensity".split()
)


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_python_and_no_cross_product(steps, conf, name, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    text = plan(steps[name]())
    for banned in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert banned not in text


@pytest.mark.parametrize("name", ["demand", "features", "nearest", "recommendations", "answers"])
def test_joins_shuffle_beyond_the_broadcast_threshold(steps, conf, name):
    """No hint forces a broadcast, so a table that outgrows the threshold is shuffled, with the same result."""
    small = sorted(map(str, steps[name]().collect()))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df = steps[name]()
    text = plan(df)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert sorted(map(str, df.collect())) == small


def test_demand_prunes_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "trips")
    fx.trips(spark, SF_SMALL).withColumn("unused", F.lit("x")).write.parquet(path)
    cells = reg.zone_cells(spark, SF_SMALL)
    text = plan(dm.demand_from_trips(spark.read.parquet(path), cells, S, F.col("trip_id")))
    assert re.search(r"PushedFilters: \[[^]]*Not\(In\(PULocationID", text)
    assert "unused" not in text
    # summed up before the one shuffle
    assert "partial_count" in text and shuffles(text) == 1


def test_recommendations_shuffle_their_pairs_once(steps):
    text = plan(steps["recommendations"]())
    assert text.count("WindowGroupLimit") >= 1
    pairs = re.findall(r"Exchange hashpartitioning\(origin_h3", text)
    assert len(pairs) == 1


def test_answers_do_not_shuffle_drivers_when_lists_are_small(steps):
    text = plan(steps["answers"]())
    assert "BroadcastHashJoin" in text and "hashpartitioning(driver_h3" not in text


def test_nearest_rank_is_limited_before_the_shuffle(steps):
    assert plan(steps["nearest"]()).count("WindowGroupLimit") >= 2


def test_slot_filter_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "typical")
    writers.write_slots(reg.typical(spark, SF_SMALL), path)
    text = plan(serving.slot(spark.read.parquet(path), hour=8, day=2))
    found = re.search(r"PartitionFilters: \[(.*?), PushedFilters", text)
    assert "hour_of_day" in found.group(1) and "day_of_week" in found.group(1)


def test_slot_writes_make_one_file_per_folder(spark, tmp_path):
    path = tmp_path / "typical"
    writers.write_slots(reg.typical(spark, SF_SMALL).repartition(7), str(path))
    folders = list(path.glob("hour_of_day=*/day_of_week=*"))
    assert folders and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_busy_zone_is_split_when_the_map_is_too_large_to_broadcast(spark, conf, tmp_path):
    """One zone holds nearly all trips; adaptive execution splits it although the aggregate wants its key."""
    rows = spark.range(400_000).selectExpr(
        "id AS trip_id",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 86400) AS tpep_pickup_datetime",
        "IF(id % 10 = 0, 2 + id % 23, 1L) AS PULocationID",
        "CAST(id AS DOUBLE) AS trip_distance",
        "1D AS fare_amount",
        "1D AS average_speed_mph",
        "1D AS tip_percentage",
        "1L AS passenger_count",
    )
    path = str(tmp_path / "trips")
    rows.repartition(16).write.parquet(path)
    trips, cells = spark.read.parquet(path), reg.zone_cells(spark, SF_SMALL)
    small = dm.demand_from_trips(trips, cells, S, F.col("trip_id"))
    expected = small.agg(F.count("*"), F.sum("pickup_count"), F.bit_xor(F.xxhash64("window_start", "pickup_h3", "pickup_count"))).first()
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200k",
    )
    large = dm.demand_from_trips(trips, cells, S, F.col("trip_id"))
    split = large.agg(F.count("*"), F.sum("pickup_count"), F.bit_xor(F.xxhash64("window_start", "pickup_h3", "pickup_count")))
    assert split.first() == expected
    assert "SortMergeJoin(skew=true)" in executed(large)


@pytest.mark.parametrize("threshold, shuffled", [("10485760", 7), ("-1", 16)])
def test_nearest_walks_by_tiles(spark, conf, threshold, shuffled):
    """Eight windows; the districts of stations are summed once and read twice."""
    conf(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__adaptive__autoBroadcastJoinThreshold=threshold)
    near = stations.nearest_stations(reg.cell_rows(spark, SF_SMALL), reg.clean(spark, SF_SMALL))
    text = executed(near).split("Initial Plan")[0]
    assert len(re.findall(r" Window \[", text)) <= 8
    assert shuffles(text) - text.count("ReusedExchange") <= shuffled
