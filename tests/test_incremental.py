"""Versions of tables, and demand kept up to date by date, against full runs."""

import datetime
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.operators import series as sr
from cabgrid.operators import typical as ty
from cabgrid.plans import incremental as inc
from cabgrid.sinks import versions, writers
from checks import fixtures as fx

S = fx.SETTINGS
DAY = datetime.date(2024, 3, 1)
TRIP = "trip_id long, tpep_pickup_datetime timestamp, PULocationID long, trip_distance double, fare_amount double, average_speed_mph double, tip_percentage double, passenger_count long"


def positions(spark):
    return spark.createDataFrame([(z, p, 10 * z + p, 3) for z in (1, 2, 3) for p in range(3)], "LocationID int, position int, h3_cell long, n_cells int")


def trips(seed=1, days=12, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = min(int(rng.expovariate(0.25)), days - 1) if i % 3 else rng.randrange(days)
        at = datetime.datetime.combine(DAY + datetime.timedelta(days=day), datetime.time()) + datetime.timedelta(minutes=5 * rng.randrange(288))
        zone = rng.choice([1, 1, 1, 2, 2, 3, 9, 264, None])
        rows.append((i, at, zone, float(i % 7), float(i % 11), 1.0, 2.0, 1))
    return rows


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_ino
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def content(df, drop=()):
    names = sorted(set(df.columns) - set(drop))
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.fixture(scope="module")
def setup(spark):
    session.prepare(spark)
    from dataclasses import replace

    return replace(S, row_lags=(1, 4, 30))


def updated(spark, tmp_path, setup, *states):
    tables = inc.DemandTables(spark, inc.Layout(str(tmp_path)), setup)
    told = []
    for rows in states:
        told.append(tables.update(spark.createDataFrame(rows, TRIP).repartition(3), positions(spark), F.col("trip_id")))
    return tables, told


def same_tables(tables, whole):
    for path, drop in (("demand", ()), ("lags", ()), ("cell_days", ()), ("typical", ("sketch",))):
        one, two = (t.read(getattr(t.layout, path)) for t in (tables, whole))
        assert content(one, drop) == content(two, drop), path
    assert content(tables.typical_demand()) == content(whole.typical_demand())


def test_late_trips_of_two_dates(spark, tmp_path, setup):
    """The tables of a full run, and untouched dates keep their files."""
    rows = trips()
    late = [r for r in rows if r[1].date() in (DAY + datetime.timedelta(days=3), DAY + datetime.timedelta(days=8)) and r[0] % 2]
    early = [r for r in rows if r not in late]
    tables, _ = updated(spark, tmp_path / "a", setup, early)
    before = {p: files(getattr(tables.layout, p)) for p in ("demand", "lags", "typical")}
    told = tables.update(spark.createDataFrame(rows, TRIP), positions(spark), F.col("trip_id"))
    whole, _ = updated(spark, tmp_path / "b", setup, rows)
    same_tables(tables, whole)
    changed = {d for d in told.changed}
    assert changed == {r[1].date() for r in late}
    for name, dates in (("demand", told.changed), ("typical", told.changed), ("lags", told.lagged)):
        after = files(getattr(tables.layout, name))
        folders = tuple(f"window_start_date={d}/" for d in dates)
        assert {k: v for k, v in before[name].items() if not k.startswith(folders)} == {
            k: v for k, v in after.items() if not k.startswith(folders)
        }
        assert not set(before[name]) & {k for k in after if k.startswith(folders)}
    assert len(told.lagged) < 12
    assert tables.update(spark.createDataFrame(rows, TRIP).repartition(5), positions(spark), F.col("trip_id")) == inc.Updated((), ())


def test_withdrawn_dates_new_dates_and_other_cells(spark, tmp_path, setup):
    rows = trips(2, 9, 500)
    gone = [r for r in rows if r[1].date() != DAY + datetime.timedelta(days=2) and r[2] != 3]
    more = gone + trips(5, 3, 60)[:40]
    tables, told = updated(spark, tmp_path / "a", setup, rows, gone, more)
    assert DAY + datetime.timedelta(days=2) in told[1].changed
    whole, _ = updated(spark, tmp_path / "b", setup, more)
    same_tables(tables, whole)
    other = positions(spark).withColumn("h3_cell", F.col("h3_cell") + 100)
    all_dates = tables.update(spark.createDataFrame(more, TRIP), other, F.col("trip_id")).changed
    assert set(all_dates) == {r[1].date() for r in more if r[2] not in (None, 264)}
    assert tables.read(tables.layout.demand).filter("pickup_h3 < 100").count() == 0


def test_a_run_that_dies_is_made_good(spark, tmp_path, setup, monkeypatch):
    """Whatever was written before it died, the next run finds the same dates changed."""
    rows = trips(3, 8, 400)
    late = rows + [(5000 + i, *r[1:]) for i, r in enumerate(trips(4, 2, 30))]
    tables, _ = updated(spark, tmp_path / "a", setup, rows)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_update_lags", dies)
        with pytest.raises(RuntimeError):
            tables.update(spark.createDataFrame(late, TRIP), positions(spark), F.col("trip_id"))
    assert tables.update(spark.createDataFrame(late, TRIP), positions(spark), F.col("trip_id")).changed
    whole, _ = updated(spark, tmp_path / "b", setup, late)
    same_tables(tables, whole)


def test_ledger_hash_sees_order_free_changes(spark, setup):
    rows = [r for r in trips(6, 3, 60) if r[2] in (1, 2)]
    cells = positions(spark)

    def entries(some):
        return content(inc.ledger(spark.createDataFrame(some, TRIP), cells, setup))

    assert entries(rows) == entries(rows[::-1])
    twice = rows + rows[:1] * 2  # an even number of repeats is a change as well
    assert entries(twice) != entries(rows)
    swapped = [(*r[:3], None, r[3], *r[5:]) if i == 0 else r for i, r in enumerate(rows)]
    moved = [(*r[:3], r[3], None, *r[5:]) if i == 0 else r for i, r in enumerate(rows)]
    assert entries(swapped) != entries(moved)


@given(st.data())
@settings(max_examples=12, deadline=None)
def test_lag_plan_covers_what_changes(spark, data):
    """Rows outside the plan keep their lags, and the needed rows give the affected ones theirs."""
    before = data.draw(st.lists(st.integers(0, 4), min_size=7, max_size=7))
    after = [data.draw(st.integers(0, 4)) if data.draw(st.booleans()) and data.draw(st.booleans()) else n for n in before]
    lags = (1, 3)

    def lagged(counts, value):
        rows = [(d, i, value(d, i)) for d, n in enumerate(counts) for i in range(n)]
        found = {}
        for at, (d, i, _) in enumerate(rows):
            found[d, i] = [rows[at + s][2] if 0 <= at + s < len(rows) else None for s in (1, *(-n for n in lags))]
        return found

    changed = [d for d in range(7) if before[d] != after[d]]
    old = lagged(before, lambda d, i: (d, i))
    new = lagged(after, lambda d, i: (d, i, "new") if d in changed else (d, i))
    days = [DAY + datetime.timedelta(days=d) for d in range(7)]
    cell_days = spark.createDataFrame([(7, days[d], n) for d, n in enumerate(after) if n], "pickup_h3 long, window_start_date date, n long")
    pairs = spark.createDataFrame([(7, days[d]) for d in changed], "pickup_h3 long, window_start_date date")
    plan = {r["window_start_date"]: r for r in inc.lag_plan(cell_days, pairs, max(lags)).collect()}
    affected = {d for d in range(7) if days[d] in plan and plan[days[d]]["affected"]}
    needed = [after[d] if days[d] in plan and plan[days[d]]["needed"] else 0 for d in range(7)]
    for (d, i), values in new.items():
        if d not in affected:
            assert old[d, i] == values
    again = lagged(needed, lambda d, i: (d, i, "new") if d in changed else (d, i))
    for (d, i), values in new.items():
        if d in affected:
            assert again[d, i] == values


def test_readers_and_dead_jobs_see_whole_versions(spark, tmp_path):
    """A reader from before keeps its version, and a job that dies mid-write changes nothing."""
    session.prepare(spark)
    path = str(tmp_path / "it's versioned")
    spark.sql("DROP TABLE IF EXISTS versioned_numbers")
    rows = spark.range(1000).selectExpr("id", "id % 4 AS hour_of_day", "id % 2 AS day_of_week")
    first = versions.publish(spark, "versioned_numbers", versions.write(rows, path, writers.SLOT_COLUMNS))
    opened, by_path = spark.table("versioned_numbers"), versions.read(spark, path)
    dies = rows.withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("long")).otherwise(-F.col("id")))
    with pytest.raises(Exception, match="lost"):
        versions.publish(spark, "versioned_numbers", versions.write(dies, path, writers.SLOT_COLUMNS))
    # As a driver that is lost mid-write leaves it.
    rows.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(versions.new_version(path))
    assert len(versions.versions(spark, path)) == 1
    for table in (first, opened, by_path, spark.table("versioned_numbers"), versions.read(spark, path)):
        assert table.agg(F.sum("id"), F.count("*")).first() == (499_500, 1000)
    second = versions.write(rows.withColumn("id", F.col("id") + 1), path, writers.SLOT_COLUMNS)
    versions.publish(spark, "versioned_numbers", second)
    assert spark.table("versioned_numbers").agg(F.sum("id")).first()[0] == 500_500
    assert spark.table("versioned_numbers").filter("hour_of_day = 3").count() == 250
    assert opened.agg(F.sum("id")).first()[0] == by_path.agg(F.sum("id")).first()[0] == 499_500
    third = versions.write(rows, path, writers.SLOT_COLUMNS)
    gone = versions.drop_old(spark, path, keep=2)
    assert len(gone) == 2 and versions.versions(spark, path) == [second, third]
    with pytest.raises(ValueError):
        versions.publish(spark, "versioned_numbers", gone[0])
    with pytest.raises(ValueError):
        versions.drop_old(spark, path, keep=0)
    spark.sql("DROP TABLE versioned_numbers")


def test_moving_a_table_never_drops_it(spark, tmp_path, monkeypatch):
    session.prepare(spark)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.sql("DROP TABLE IF EXISTS moved_numbers")
    spark.range(3).write.parquet(one)
    spark.range(5).write.parquet(two)
    writers.register(spark, "moved_numbers", one)
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), sql(self, text, *a, **k))[1])
    assert writers.register(spark, "moved_numbers", two).count() == 5
    assert any(x.startswith("ALTER TABLE") for x in said) and not any(x.startswith(("DROP", "CREATE")) for x in said)
    sql(spark, "DROP TABLE moved_numbers")


def test_merged_states_equal_a_full_run(spark):
    """Mean exactly; the 75th percentile within the sketch's error of its group's ranks."""
    rng = random.Random(9)
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (start + datetime.timedelta(days=7 * rng.randrange(6), minutes=5 * rng.randrange(12)), rng.choice([1, 1, 1, 2, None]), rng.choice([rng.random() * 9, None, 1.0]))
        for _ in range(9000)
    ]
    frame = spark.createDataFrame(rows, "window_start timestamp, pickup_h3 long, predicted_demand double")
    whole = {tuple(r)[:3]: r for r in ty.typical_demand(frame).collect()}
    state = ty.typical_state(frame)
    assert state.select("window_start_date").distinct().count() == 6
    got = {tuple(r)[:3]: r for r in ty.merged_typical(state).collect()}
    assert set(got) == set(whole)
    for key, r in got.items():
        assert abs(r["typical_demand"] - whole[key]["typical_demand"]) < 1e-9
        values = sorted(v for _, c, v in rows if c == key[0] and v is not None)
        below, upto = sum(v < r["demand_p75"] for v in values), sum(v <= r["demand_p75"] for v in values)
        assert below - 0.01 * len(values) <= 0.75 * len(values) <= upto + 0.01 * len(values)
    late = [(start, 2, 4.0)] * 3
    fresh = ty.typical_state(spark.createDataFrame([r for r in rows if r[0].date() == start.date()] + late, frame.schema))
    kept = state.filter(F.col("window_start_date") != F.lit(start.date()))
    again = ty.merged_typical(kept.unionByName(fresh))
    full = ty.merged_typical(ty.typical_state(spark.createDataFrame(rows + late, frame.schema)))
    keys = ["pickup_h3", "hour_of_day", "day_of_week", "typical_demand"]
    assert content(again.select(*keys)) == content(full.select(*keys))


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_lags_equal_the_dense_series(spark, seed):
    rng = random.Random(seed)
    start = datetime.datetime(2024, 1, 1, 23, 0)
    rows = {(start + datetime.timedelta(minutes=5 * rng.randrange(700)), z, c) for z, c in ((1, 5), (2, 5), (3, 6), (4, None)) for _ in range(150)}
    frame = spark.createDataFrame([(a, z, c, rng.randrange(5)) for a, z, c in sorted(rows, key=str)], "window_start timestamp, pickup_zone_id long, pickup_h3 long, pickup_count long")
    lags = (1, 12, 288)
    filled = sr.densify(frame).withColumn("pickup_zone_id", F.lit(0).cast("bigint"))
    names = [*map(sr.lag_name, lags), "target_pickup_count"]
    dense = frame.join(sr.row_lags(filled, lags).select("window_start", "pickup_h3", *names), ["window_start", "pickup_h3"])
    got = sr.dense_lags(frame, lags)
    assert content(got) == content(dense)
    assert got.count() == frame.filter("pickup_h3 IS NOT NULL").count()
    assert "Generate explode(sequence" not in got._jdf.queryExecution().executedPlan().toString()


def test_repeated_zone_lists_dont_multiply_trips(spark):
    from cabgrid.operators import demand as dm
    from cabgrid.operators import zonefill

    cells = spark.createDataFrame([(1, [5, 6]), (1, [6, 7]), (2, [9])], "LocationID int, h3_cells array<long>")
    some = spark.createDataFrame([(i, 1 + i % 3) for i in range(30)], "trip_id long, PULocationID long")
    got = dm.assign_cells(some, zonefill.positions_of(cells), F.xxhash64("trip_id"))
    assert got.count() == 30
    assert {r[0] for r in got.filter("PULocationID = 1").select("pickup_h3").collect()} == {5, 6, 7}
    assert got.filter("PULocationID = 3 AND pickup_h3 IS NULL").count() == 10


def test_a_large_zone_is_numbered_without_lists(spark):
    """Some 200,000 cells of one zone: numbers without gaps, in cell order, and no list on the way."""
    from cabgrid.functions.hexgrid import HexGrid
    from cabgrid.operators import zonefill

    grid = HexGrid()
    ring = [[-80.0, 38.0], [-68.0, 38.0], [-68.0, 43.0], [-80.0, 43.0]]
    rings = spark.createDataFrame([(1, 0, 0, ring), (1, 1, 0, ring)], "LocationID int, part int, ring_no int, ring array<array<double>>")
    found = zonefill.zone_positions(rings, grid)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    path = session.scratch_path(spark, "large-zone")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    n = found.count()
    assert n > 200_000
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("LocationID").orderBy("h3_cell")) - 1
    assert found.withColumn("want", order).filter("want <> position OR n_cells <> " + str(n)).count() == 0
