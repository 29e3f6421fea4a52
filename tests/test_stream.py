"""The streaming demand aggregates against the batch one."""

from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cabgrid import schemas
from cabgrid.config import Settings
from cabgrid.operators.demand import demand_from_trips
from cabgrid.streaming import merged_demand as merging
from cabgrid.streaming.live_demand import live_demand, write_available

S = Settings()
T0 = datetime(2024, 1, 1)
KEPT = ("window_start", "window_end", "pickup_zone_id", "pickup_h3", "pickup_count", "avg_trip_distance")


def cells_of(spark):
    return spark.createDataFrame([(1, [10, 11, 12]), (2, [20])], "LocationID int, h3_cells array<bigint>")


def run(spark, folder, rows_by_file):
    """Write files in order, run the stream over them one file per batch."""
    source = str(folder / "in")
    for number, rows in enumerate(rows_by_file):
        full = [(i, at, zone, 1.0 * i, 2.0, 3.0, 4.0, 1) for i, at, zone in rows]
        frame = spark.createDataFrame(full, schemas.TRIPS).coalesce(1)
        frame.write.mode("append" if number else "overwrite").parquet(source)
    stream = spark.readStream.schema(schemas.TRIPS).option("maxFilesPerTrigger", 1).parquet(source)
    demand = live_demand(stream, cells_of(spark), S, F.col("trip_id"))
    out = str(folder / "out")
    write_available(demand, out, str(folder / "offsets")).awaitTermination()
    return spark.read.parquet(out), spark.read.schema(schemas.TRIPS).parquet(source)


def test_final_windows_equal_the_batch_result(spark, tmp_path):
    files = [[(n * 100 + i, T0 + timedelta(minutes=10 * n, seconds=7 * i), 1 + i % 2) for i in range(80)] for n in range(5)]
    live, trips = run(spark, tmp_path, files)
    batch = demand_from_trips(trips, cells_of(spark), S, F.col("trip_id"))
    last = trips.agg(F.max("tpep_pickup_datetime")).first()[0] - timedelta(minutes=10)
    expected = batch.filter(F.col("window_end") <= F.lit(last)).select(*KEPT).collect()
    got = live.select(*KEPT).collect()
    assert expected and Counter(map(tuple, got)) == Counter(map(tuple, expected))


def test_stream_without_broadcasts_gives_the_same(spark, tmp_path, conf):
    files = [[(n * 100 + i, T0 + timedelta(minutes=10 * n, seconds=7 * i), 1 + (i % 9 == 0)) for i in range(80)] for n in range(3)]
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    small, _ = run(spark, tmp_path / "a", files)
    expected = Counter(map(tuple, small.select(*KEPT).collect()))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    large, _ = run(spark, tmp_path / "b", files)
    assert expected and Counter(map(tuple, large.select(*KEPT).collect())) == expected


def test_unknown_zones_do_not_move_the_watermark(spark, tmp_path):
    files = [[(1, T0, 1)], [(2, T0 + timedelta(days=3), 264)], [(3, T0 + timedelta(minutes=1), 1)]]
    live, _ = run(spark, tmp_path, files)
    assert live.count() == 0


def test_late_trips_are_dropped_once_their_window_is_final(spark, tmp_path):
    later = T0 + timedelta(hours=2)
    files = [
        [(1, T0, 2)],
        [(2, later, 2)],
        [(3, later + timedelta(minutes=1), 2)],
        [(4, T0 + timedelta(minutes=1), 2)],
        [(5, T0 + timedelta(hours=4), 2)],
    ]
    live, _ = run(spark, tmp_path, files)
    got = {(r.window_start, r.pickup_count) for r in live.collect()}
    assert got == {(T0, 1), (later, 2)}


def test_rerun_adds_nothing(spark, tmp_path):
    live, _ = run(spark, tmp_path, [[(1, T0, 2)], [(2, T0 + timedelta(hours=2), 2)]])
    before = live.count()
    stream = spark.readStream.schema(schemas.TRIPS).parquet(str(tmp_path / "in"))
    again = live_demand(stream, cells_of(spark), S, F.col("trip_id"))
    write_available(again, str(tmp_path / "out"), str(tmp_path / "offsets")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == before


ALL = (*KEPT, "pickup_lat", "avg_fare", "window_start_date")


def trip_rows(spark, rows):
    return spark.createDataFrame([(i, at, zone, 1.0 * i if i % 5 else None, 2.0, 3.0, 4.0, 1) for i, at, zone in rows], schemas.TRIPS)


def merge_all(spark, folder):
    stream = spark.readStream.schema(schemas.TRIPS).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    layout = merging.Layout(str(folder / "out"))
    merging.merge_available(stream, cells_of(spark), layout, S, F.col("trip_id")).awaitTermination()
    return layout


def compared(spark, folder, layout):
    """Rows of the merged table and of the batch aggregate over all trips."""
    trips = spark.read.schema(schemas.TRIPS).parquet(str(folder / "in"))
    batch = demand_from_trips(trips, cells_of(spark), S, F.col("trip_id"))
    columns = [c for c in ALL if c in batch.columns]
    return (Counter(map(tuple, df.select(*columns).collect())) for df in (spark.read.parquet(layout.demand), batch))


LATE_FILES = [
    [(i, T0 + timedelta(minutes=7 * i), 1 + i % 2) for i in range(60)],
    [(100 + i, T0 + timedelta(days=3, minutes=i), 1 + i % 2) for i in range(30)],
    # Three days behind, in windows that have trips and in new ones; unknown, unmapped and missing zones.
    [(200 + i, T0 + timedelta(minutes=7 * i, seconds=5), 1) for i in range(70)],
    [(300, T0, 264), (301, T0, 7), (302, T0, None), (303, T0 + timedelta(days=5), 265)],
]


def write_files(spark, folder, files):
    for rows in files:
        trip_rows(spark, rows).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def test_late_trips_reach_their_windows(spark, tmp_path):
    write_files(spark, tmp_path, LATE_FILES)
    got, expected = compared(spark, tmp_path, merge_all(spark, tmp_path))
    assert expected and got == expected


def test_a_replayed_batch_counts_once(spark, tmp_path):
    """The stream stops after a batch was merged and before that was noted; it runs the batch again."""
    write_files(spark, tmp_path, LATE_FILES)
    layout = merge_all(spark, tmp_path)
    commits = tmp_path / "out" / "log" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    merge_all(spark, tmp_path)
    assert (commits / str(last)).exists()
    got, expected = compared(spark, tmp_path, layout)
    assert got == expected
    # Any batch may be merged again, in any order.
    again = trip_rows(spark, LATE_FILES[0])
    folders = {}
    for batch_id in range(4):
        rows = spark.read.parquet(layout.partials).filter(F.col("batch_id") == batch_id)
        folders[batch_id] = rows.agg(F.sum("pickup_count")).first()[0]
    first = next(b for b, n in folders.items() if n == 60)
    assert merging.merge_batch(again, first, cells_of(spark), layout, S, F.col("trip_id")) == [T0.date()]
    got, expected = compared(spark, tmp_path, layout)
    assert got == expected


def test_other_dates_keep_their_files(spark, tmp_path):
    write_files(spark, tmp_path, LATE_FILES[:2])
    layout = merge_all(spark, tmp_path)

    def files(date):
        return {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out" / "demand" / f"window_start_date={date}").iterdir()}

    before = {date: files(date) for date in (T0.date(), (T0 + timedelta(days=3)).date())}
    write_files(spark, tmp_path, LATE_FILES[2:3])
    merge_all(spark, tmp_path)
    assert files(T0.date()).keys() != before[T0.date()].keys()
    assert files((T0 + timedelta(days=3)).date()) == before[(T0 + timedelta(days=3)).date()]


def test_batches_without_trips_write_nothing(spark, tmp_path):
    layout = merging.Layout(str(tmp_path / "out"))
    merge = lambda rows, n: merging.merge_batch(trip_rows(spark, rows), n, cells_of(spark), layout, S, F.col("trip_id"))
    assert merge([(2, T0, 264)], 0) == [] and merge([], 1) == []
    assert merge([(1, T0, 1)], 2) == [T0.date()]
    assert merge([], 3) == [] and merge([(2, T0, 264)], 4) == []
    assert spark.read.parquet(layout.demand).agg(F.sum("pickup_count")).first()[0] == 1
