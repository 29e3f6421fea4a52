"""Operators against brute force on small inputs, with the awkward cases."""

import math
import random
from collections import Counter, defaultdict
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabgrid import schemas
from cabgrid.config import Settings
from cabgrid.functions import hexgrid, scalars
from cabgrid.functions.hexgrid import AXIS_HALF, AXIS_STEP
from cabgrid.operators import demand as dm
from cabgrid.operators import features as ft
from cabgrid.operators import quality, recommend, serving, stations, weather, zonefill
from cabgrid.operators import series as sr
from cabgrid.operators import typical as ty
from cabgrid.sources import tables as src

S = Settings()
GRID = S.grid
T0 = datetime(2024, 1, 1)


def pack(q, r):
    return (q + AXIS_HALF) * AXIS_STEP + r + AXIS_HALF


def unpack(cell):
    return (cell >> 21) - AXIS_HALF, (cell & (AXIS_STEP - 1)) - AXIS_HALF


def steps(a, b):
    (q1, r1), (q2, r2) = unpack(a), unpack(b)
    return max(abs(q1 - q2), abs(r1 - r2), abs(q1 - q2 + r1 - r2))


# --- polygon fill ----------------------------------------------------------------------------


def brute_fill(rings):
    """Even-odd test of every centre in the bounding box, part by part."""
    cells = set()
    for part in {p for p, _, _ in rings}:
        edges = []
        for p, _, ring in rings:
            if p == part:
                edges += list(zip(ring, ring[1:] + ring[:1]))
        ys = [y for a, b in edges for y in (a[1], b[1])]
        xs = [x for a, b in edges for x in (a[0], b[0])]
        row = GRID.metres_per_lat / GRID.row_height_m
        for r in range(math.floor((min(ys) - GRID.lat0) * row), math.ceil((max(ys) - GRID.lat0) * row) + 1):
            y = GRID.lat0 + r * GRID.row_height_m / GRID.metres_per_lat
            per = GRID.metres_per_lon / GRID.column_width_m
            low, high = ((x - GRID.lon0) * per - r / 2 for x in (min(xs), max(xs)))
            for q in range(math.floor(low) - 1, math.ceil(high) + 2):
                x = GRID.lon0 + (q + r * 0.5) * GRID.column_width_m / GRID.metres_per_lon
                crossings = sum(
                    (a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1])
                    for a, b in edges
                )
                if crossings % 2:
                    cells.add(pack(q, r))
    return cells


def fill(spark, zones):
    rows = [(zone, part, no, [list(p) for p in ring]) for zone, rings in zones.items() for part, no, ring in rings]
    rings = spark.createDataFrame(rows, schemas.ZONE_RINGS)
    return {row.LocationID: row.h3_cells for row in zonefill.zone_cells(rings, GRID).collect()}


def test_fill_matches_brute_force(spark):
    rng = random.Random(5)
    zones = {}
    for zone in range(1, 13):
        cx, cy = -73.97 + rng.uniform(-0.1, 0.1), 40.7 + rng.uniform(-0.1, 0.1)
        spokes = rng.randint(3, 11)
        star = [
            (
                cx + rng.uniform(0.004, 0.04) * math.cos(2 * math.pi * i / spokes),
                cy + rng.uniform(0.004, 0.03) * math.sin(2 * math.pi * i / spokes),
            )
            for i in range(spokes)
        ]
        zones[zone] = [(0, 0, star)]
    got = fill(spark, zones)
    for zone, rings in zones.items():
        expected = brute_fill(rings)
        if expected:
            assert got[zone] == sorted(expected)
        else:
            assert len(got[zone]) == 1


def test_parts_are_merged_and_holes_left_out(spark):
    outline = [(-74.0, 40.7), (-73.9, 40.701), (-73.901, 40.78), (-74.001, 40.779)]
    hole = [(-73.97, 40.72), (-73.93, 40.721), (-73.931, 40.76), (-73.971, 40.759)]
    left = [(-74.05, 40.7), (-73.99, 40.7), (-73.99, 40.75), (-74.05, 40.75)]
    zones = {1: [(0, 0, outline)], 2: [(0, 0, outline), (0, 1, hole)], 3: [(0, 0, outline), (1, 0, left)], 4: [(0, 0, hole)]}
    got = {zone: set(cells) for zone, cells in fill(spark, zones).items()}
    assert got[2] == brute_fill(zones[2]) and got[3] == brute_fill(zones[3])
    assert got[2] == got[1] - got[4] and got[4] <= got[1]
    assert len(got[3]) < len(got[1]) + len(brute_fill([(0, 0, left)]))


@pytest.mark.parametrize("turn", [1, -1])
def test_tiny_zone_gets_the_cell_of_its_centroid(spark, turn):
    ring = [(-73.9612, 40.7301), (-73.9610, 40.7301), (-73.9611, 40.7303)][::turn]
    (cells,) = fill(spark, {7: [(0, 0, ring)]}).values()
    lat, lon = sum(p[1] for p in ring) / 3, sum(p[0] for p in ring) / 3
    expected = spark.range(1).select(GRID.cell_of(hexgrid.double(lat), hexgrid.double(lon))).first()[0]
    assert cells == [expected]


def test_flat_ring_still_gets_a_cell(spark):
    got = fill(spark, {8: [(0, 0, [(-73.95, 40.71), (-73.94, 40.72), (-73.95, 40.71)])]})
    assert len(got[8]) == 1


# --- demand ----------------------------------------------------------------------------------


def trips_of(spark, rows):
    full = [(i, at, zone, 1.0 * i, 2.0, 3.0, None, 1) for i, (at, zone) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.TRIPS)


def test_unknown_and_missing_zones_are_dropped_and_unmapped_ones_kept(spark):
    trips = trips_of(spark, [(T0, 1), (T0, 264), (T0, 265), (T0, None), (T0, 99)])
    cells = spark.createDataFrame([(1, [pack(0, 0)])], "LocationID int, h3_cells array<bigint>")
    rows = dm.demand_from_trips(trips, cells, S).collect()
    assert {(r.pickup_zone_id, r.pickup_h3, r.pickup_lat is None) for r in rows} == {
        (1, pack(0, 0), False),
        (99, None, True),
    }
    rejects = quality.trip_rejects(trips, cells, S.unknown_zones).first()
    assert tuple(rejects) == (5, 1, 2, 1)


def test_every_trip_gets_one_cell_of_its_zone_however_it_is_joined(spark, conf):
    zones = {1: [pack(0, i) for i in range(7)], 2: [pack(5, 5)]}
    # one zone holds nine trips in ten
    trips = trips_of(spark, [(T0 + timedelta(seconds=i), 2 if i % 10 == 0 else 1) for i in range(500)])
    cells = spark.createDataFrame(list(zones.items()), "LocationID int, h3_cells array<bigint>")
    plain = {r.trip_id: r.pickup_h3 for r in dm.assign_cells(trips, cells).collect()}
    assert len(plain) == 500
    assert all(plain[r.trip_id] in zones[r.PULocationID] for r in trips.collect())
    assert set(plain.values()) == set(zones[1] + zones[2])
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    shuffled = {r.trip_id: r.pickup_h3 for r in dm.assign_cells(trips.repartition(7), cells).collect()}
    assert shuffled == plain


def test_a_zone_without_cells_gives_no_cell(spark):
    trips = trips_of(spark, [(T0, 1), (T0, 2), (T0, 3)])
    cells = spark.createDataFrame([(1, [pack(0, 0)]), (2, []), (3, None)], "LocationID int, h3_cells array<bigint>")
    got = {r.PULocationID: r.pickup_h3 for r in dm.assign_cells(trips, cells).collect()}
    assert got == {1: pack(0, 0), 2: None, 3: None}
    assert quality.trip_rejects(trips, cells, ()).first().unmapped_zone == 2
    assert {r.LocationID for r in quality.zones_without_cells(cells).collect()} == {2, 3}


def test_windows_are_half_open(spark):
    trips = trips_of(spark, [(T0, 1), (T0 + timedelta(minutes=4, seconds=59), 1), (T0 + timedelta(minutes=5), 1)])
    cells = spark.createDataFrame([(1, [pack(0, 0)])], "LocationID int, h3_cells array<bigint>")
    rows = dm.demand_from_trips(trips, cells, S).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.pickup_count) for r in rows] == [
        (T0, T0 + timedelta(minutes=5), 2),
        (T0 + timedelta(minutes=5), T0 + timedelta(minutes=10), 1),
    ]
    assert rows[0].avg_tip_pct is None and rows[0].avg_trip_distance == 0.5


def test_repeated_zones_are_reported(spark):
    cells = spark.createDataFrame([(1, [1]), (1, [2]), (2, [3])], "LocationID int, h3_cells array<bigint>")
    assert [tuple(r) for r in quality.repeated_zones(cells).collect()] == [(1, 2)]


# --- series ----------------------------------------------------------------------------------


def series_of(spark, seed, cells=4, rows=400, hot=600):
    """Sparse windows; cell 0 is much longer; two zones may share a cell and window."""
    rng = random.Random(seed)
    made = []
    for c in range(cells):
        at = T0
        for _ in range(hot if c == 0 else rng.randint(1, rows)):
            at += timedelta(minutes=5 * rng.choice([1, 1, 1, 2, 40, 700 if c else 1]))
            for zone in rng.choice([(c,), (c,), (c, c + 100)]):
                made.append((at, zone, pack(c, 0), rng.randint(1, 9)))
    made.append((T0, 9, None, 5))
    return spark.createDataFrame(
        made, "window_start timestamp, pickup_zone_id bigint, pickup_h3 bigint, pickup_count bigint"
    )


@pytest.mark.parametrize("rows_per_block", [30, 47, 288, 100_000])
def test_blocked_lags_equal_one_window_per_cell(spark, rows_per_block):
    demand = series_of(spark, rows_per_block)
    lags = (1, 12, 30)
    whole = Window.partitionBy("pickup_h3").orderBy("window_start", "pickup_zone_id")
    expected = demand.filter("pickup_h3 IS NOT NULL").withColumns(
        {
            "target_pickup_count": F.lead("pickup_count").over(whole),
            "prev_demand": F.lag("pickup_count", 1).over(whole),
            "lag_12": F.lag("pickup_count", 12).over(whole),
            "lag_30": F.lag("pickup_count", 30).over(whole),
        }
    )
    got = sr.row_lags(demand, lags, rows_per_block).select(*expected.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_blocks_bound_the_rows_of_a_task(spark):
    demand = series_of(spark, 1).filter("pickup_h3 IS NOT NULL")
    lookback, size = 30, 50
    plan = sr.block_plan(demand, lookback, size)
    copied = demand.withColumn("day", F.to_date("window_start")).join(plan, ["pickup_h3", "day"])
    copies = copied.select("pickup_h3", "day", F.explode("readers").alias("reader")).cache()
    longest_day = demand.groupBy("pickup_h3", F.to_date("window_start")).count().agg(F.max("count")).first()[0]
    most = copies.groupBy("pickup_h3", "reader").count().agg(F.max("count")).first()[0]
    assert most <= size + lookback + 3 * longest_day
    assert copies.groupBy("pickup_h3").agg(F.count_distinct("reader").alias("n")).agg(F.max("n")).first()[0] > 5


def test_lag_longer_than_a_block_is_refused(spark):
    with pytest.raises(ValueError):
        sr.row_lags(series_of(spark, 1), (288,), 100)


def test_calendar_lags_look_back_in_time(spark):
    demand = series_of(spark, 3).filter("pickup_h3 IS NOT NULL")
    totals = defaultdict(int)
    for r in demand.collect():
        totals[r.pickup_h3, r.window_start] += r.pickup_count
    got = sr.calendar_lags(demand).collect()
    assert len(got) == demand.count()
    for r in got:
        for s in (300, 3600, 86400):
            assert r[f"demand_{s}s_ago"] == totals.get((r.pickup_h3, r.window_start - timedelta(seconds=s)))
    assert any(r.demand_86400s_ago for r in got)


def test_dense_series_has_every_window(spark):
    demand = series_of(spark, 4)
    totals, spans = defaultdict(int), defaultdict(list)
    for r in demand.collect():
        if r.pickup_h3:
            totals[r.pickup_h3, r.window_start] += r.pickup_count
            spans[r.pickup_h3].append(r.window_start)
    got = {(r.pickup_h3, r.window_start): r.pickup_count for r in sr.densify(demand).collect()}
    size = sum((max(v) - min(v)) // timedelta(minutes=5) + 1 for v in spans.values())
    assert len(got) == size
    assert all(got[key] == totals.get(key, 0) for key in got)
    assert sum(got.values()) == sum(totals.values())


# --- weather and features --------------------------------------------------------------------


def test_weather_classes(spark):
    rows = [
        (0.0, 0.0, 0.0),
        (0.1, 0.1, 14.999),
        (0.11, 0.0, 15.0),
        (5.0, 0.2, 25.0),
        (None, None, None),
        (0.2, None, -3.0),
        (None, 0.3, 24.9),
    ]
    df = spark.createDataFrame(rows, "rain double, snow double, temp_2m double")
    got = [tuple(r)[3:] for r in weather.classify(df).collect()]
    assert got == [
        (0, 0, "Clear", "Freezing"),
        (0, 0, "Clear", "Cold"),
        (1, 0, "Rain", "Moderate"),
        (1, 1, "Snow", "Hot"),
        (0, 0, None, None),
        (1, 0, "Rain", "Freezing"),
        (0, 1, "Snow", "Moderate"),
    ]


def test_places_without_hours_are_reported(spark):
    places = src.weather_places(spark)
    assert places.count() == 6 and not any(f.nullable for f in places.schema.fields)
    landed = spark.createDataFrame(
        [("Queens", 1.0, 1.0, [T0], [1.0], [0.0], [0.0], [0.0], [2.0]), ("Bronx", 1.0, 1.0, [], [], [], [], [], [])],
        schemas.WEATHER_LANDED,
    )
    assert weather.hourly_weather(landed).count() == 1
    missing = {r.borough for r in weather.missing_places(places, landed).collect()}
    assert missing == {"Manhattan", "Brooklyn", "Bronx", "Staten Island", "EWR"}


def test_features_fill_only_named_columns(spark):
    demand = spark.createDataFrame(
        [(T0 + timedelta(minutes=5 * i), 1, pack(0, 0), 40.0, -73.0, i + 1, None, None, None, None, None) for i in range(3)],
        "window_start timestamp, pickup_zone_id bigint, pickup_h3 bigint, pickup_lat double, pickup_lon double,"
        "pickup_count bigint, avg_trip_distance double, avg_fare double, avg_speed double, avg_tip_pct double,"
        "avg_passengers double",
    )
    zones = spark.createDataFrame([("1", "Queens", "z")], schemas.ZONE_LOOKUP_CSV)
    hours = weather.hourly_weather(spark.createDataFrame([], schemas.WEATHER_LANDED))
    rows = ft.demand_features(demand, zones, hours, S).orderBy("window_start").collect()
    assert [(r.pickup_count, r.target_pickup_count, r.prev_demand, r.lag_12) for r in rows] == [(1, 2, 0, 0), (2, 3, 1, 0)]
    assert all(r.borough == "Queens" and r.temp_2m == 0.0 and r.weather_type is None for r in rows)
    assert all(r.window_start_hour == 0 and r.day_of_week == 2 for r in rows)


# --- stations --------------------------------------------------------------------------------


def stations_at(spark, cells):
    rows = [(i, f"s{i}", 40.7, -73.9, i % 3, None if i % 4 == 0 else i % 5, cell) for i, cell in enumerate(cells)]
    return spark.createDataFrame(
        rows,
        "charger_id bigint, station_name string, lat double, lon double, fast_chargers int, level2_chargers int,"
        "charger_h3 bigint",
    )


def brute_nearest(cells, station_cells, k=3):
    return {
        cell: sorted((steps(cell, at), i) for i, at in enumerate(station_cells))[:k] for cell in set(cells)
    }


def scattered(seed, n, spread):
    rng = random.Random(seed)
    return [pack(rng.randint(-spread, spread), rng.randint(-spread, spread)) for _ in range(n)]


@pytest.mark.parametrize(
    "cells, station_cells",
    [
        (scattered(1, 80, 40), scattered(2, 60, 40)),
        # a dense block far from all cells
        (scattered(3, 40, 20), [pack(900 + i % 20, -700 + i // 20) for i in range(300)]),
        # a third of all stations in one cell, ties everywhere
        (scattered(4, 60, 6), [pack(0, 0)] * 40 + scattered(5, 80, 6)),
        # fewer stations than asked for
        (scattered(6, 30, 30), [pack(25, -3), pack(-28, 4)]),
        # across the tile borders around the origin and far away
        ([pack(q, r) for q in (-1, 0) for r in (-1, 0)], scattered(7, 30, 3) + [pack(-5000, 5000)]),
    ],
)
def test_nearest_stations_match_brute_force(spark, cells, station_cells):
    df = spark.createDataFrame([(c,) for c in cells], "h3_cell bigint")
    got = defaultdict(list)
    for r in stations.nearest_stations(df, stations_at(spark, station_cells)).orderBy("priority").collect():
        assert r.priority == len(got[r.h3_cell]) + 1
        got[r.h3_cell].append((r.charger_distance, r.charger_id))
    assert got == brute_nearest(cells, station_cells)


def test_wide_table_scores_and_long_rows(spark):
    shared, alone = pack(0, 0), pack(40, 0)
    rows = spark.createDataFrame([(2, shared), (1, shared), (1, alone)], "LocationID int, h3_cell bigint")
    near = stations.nearest_table(rows, stations_at(spark, [pack(0, 1), pack(3, 0)]))
    got = {(r.LocationID, r.h3_cell): r for r in near.collect()}
    assert len(got) == 3
    assert got[1, shared].priority_1 == 0 and got[1, alone].priority_1 == 1
    assert got[1, shared].priority_3 is None and got[1, shared].P3_charger_station_name is None
    scores = {r.h3_cell: r.charger_score for r in stations.cell_scores(near, S).collect()}
    # station 0 has no readable count, station 1 has one fast and one level 2 charger
    assert scores[shared] == pytest.approx(3.5 * 0.6) and scores[alone] == pytest.approx(3.5)
    long = stations.long_stations(near).filter("LocationID = 1").orderBy("h3_cell", "priority").collect()
    assert [(r.priority, r.name, r.fast, r.level2) for r in long[:3]] == [(1, "s0", 0, 0), (2, "s1", 1, 1), (3, None, 0, 0)]


def test_cleaning_is_tolerant_and_ids_are_stable(spark):
    rows = [
        ("in", "40.45", "-74.30", "2", "x"),
        ("in too", "40.95", "-73.65", None, "3"),
        ("outside", "40.449", "-74.0", "1", "1"),
        ("bad", "n/a", "-74.0", "1", "1"),
        ("none", None, None, "1", "1"),
    ]
    raw = spark.createDataFrame(rows, schemas.STATIONS_CSV)
    once = {r.station_name: r for r in stations.clean_stations(raw, S).collect()}
    assert set(once) == {"in", "in too"}
    assert once["in"].level2_chargers is None and once["in"].fast_chargers == 2
    again = {r.station_name: r.charger_id for r in stations.clean_stations(raw.repartition(3), S).collect()}
    assert again == {name: r.charger_id for name, r in once.items()}
    assert tuple(stations.rejected_stations(raw).first()) == (5, 2, 0, 1)


def test_one_point_per_coordinate(spark):
    rows = [(3, "c", 40.7, -73.9, 1, 0), (1, "a", 40.7, -73.9, 0, 2), (2, "b", 40.8, -73.9, None, None), (4, "d", None, -73.9, 5, 5)]
    df = spark.createDataFrame(
        rows, "charger_id bigint, station_name string, lat double, lon double, fast_chargers int, level2_chargers int"
    )
    points = stations.station_points(df)
    assert {(r.name, r.fast, r.level2, r.station_class) for r in points.collect()} == {
        ("a", 0, 2, "level2_only"),
        ("b", 0, 0, "level2_only"),
    }
    assert tuple(stations.station_statistics(points).first()) == (2, 0, 2)


# --- recommendations and answers -------------------------------------------------------------


def typical_of(spark, rows):
    return spark.createDataFrame(
        rows,
        "pickup_h3 bigint, hour_of_day int, day_of_week int, typical_demand double, demand_p75 double",
    )


def brute_recommendations(rows, scores):
    demand = {(c, h, d): v for c, h, d, v, _ in rows}
    out = {}
    for origin, h, d in demand:
        cands = [
            (c, steps(origin, c), v, scores.get(c, 0.0))
            for (c, h2, d2), v in demand.items()
            if (h2, d2) == (h, d) and c != origin and steps(origin, c) <= 4
        ]
        if not cands:
            continue

        def scale(i, x):
            values = [c[i] for c in cands]
            return (x - min(values)) / (max(values) - min(values) + 1e-9)

        ranked = sorted(
            cands, key=lambda c: (-(0.5 * scale(2, c[2]) - 0.25 * scale(1, c[1]) + 0.25 * scale(3, c[3])), c[0])
        )
        out[origin, h, d] = [c[0] for c in ranked[:5]]
    return out


def test_recommendations_match_brute_force(spark, conf):
    rng = random.Random(11)
    cells = list(set(scattered(12, 60, 8)))
    rows = [(c, h, d, rng.randint(1, 9) / 2, 1.0) for c in cells for h, d in ((8, 2), (23, 7)) if rng.random() < 0.7]
    rows.append((pack(500, 500), 8, 2, 3.0, 1.0))  # nobody around
    rows += [(pack(300, 0), 8, 2, 3.0, 1.0), (pack(300, 1), 8, 2, 3.0, 1.0)]  # one candidate each
    scores = {c: rng.randint(0, 20) / 4 for c in cells[::2]}
    table = spark.createDataFrame(list(scores.items()), "h3_cell bigint, charger_score double")
    for threshold in ("10485760", "-1"):
        conf(spark__sql__autoBroadcastJoinThreshold=threshold)
        got = recommend.recommendations(typical_of(spark, rows), table, S).orderBy("rank").collect()
        by_slot = defaultdict(list)
        for r in got:
            assert r.rank == len(by_slot[r.origin_h3, r.hour_of_day, r.day_of_week]) + 1
            by_slot[r.origin_h3, r.hour_of_day, r.day_of_week].append(r.candidate_h3)
        assert by_slot == brute_recommendations(rows, scores)


def test_scaled_terms_stay_within_bounds(spark):
    rows = [(c, 8, 2, 2.0, 1.0) for c in set(scattered(13, 40, 4))]  # all demand equal
    pairs = recommend.candidates(typical_of(spark, rows).withColumn("charger_score", F.lit(0.0)), 4)
    scored = recommend.score(pairs, S)
    terms = ("norm_demand", "norm_distance", "norm_charger")
    assert scored.filter(" OR ".join(f"{t} < 0 OR {t} > 1 OR {t} IS NULL" for t in terms)).count() == 0


def points_of(spark, rows):
    return spark.createDataFrame(rows, "driver_id bigint, lat double, lon double, ts timestamp")


def test_answers_for_many_drivers(spark):
    here = spark.range(1).select(GRID.cell_of("40.75D", "-73.98D")).first()[0]
    q, r = unpack(here)
    # 2024-01-01 was a Monday
    rows = [(here, 8, 2, 2.675, 1.0), (pack(q + 1, r), 8, 2, 1.125, 1.0), (pack(q, r + 2), 8, 2, 4.0, 1.0)]
    none = spark.createDataFrame([], "h3_cell bigint, charger_score double")
    recs = recommend.recommendations(typical_of(spark, rows), none, S)
    at = datetime(2024, 1, 1, 8, 30)
    points = points_of(
        spark,
        [
            (1, 40.75, -73.98, at),
            (2, 40.75, -73.98, at + timedelta(hours=1)),
            (3, 40.39, -73.98, at),
            (4, None, -73.98, at),
            (5, 40.75, -73.98, at + timedelta(days=7)),
        ],
    )
    answers = {r.driver_id: r for r in serving.recommend(points, recs, S).collect()}
    assert {k: v.status for k, v in answers.items()} == {
        1: "ok",
        2: "no_match",
        3: "out_of_area",
        4: "out_of_area",
        5: "ok",
    }
    first = answers[1].recommendations
    assert [a["rank"] for a in first] == [1, 2] and first[0].h3_cell == pack(q, r + 2)
    assert first[1].predicted_demand == 1.12 and first[0].grid_distance == 2
    assert answers[3].recommendations is None
    flat = serving.recommendation_rows(
        serving.recommend(points, recs, S).drop("lat", "lon").withColumnRenamed("ts", "at")
    )
    assert flat.count() == 4
    text = serving.to_json(serving.recommend(points, recs, S)).filter("driver_id = 1").first().response
    assert text.startswith('{"driver_h3":') and '"predicted_demand":4.0' in text


def test_charger_answers_use_the_lowest_zone(spark):
    here = spark.range(1).select(GRID.cell_of("40.75D", "-73.98D")).first()[0]
    rows = spark.createDataFrame([(9, here), (4, here)], "LocationID int, h3_cell bigint")
    near = stations.nearest_table(rows, stations_at(spark, scattered(1, 5, 3)))
    points = points_of(spark, [(1, 40.75, -73.98, T0), (2, 40.60, -73.98, T0)])
    got = {r.driver_id: (r.LocationID, r.status) for r in serving.nearest_chargers(points, near, S).collect()}
    assert got == {1: (4, "ok"), 2: (None, "no_match")}
    assert serving.charger_rows(points, near, S).count() == 3


def test_views_are_scaled_within_their_frame(spark):
    rows = [(c, h, d, float(c + h + d), 1.0) for c in range(4) for h in (8, 9) for d in (1, 2)]
    table = typical_of(spark, rows)
    slots = serving.intensity(table).groupBy("hour_of_day", "day_of_week").agg(F.min("intensity"), F.max("intensity"))
    assert all(r[2] == 0 and r[3] == pytest.approx(1) for r in slots.collect())
    view = serving.hour_view(table, 8)
    assert view.count() == 8 and view.filter("pickup_h3 = 0").count() == 2
    assert view.agg(F.max("intensity")).first()[0] == pytest.approx(1)
    assert serving.day_frames(table, 2).groupBy("hour_of_day").count().count() == 2
    wanted = spark.createDataFrame([(8, 1), (12, 1)], "hour_of_day int, day_of_week int")
    assert {tuple(r) for r in serving.heatmap_status(wanted, table).collect()} == {(8, 1, 4, "ok"), (12, 1, 0, "no_match")}


def test_typical_demand_leaves_out_rows_without_a_cell(spark):
    rows = [(T0, pack(0, 0), 1.0), (T0 + timedelta(days=7), pack(0, 0), 4.0), (T0, None, 9.0)]
    df = spark.createDataFrame(rows, "window_start timestamp, pickup_h3 bigint, predicted_demand double")
    assert [tuple(r) for r in ty.typical_demand(df).collect()] == [(pack(0, 0), 0, 2, 2.5, 4.0)]


def test_safe_int(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,), ("3.7",)], "v string")
    assert [r[0] for r in df.select(scalars.safe_int("v")).collect()] == [7, 0, 0, 0]
    numbers = spark.createDataFrame([(2.9,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in numbers.select(scalars.safe_int("v")).collect()] == [2, 0, 0]


def test_settings_are_parameters(spark):
    rows = [(pack(0, 0), 8, 2, 1.0, 1.0), (pack(0, 1), 8, 2, 2.0, 1.0), (pack(0, 4), 8, 2, 3.0, 1.0)]
    none = spark.createDataFrame([], "h3_cell bigint, charger_score double")
    near = recommend.recommendations(typical_of(spark, rows), none, replace(S, ring=1, top=1))
    assert {(r.origin_h3, r.candidate_h3) for r in near.collect()} == {
        (pack(0, 0), pack(0, 1)),
        (pack(0, 1), pack(0, 0)),
    }


def test_csv_rows_of_another_width_are_set_apart(spark, tmp_path):
    path = tmp_path / "stations.csv"
    head = "Station Name,Latitude,Longitude,EV DC Fast Count,EV Level2 EVSE Num\n"
    lines = ["a,40.7,-74.0,1,2", '"b, c",40.7,-74.0,,', "short,40.7,-74.0", "long,40.7,-74.0,1,2,3", "", "d,x,y,z,nan"]
    path.write_text(head + "\n".join(lines) + "\n")
    split = src.read_stations_rows(spark, str(path))
    assert [tuple(r) for r in split.rows.collect()] == [
        ("a", "40.7", "-74.0", "1", "2"),
        ("b, c", "40.7", "-74.0", None, None),
        ("d", "x", "y", "z", "nan"),
    ]
    assert [r.record for r in split.rejects.collect()] == ["short,40.7,-74.0", "long,40.7,-74.0,1,2,3"]
    assert all(r.file.endswith("stations.csv") for r in split.rejects.collect())
    # Pruned and counted reads see the same rows.
    assert split.rows.select("Latitude").count() == split.rows.count() == 3 and split.rejects.count() == 2
    # A file without broken rows, and one of only a header.
    path.write_text(head)
    none = src.read_stations_rows(spark, str(path))
    assert none.rows.count() == none.rejects.count() == 0


def test_a_column_named_like_the_record_of_broken_rows(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("_corrupt_record,b\n1,2\n3\n")
    split = src.read_csv_rows(spark, str(path), StructType.fromDDL("_corrupt_record string, b string"))
    assert [tuple(r) for r in split.rows.collect()] == [("1", "2")] and [r.record for r in split.rejects.collect()] == ["3"]
