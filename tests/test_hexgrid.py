"""Grid properties: every point has one cell, centres map back, distance is a metric."""

import math
from collections import deque

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabgrid.functions import hexgrid
from cabgrid.functions.hexgrid import AXIS_HALF, AXIS_STEP, HexGrid

GRID = HexGrid()
FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
LAT = st.floats(40.3, 41.1)
LON = st.floats(-74.5, -73.4)
AXIS = st.integers(-300, 300)


def pack(q, r):
    return (q + AXIS_HALF) * AXIS_STEP + r + AXIS_HALF


@FEW
@given(st.lists(st.tuples(LAT, LON), min_size=50, max_size=200))
def test_point_is_nearest_to_the_centre_of_its_cell(spark, points):
    df = spark.createDataFrame(points, "lat double, lon double").withColumn("cell", GRID.cell_of("lat", "lon"))
    around = df.select("lat", "lon", "cell", F.explode(hexgrid.neighbours("cell", 1)).alias("other"))

    def metres(cell):
        dx = (F.col("lon") - GRID.center_lon(cell)) * GRID.metres_per_lon
        dy = (F.col("lat") - GRID.center_lat(cell)) * GRID.metres_per_lat
        return F.sqrt(dx * dx + dy * dy)

    measured = around.select(metres("cell").alias("own"), metres("other").alias("next"))
    assert measured.filter("own > next + 1e-6").count() == 0
    assert measured.agg(F.max("own")).first()[0] <= GRID.edge_m + 1e-6


@FEW
@given(st.lists(st.tuples(AXIS, AXIS), min_size=50, max_size=200))
def test_centre_maps_back_to_its_cell(spark, axes):
    df = spark.createDataFrame([(pack(q, r), q, r) for q, r in axes], "cell bigint, q bigint, r bigint")
    back = df.withColumn("center", GRID.center_of("cell"))
    back = back.withColumn("again", GRID.cell_of("center.lat", "center.lon"))
    wrong = back.filter(
        (F.col("again") != F.col("cell"))
        | (hexgrid.cell_q("cell") != F.col("q"))
        | (hexgrid.cell_r("cell") != F.col("r"))
    )
    assert wrong.count() == 0


@FEW
@given(st.lists(st.tuples(AXIS, AXIS, AXIS, AXIS, AXIS, AXIS), min_size=50, max_size=200))
def test_distance_is_a_metric(spark, axes):
    rows = [(pack(a, b), pack(c, d), pack(e, f)) for a, b, c, d, e, f in axes]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint").select(
        "a",
        "b",
        hexgrid.grid_distance("a", "b").alias("ab"),
        hexgrid.grid_distance("b", "a").alias("ba"),
        hexgrid.grid_distance("b", "c").alias("bc"),
        hexgrid.grid_distance("a", "c").alias("ac"),
    )
    assert df.filter("ab <> ba OR ac > ab + bc OR (ab = 0) <> (a = b) OR ab < 0").count() == 0


def test_distance_counts_steps(spark):
    """Breadth-first search over the six neighbours."""
    start, limit = (0, 0), 5
    steps = {start: 0}
    queue = deque([start])
    while queue:
        q, r = queue.popleft()
        if steps[q, r] == limit:
            continue
        for dq, dr in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)):
            if (q + dq, r + dr) not in steps:
                steps[q + dq, r + dr] = steps[q, r] + 1
                queue.append((q + dq, r + dr))
    rows = [(pack(0, 0), pack(q, r), n) for (q, r), n in steps.items()]
    df = spark.createDataFrame(rows, "a bigint, b bigint, n int")
    assert df.filter(hexgrid.grid_distance("a", "b") != F.col("n")).count() == 0


@pytest.mark.parametrize("k", [1, 2, 4])
def test_ring_sizes(spark, k):
    df = spark.createDataFrame([(pack(3, -7),)], "cell bigint")
    near = df.select("cell", F.explode(hexgrid.neighbours("cell", k)).alias("other"))
    distances = near.select(hexgrid.grid_distance("cell", "other").alias("d")).groupBy("d").count().collect()
    assert {row["d"]: row["count"] for row in distances} == {d: 6 * d for d in range(1, k + 1)}
    steps = dict(hexgrid.ring_steps(k))
    assert len(steps) == 3 * k * (k + 1)


def test_missing_coordinates_have_no_cell(spark):
    df = spark.createDataFrame([(None, -73.9), (40.7, None)], "lat double, lon double")
    assert [r[0] for r in df.select(GRID.cell_of("lat", "lon")).collect()] == [None, None]
    empty = df.selectExpr("CAST(NULL AS BIGINT) AS cell")
    assert [r[0] for r in empty.select(GRID.center_of("cell")).collect()] == [None, None]


def test_finer_grid_has_a_seventh_of_the_area():
    assert math.isclose(GRID.finer().edge_m ** 2 * 7, GRID.edge_m**2)
