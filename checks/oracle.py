"""The same inputs and operators in SQL for DuckDB, written independently of the Spark plans.

``query(select, *needs)`` puts the named building blocks in front of a select.
"""

from __future__ import annotations

import math

from checks.fixtures import HOURS, SETTINGS, SHAPES

GRID = SETTINGS.grid
FINE = GRID.finer()
HALF = 1 << 20
STEP = 1 << 21


def d(x: float) -> str:
    """A DOUBLE literal; plain decimals would be DECIMAL in DuckDB."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def r6(expr: str) -> str:
    """Round to six places with plain arithmetic, as the Spark side does."""
    return f"(floor(({expr}) * 1e6 + 0.5e0) / 1e6)"


def whole(text: str) -> str:
    """Whole part of a number in text; NULL where there is none."""
    value = f"try_cast(trim({text}) AS DOUBLE)"
    return f"(CASE WHEN NOT isnan({value}) THEN trunc({value})::INTEGER END)"


def q_of(cell: str) -> str:
    return f"(({cell} >> 21) - {HALF})"


def r_of(cell: str) -> str:
    return f"(({cell} & {STEP - 1}) - {HALF})"


def lat_of(cell: str, grid=GRID) -> str:
    return f"({d(grid.lat0)} + {r_of(cell)} * {d(grid.row_height_m)} / {d(grid.metres_per_lat)})"


def lon_of(cell: str, grid=GRID) -> str:
    return (
        f"({d(grid.lon0)} + ({q_of(cell)} + {r_of(cell)} * 0.5e0) * {d(grid.column_width_m)}"
        f" / {d(grid.metres_per_lon)})"
    )


def dist(a: str, b: str) -> str:
    dq, dr = f"({q_of(a)} - {q_of(b)})", f"({r_of(a)} - {r_of(b)})"
    return f"greatest(abs({dq}), abs({dr}), abs({dq} + {dr}))"


def with_cell(src: str, lat: str = "lat", lon: str = "lon", out: str = "cell", grid=GRID) -> str:
    """All columns of ``src`` plus the cell of a point."""
    return f"""
      SELECT * EXCLUDE (x_, y_, qf_, rf_, sf_, q_, r_, s_, dq_, dr_, ds_),
        ((CASE WHEN dq_ > dr_ AND dq_ > ds_ THEN -r_ - s_ ELSE q_ END)::BIGINT + {HALF}) * {STEP}
        + ((CASE WHEN NOT (dq_ > dr_ AND dq_ > ds_) AND dr_ > ds_ THEN -q_ - s_ ELSE r_ END)::BIGINT + {HALF})
          AS {out}
      FROM (
        SELECT *, ({lon} - {d(grid.lon0)}) * {d(grid.metres_per_lon)} AS x_,
          ({lat} - {d(grid.lat0)}) * {d(grid.metres_per_lat)} AS y_,
          x_ * {d(math.sqrt(3.0) / (3.0 * grid.edge_m))} - y_ * {d(1.0 / (3.0 * grid.edge_m))} AS qf_,
          y_ * {d(2.0 / (3.0 * grid.edge_m))} AS rf_,
          -qf_ - rf_ AS sf_,
          floor(qf_ + 0.5e0) AS q_, floor(rf_ + 0.5e0) AS r_, floor(sf_ + 0.5e0) AS s_,
          abs(q_ - qf_) AS dq_, abs(r_ - rf_) AS dr_, abs(s_ - sf_) AS ds_
        FROM ({src}) AS src_
      ) AS cube_
    """


def fill(edges: str, grid) -> str:
    """Zone cells by counting edge crossings east of every candidate centre."""
    rows_per_deg = grid.metres_per_lat / grid.row_height_m
    cols_per_deg = grid.metres_per_lon / grid.column_width_m
    return f"""
      WITH box AS (
        SELECT LocationID, part, min(x1) AS x_lo, max(x1) AS x_hi, min(y1) AS y_lo, max(y1) AS y_hi
        FROM {edges} GROUP BY LocationID, part
      ), grid_rows AS (
        SELECT *, unnest(generate_series(
          floor((y_lo - {d(grid.lat0)}) * {d(rows_per_deg)})::BIGINT - 1,
          ceil((y_hi - {d(grid.lat0)}) * {d(rows_per_deg)})::BIGINT + 1)) AS r
        FROM box
      ), lattice AS (
        SELECT LocationID, part, r, unnest(generate_series(
          floor((x_lo - {d(grid.lon0)}) * {d(cols_per_deg)} - r / 2.0e0)::BIGINT - 1,
          ceil((x_hi - {d(grid.lon0)}) * {d(cols_per_deg)} - r / 2.0e0)::BIGINT + 1)) AS q
        FROM grid_rows
      ), points AS (
        SELECT LocationID, part, (q + {HALF}) * {STEP} + (r + {HALF}) AS cell,
          {d(grid.lat0)} + r * {d(grid.row_height_m)} / {d(grid.metres_per_lat)} AS lat,
          {d(grid.lon0)} + (q + r * 0.5e0) * {d(grid.column_width_m)} / {d(grid.metres_per_lon)} AS lon
        FROM lattice
      ), inside AS (
        SELECT p.LocationID, p.part, p.cell
        FROM points p JOIN {edges} e ON p.LocationID = e.LocationID AND p.part = e.part
          AND (e.y1 > p.lat) <> (e.y2 > p.lat)
          AND p.lon < e.x1 + (p.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
        GROUP BY ALL HAVING count(*) % 2 = 1
      ), ring AS (
        SELECT LocationID, part, ring_no,
          sum((x1 - {d(grid.lon0)}) * (y2 - {d(grid.lat0)}) - (x2 - {d(grid.lon0)}) * (y1 - {d(grid.lat0)})) AS a,
          sum((x1 + x2 - 2 * {d(grid.lon0)})
            * ((x1 - {d(grid.lon0)}) * (y2 - {d(grid.lat0)}) - (x2 - {d(grid.lon0)}) * (y1 - {d(grid.lat0)}))) AS mx,
          sum((y1 + y2 - 2 * {d(grid.lat0)})
            * ((x1 - {d(grid.lon0)}) * (y2 - {d(grid.lat0)}) - (x2 - {d(grid.lon0)}) * (y1 - {d(grid.lat0)}))) AS my
        FROM {edges} GROUP BY ALL
      ), centroid AS (
        SELECT LocationID, {d(grid.lon0)} + sum(mx * s) / (3 * sum(a * s)) AS lon,
          {d(grid.lat0)} + sum(my * s) / (3 * sum(a * s)) AS lat
        FROM (SELECT *, sign(a) * CASE WHEN ring_no = 0 THEN 1 ELSE -1 END AS s FROM ring) AS signed
        GROUP BY LocationID
      )
      SELECT DISTINCT LocationID, cell FROM inside
      UNION ALL
      SELECT LocationID, cell FROM ({with_cell("SELECT * FROM centroid", grid=grid)}) AS c
      WHERE LocationID NOT IN (SELECT LocationID FROM inside)
    """


def _shape_rows() -> str:
    rows = []
    for kind, part, no, ring in SHAPES:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"({kind}, {part}, {no}, {d(ax)}, {d(ay)}, {d(bx)}, {d(by)})")
    return ", ".join(rows)


def weather_of(places: str) -> str:
    """Hours of places ``(borough, b)`` with classes."""
    return f"""
      SELECT *,
        CASE WHEN rain > 0.1e0 THEN 1 ELSE 0 END AS is_raining,
        CASE WHEN snow > 0.1e0 THEN 1 ELSE 0 END AS is_snowing,
        CASE WHEN snow > 0.1e0 THEN 'Snow' WHEN rain > 0.1e0 THEN 'Rain' ELSE 'Clear' END AS weather_type,
        CASE WHEN temp_2m <= 0 THEN 'Freezing' WHEN temp_2m < 15 THEN 'Cold' WHEN temp_2m < 25 THEN 'Moderate'
          WHEN temp_2m IS NOT NULL THEN 'Hot' END AS temp_bucket
      FROM (
        SELECT borough, TIMESTAMP '2024-01-01 00:00:00' + to_hours(i::BIGINT) AS time,
          CASE WHEN i % 97 <> 0 THEN ((i * 7 + b * 11) % 45 - 10)::DOUBLE END AS temp_2m,
          ((i * 3 + b) % 10) / 10e0 + CASE WHEN (i + b) % 17 = 0 THEN 0.5e0 ELSE 0e0 END AS precip,
          ((i * 3 + b) % 10) / 10e0 AS rain,
          CASE WHEN (i + b) % 17 = 0 THEN 0.5e0 ELSE 0e0 END AS snow,
          ((i + b * 5) % 40)::DOUBLE AS wind
        FROM ({places}) AS p, range(0, {HOURS}) AS h(i) WHERE i % 101 <> 0
      ) AS hours
    """


def station_pick(priority: int) -> str:
    """Columns of one priority in the wide station table."""
    p = priority
    picked = [f"max(charger_id) FILTER (priority = {p}) AS priority_{p}"]
    for name in ("station_name", "lat", "lon", "fast_chargers", "level2_chargers", "charger_h3"):
        out = f"P{p}_charger_{name.removeprefix('charger_')}"
        picked.append(f"max({name}) FILTER (priority = {p}) AS {out}")
    return ", ".join(picked)


_W = SETTINGS.weights
_BOX = SETTINGS.station_box
_AREA = SETTINGS.service_box
_LAG = "OVER (PARTITION BY pickup_h3 ORDER BY window_start, pickup_zone_id)"
_SLOT = "origin_h3, hour_of_day, day_of_week"


def _plugs(p: int) -> str:
    return (
        f"(coalesce(P{p}_charger_fast_chargers, 0) * {d(_W.fast)}"
        f" + coalesce(P{p}_charger_level2_chargers, 0) * {d(_W.level2)}) * {d(_W.by_priority[p - 1])}"
    )


def _scaled(name: str) -> str:
    over = f"OVER (PARTITION BY {_SLOT})"
    return f"({name} - min({name}) {over}) / (max({name}) {over} - min({name}) {over} + {d(_W.epsilon)})"


# Building blocks: name -> (names it needs, SQL).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": (
        (),
        """
      SELECT event_id AS trip_id,
        CASE WHEN event_id % 5 IN (2, 3) THEN time_bucket(INTERVAL 6 HOUR, ts) ELSE ts END AS tpep_pickup_datetime,
        (CASE WHEN event_id % 5 < 2 THEN 1 WHEN event_id % 100 = 4 THEN 263 WHEN event_id % 100 = 9 THEN NULL
          WHEN user_id % 27 = 25 THEN 264 WHEN user_id % 27 = 26 THEN 265 ELSE user_id % 27 + 1 END)::BIGINT AS PULocationID,
        (CASE WHEN event_id % 5 < 2 THEN 0 WHEN event_id % 5 < 4 THEN event_id // 5 % 2 ELSE event_id * 7919 END)::BIGINT
          AS pick_key,
        value / 4e0 AS trip_distance, value AS fare_amount, (5 + event_id % 30)::DOUBLE AS average_speed_mph,
        (event_id % 31)::DOUBLE AS tip_percentage, 1 + event_id % 4 AS passenger_count
      FROM events""",
    ),
    "zones": (
        (),
        """
      SELECT n_nationkey + 1 AS LocationID, r_name AS Borough, n_name AS Zone
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "zone_edges": (
        (),
        """
      SELECT LocationID, 0 AS part, 0 AS ring_no, unnest([x0, x0 + w, x0 + w, x0]) AS x1,
        unnest([y0, y0, y0 + h, y0 + h]) AS y1, unnest([x0 + w, x0 + w, x0, x0]) AS x2,
        unnest([y0, y0 + h, y0 + h, y0]) AS y2
      FROM (
        SELECT n_nationkey + 1 AS LocationID, -74e0 + 0.02e0 * (n_nationkey % 5) AS x0,
          40.7e0 + 0.015e0 * (n_nationkey // 5) AS y0,
          CASE WHEN n_nationkey = 24 THEN 0.0005e0 ELSE 0.02e0 END AS w,
          CASE WHEN n_nationkey = 24 THEN 0.0005e0 ELSE 0.015e0 END AS h
        FROM nation) AS rect""",
    ),
    "shape": ((), f"SELECT * FROM (VALUES {_shape_rows()}) AS s(kind, part, ring_no, ux1, uy1, ux2, uy2)"),
    "shape_edges": (
        ("shape",),
        """
      SELECT s_suppkey::INTEGER AS LocationID, part, ring_no,
        cx + a * (ux1 + 0.13e0 * uy1) AS x1, cy + a * uy1 AS y1,
        cx + a * (ux2 + 0.13e0 * uy2) AS x2, cy + a * uy2 AS y2
      FROM (
        SELECT s_suppkey, s_suppkey % 4 AS k4, -74.05e0 + ((s_suppkey * 53) % 97) * 0.003e0 + 0.00037e0 AS cx,
          40.58e0 + ((s_suppkey * 37) % 89) * 0.0031e0 + 0.00053e0 AS cy,
          0.011e0 + (s_suppkey % 7) * 0.002e0 AS a
        FROM supplier) AS placed JOIN shape ON k4 = kind""",
    ),
    "zone_cells": (("zone_edges",), fill("zone_edges", GRID)),
    "zone_cells_fine": (("zone_edges",), fill("zone_edges", FINE)),
    "shape_cells": (("shape_edges",), fill("shape_edges", GRID)),
    "numbered_cells": (
        ("zone_cells",),
        """
      SELECT LocationID, cell, row_number() OVER (PARTITION BY LocationID ORDER BY cell) - 1 AS pos,
        count(*) OVER (PARTITION BY LocationID) AS n
      FROM zone_cells""",
    ),
    "trip_cells": (
        ("trips", "numbered_cells"),
        """
      SELECT t.* EXCLUDE (pick_key), c.cell AS pickup_h3
      FROM trips t LEFT JOIN numbered_cells c ON t.PULocationID = c.LocationID AND t.pick_key % c.n = c.pos
      WHERE t.PULocationID NOT IN (264, 265)""",
    ),
    "demand": (
        ("trip_cells",),
        f"""
      SELECT time_bucket(INTERVAL 5 MINUTE, tpep_pickup_datetime) AS window_start,
        window_start + INTERVAL 5 MINUTE AS window_end, PULocationID AS pickup_zone_id,
        {lat_of("pickup_h3")} AS pickup_lat, {lon_of("pickup_h3")} AS pickup_lon, pickup_h3,
        count(*) AS pickup_count, avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare,
        avg(average_speed_mph) AS avg_speed, avg(tip_percentage) AS avg_tip_pct,
        avg(passenger_count) AS avg_passengers, window_start::DATE AS window_start_date
      FROM trip_cells GROUP BY ALL""",
    ),
    "cell_windows": (
        ("demand",),
        "SELECT pickup_h3, window_start, sum(pickup_count)::BIGINT AS n FROM demand GROUP BY ALL",
    ),
    "weather": ((), weather_of("SELECT r_name AS borough, r_regionkey::BIGINT AS b FROM region")),
    "lagged": (
        ("demand",),
        f"""
      SELECT *, lead(pickup_count) {_LAG} AS target_pickup_count, lag(pickup_count, 1) {_LAG} AS prev_demand,
        lag(pickup_count, 12) {_LAG} AS lag_12, lag(pickup_count, 288) {_LAG} AS lag_288
      FROM demand WHERE pickup_h3 IS NOT NULL""",
    ),
    "features": (
        ("lagged", "zones", "weather"),
        """
      SELECT l.* EXCLUDE (avg_trip_distance, avg_fare, avg_speed, avg_tip_pct, avg_passengers,
          prev_demand, lag_12, lag_288),
        coalesce(avg_trip_distance, 0) AS avg_trip_distance, coalesce(avg_fare, 0) AS avg_fare,
        coalesce(avg_speed, 0) AS avg_speed, coalesce(avg_tip_pct, 0) AS avg_tip_pct,
        coalesce(avg_passengers, 0) AS avg_passengers, coalesce(prev_demand, 0) AS prev_demand,
        coalesce(lag_12, 0) AS lag_12, coalesce(lag_288, 0) AS lag_288,
        z.Borough AS borough, coalesce(temp_2m, 0) AS temp_2m, coalesce(rain, 0) AS rain, coalesce(snow, 0) AS snow,
        coalesce(wind, 0) AS wind, coalesce(is_raining, 0) AS is_raining, coalesce(is_snowing, 0) AS is_snowing,
        weather_type, temp_bucket, hour(window_start) AS window_start_hour, dayofweek(window_start) + 1 AS day_of_week
      FROM lagged l LEFT JOIN zones z ON l.pickup_zone_id = z.LocationID
        LEFT JOIN weather w ON w.borough = z.Borough AND w.time = date_trunc('hour', l.window_start)
      WHERE target_pickup_count IS NOT NULL""",
    ),
    "typical": (
        ("demand",),
        """
      SELECT pickup_h3, hour(window_start) AS hour_of_day, dayofweek(window_start) + 1 AS day_of_week,
        avg(pickup_count) AS typical_demand, quantile_disc(pickup_count, 0.75) AS demand_p75
      FROM demand WHERE pickup_h3 IS NOT NULL GROUP BY ALL""",
    ),
    "stations_csv": (
        (),
        """
      SELECT s_suppkey AS station_key, s_name AS station_name,
        (40.6e0 + ((s_suppkey % 80 * 37) % 100) * 0.005e0)::VARCHAR AS lat_text,
        (-74.1e0 + ((s_suppkey % 80 * 53) % 100) * 0.005e0)::VARCHAR AS lon_text,
        CASE WHEN s_suppkey % 5 <> 0 THEN (s_suppkey % 4)::VARCHAR END AS fast_text,
        CASE WHEN s_suppkey % 11 = 0 THEN '2.0' WHEN s_suppkey % 13 = 0 THEN '3.7' WHEN s_suppkey % 17 = 0 THEN ' 4 '
          WHEN s_suppkey % 19 = 0 THEN 'nan' WHEN s_suppkey % 6 <> 0 THEN (s_suppkey % 7)::VARCHAR END AS level2_text
      FROM supplier
      UNION ALL SELECT -1, 'broken row', 'n/a', '-73.9', '1', 'x'""",
    ),
    "stations": (
        ("stations_csv",),
        with_cell(
            f"""SELECT station_key AS charger_id, station_name, try_cast(lat_text AS DOUBLE) AS lat,
        try_cast(lon_text AS DOUBLE) AS lon, {whole("fast_text")} AS fast_chargers,
        {whole("level2_text")} AS level2_chargers
      FROM stations_csv
      WHERE try_cast(lat_text AS DOUBLE) BETWEEN {d(_BOX.lat_min)} AND {d(_BOX.lat_max)}
        AND try_cast(lon_text AS DOUBLE) BETWEEN {d(_BOX.lon_min)} AND {d(_BOX.lon_max)}""",
            out="charger_h3",
        ),
    ),
    "ranked_stations": (
        ("zone_cells", "stations"),
        f"""
      SELECT * FROM (
        SELECT c.LocationID, c.cell AS h3_cell, s.*, {dist("c.cell", "s.charger_h3")} AS charger_distance,
          row_number() OVER (PARTITION BY c.LocationID, c.cell
            ORDER BY {dist("c.cell", "s.charger_h3")}, s.charger_id) AS priority
        FROM zone_cells c CROSS JOIN stations s) AS ranked
      WHERE priority <= 3""",
    ),
    "nearest": (
        ("ranked_stations",),
        f"""
      SELECT LocationID, h3_cell, {station_pick(1)}, {station_pick(2)}, {station_pick(3)}
      FROM ranked_stations GROUP BY LocationID, h3_cell""",
    ),
    "cell_scores": (
        ("nearest",),
        f"""
      SELECT h3_cell, max({_plugs(1)} + {_plugs(2)} + {_plugs(3)}) AS charger_score
      FROM nearest GROUP BY h3_cell""",
    ),
    "pairs": (
        ("typical", "cell_scores"),
        f"""
      SELECT o.pickup_h3 AS origin_h3, o.hour_of_day, o.day_of_week, c.pickup_h3 AS candidate_h3,
        {dist("o.pickup_h3", "c.pickup_h3")} AS grid_distance, c.typical_demand AS candidate_demand,
        c.demand_p75 AS candidate_p75, coalesce(s.charger_score, 0) AS charger_score
      FROM typical o JOIN typical c ON o.hour_of_day = c.hour_of_day AND o.day_of_week = c.day_of_week
        AND o.pickup_h3 <> c.pickup_h3 AND {dist("o.pickup_h3", "c.pickup_h3")} <= {SETTINGS.ring}
      LEFT JOIN cell_scores s ON s.h3_cell = c.pickup_h3""",
    ),
    "scored": (
        ("pairs",),
        f"""
      SELECT *, {d(_W.demand)} * norm_demand - {d(_W.distance)} * norm_distance
          + {d(_W.charger)} * norm_charger AS final_score
      FROM (
        SELECT *, {_scaled("candidate_demand")} AS norm_demand, {_scaled("grid_distance")} AS norm_distance,
          {_scaled("charger_score")} AS norm_charger
        FROM pairs) AS scaled""",
    ),
    "recs": (
        ("scored",),
        f"""
      SELECT {_SLOT}, candidate_h3, grid_distance, candidate_demand, charger_score, final_score, "rank"
      FROM (
        SELECT *, row_number() OVER (PARTITION BY {_SLOT} ORDER BY final_score DESC, candidate_h3) AS "rank"
        FROM scored) AS ranked
      WHERE "rank" <= {SETTINGS.top}""",
    ),
    "drivers": (
        (),
        f"""
      SELECT *, hour(ts) AS hour, dayofweek(ts) + 1 AS day_of_week,
        (lat BETWEEN {d(_AREA.lat_min)} AND {d(_AREA.lat_max)}
          AND lon BETWEEN {d(_AREA.lon_min)} AND {d(_AREA.lon_max)}) AS in_area
      FROM ({with_cell(
            '''SELECT c_custkey AS driver_id, 40.38e0 + ((c_custkey * 41) % 100) * 0.006e0 AS lat,
        -74.02e0 + ((c_custkey * 59) % 100) * 0.0015e0 AS lon,
        TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey) AS ts FROM customer''',
            out="driver_h3",
        )}) AS located""",
    ),
    "station_points": (
        ("stations",),
        """
      SELECT station_name AS name, lat, lon, coalesce(fast_chargers, 0) AS fast, coalesce(level2_chargers, 0) AS level2,
        CASE WHEN coalesce(fast_chargers, 0) > 0 THEN 'fast' ELSE 'level2_only' END AS station_class
      FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY charger_id) AS nth FROM stations) AS s
      WHERE nth = 1""",
    ),
}


def query(select: str, *needs: str) -> str:
    """``select`` behind the blocks it needs, in order of need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in BLOCKS[name][0]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return select
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name][1]})" for name in order)
    return f"WITH {blocks}\n{select}"
