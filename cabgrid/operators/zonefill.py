"""Which grid cells belong to a zone: polygon fill by scan lines.

All cells of a grid row share one latitude. Each polygon edge is cut with the
rows it spans, the cuts of a row are paired from west to east, and the cells
between a pair are inside. Work grows with cuts plus cells found; points are
never paired with edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.functions.hexgrid import HexGrid, cell_q, double, pack


def ring_edges(rings: DataFrame) -> DataFrame:
    """Edges ``(x1, y1) - (x2, y2)`` of rings, closing each ring."""
    following = F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1))
    edges = F.zip_with(
        "ring",
        following,
        lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")),
    )
    return rings.select("LocationID", "part", "ring_no", F.inline(edges))


def _row_cuts(edges: DataFrame, grid: HexGrid) -> DataFrame:
    """Where edges cross the centre lines of grid rows: ``(LocationID, part, r, x)``."""
    scale, lat0 = double(grid.metres_per_lat / grid.row_height_m), double(grid.lat0)
    # One row of slack on both sides; the exact test follows.
    rows = f"""explode(sequence(floor((least(y1, y2) - {lat0}) * {scale}) - 1,
                                ceil((greatest(y1, y2) - {lat0}) * {scale}) + 1)) AS r"""
    return (
        edges.filter("y1 <> y2")
        .selectExpr("LocationID", "part", "x1", "y1", "x2", "y2", rows)
        .withColumn("y", F.expr(grid.row_lat_sql("r")))
        .filter("(y1 > y) <> (y2 > y)")
        .selectExpr("LocationID", "part", "r", "x1 + (y - y1) * (x2 - x1) / (y2 - y1) AS x")
    )


def _inside_cells(cuts: DataFrame, grid: HexGrid) -> DataFrame:
    """Cells between the first and second cut of a row, the third and fourth, and so on."""
    row = Window.partitionBy("LocationID", "part", "r").orderBy("x")
    per_metre = grid.metres_per_lon / grid.column_width_m

    def column_at(x: str) -> str:
        return f"floor(({x} - {double(grid.lon0)}) * {double(per_metre)} - r * 0.5D)"

    spans = cuts.withColumns({"nth": F.row_number().over(row), "x_end": F.lead("x").over(row)}).filter("nth % 2 = 1")
    return (
        spans.selectExpr(
            "LocationID",
            "r",
            "x AS x_start",
            "x_end",
            f"explode(sequence({column_at('x')} - 1, {column_at('x_end')} + 2)) AS q",
        )
        .withColumn("lon", F.expr(grid.column_lon_sql("q", "r")))
        .filter("lon >= x_start AND lon < x_end")
        .select("LocationID", pack("q", "r").alias("cell"))
    )


def centroids(edges: DataFrame, grid: HexGrid) -> DataFrame:
    """Area centroid per zone over all its parts, holes counted out."""
    lon0, lat0 = double(grid.lon0), double(grid.lat0)
    local = edges.selectExpr(
        "LocationID",
        "part",
        "ring_no",
        f"x1 - {lon0} AS x1",
        f"x2 - {lon0} AS x2",
        f"y1 - {lat0} AS y1",
        f"y2 - {lat0} AS y2",
    ).withColumn("cross", F.expr("x1 * y2 - x2 * y1"))
    by_ring = local.groupBy("LocationID", "part", "ring_no").agg(
        F.expr("sum(cross) AS area2"),
        F.expr("sum((x1 + x2) * cross) AS mx"),
        F.expr("sum((y1 + y2) * cross) AS my"),
        F.expr("sum(x1) AS sx"),
        F.expr("sum(y1) AS sy"),
        F.expr("count(1) AS n"),
    )
    # Drawing direction must not matter: outlines add, holes subtract.
    signed = by_ring.withColumn("sign", F.expr("signum(area2) * IF(ring_no = 0, 1D, -1D)"))
    by_zone = signed.groupBy("LocationID").agg(
        *[F.expr(f"sum({c} * sign) AS {c}") for c in ("area2", "mx", "my")],
        *[F.expr(f"sum({c}) AS {c}") for c in ("sx", "sy", "n")],
    )
    return by_zone.selectExpr(
        "LocationID",
        f"{lon0} + IF(area2 = 0, sx / n, mx / (3 * area2)) AS lon",
        f"{lat0} + IF(area2 = 0, sy / n, my / (3 * area2)) AS lat",
    )


def zone_positions(rings: DataFrame, grid: HexGrid) -> DataFrame:
    """A row per zone and cell: ``(LocationID, position, h3_cell, n_cells)``, numbered from 0 in the order of cell ids.

    Cells whose centre lies in the zone; parts of a zone are merged, and a zone
    that holds no centre gets the cell of its centroid. A cell's number is what
    its zone has in the grid columns before, plus its place in its own column, so
    no row or group holds more than a column of cells or the columns of a zone.
    """
    edges = ring_edges(rings)
    inside = _inside_cells(_row_cuts(edges, grid), grid)
    spare = centroids(edges, grid).select("LocationID", grid.cell_of("lat", "lon").alias("cell"), F.lit(1).alias("spare"))
    both = inside.withColumn("spare", F.lit(0)).unionByName(spare).filter("cell IS NOT NULL").distinct()
    cells = both.withColumn("q", cell_q("cell"))
    before = Window.partitionBy("LocationID").orderBy("q").rowsBetween(Window.unboundedPreceding, -1)
    zone = Window.partitionBy("LocationID")
    columns = (
        cells.groupBy("LocationID", "q")
        .agg(F.count_if(F.col("spare") == 0).alias("n"))
        .select(
            "LocationID",
            "q",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
            F.sum("n").over(zone).alias("total"),
        )
    )
    place = F.row_number().over(Window.partitionBy("LocationID", "q").orderBy("spare", "cell"))
    return (
        cells.join(columns, ["LocationID", "q"])
        .withColumn("place", place)
        .filter("spare = 0 OR total = 0")
        .select(
            "LocationID",
            (F.col("before") + F.col("place") - 1).cast("int").alias("position"),
            F.col("cell").alias("h3_cell"),
            F.greatest("total", F.lit(1)).cast("int").alias("n_cells"),
        )
    )


def cell_lists(positions: DataFrame) -> DataFrame:
    """``(LocationID, h3_cells)`` with ascending cells, for those who want a zone's cells as one list."""
    return positions.groupBy("LocationID").agg(F.array_sort(F.collect_list("h3_cell")).alias("h3_cells"))


def positions_of(lists: DataFrame) -> DataFrame:
    """Numbered rows as of ``zone_positions`` from lists of cells; several lists of one zone are one."""
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_list("h3_cells"))))
    zones = lists.groupBy("LocationID").agg(merged.alias("h3_cells"))
    return zones.select("LocationID", F.posexplode("h3_cells").alias("position", "h3_cell"), F.size("h3_cells").alias("n_cells"))


def zone_cells(rings: DataFrame, grid: HexGrid) -> DataFrame:
    """``(LocationID, h3_cells)``: cells whose centre lies in the zone, ascending."""
    return cell_lists(zone_positions(rings, grid))


def zone_cell_rows(cells: DataFrame) -> DataFrame:
    """One row per zone and cell."""
    return cells.select("LocationID", F.explode("h3_cells").alias("h3_cell"))
