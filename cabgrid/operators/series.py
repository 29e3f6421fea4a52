"""Lags and leads over the demand series of each cell.

A cell's series is cut into blocks of bounded length, and each block gets a
copy of the few rows before and after it that its lags and leads reach. One
busy cell is then many tasks, and the result is exactly that of one window over
the whole cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = "pickup_h3"
START = "window_start"
ZONE = "pickup_zone_id"
ROWS_PER_BLOCK = 50_000


def _day() -> Column:
    return F.to_date(START)


def block_plan(demand: DataFrame, lookback: int, rows_per_block: int) -> DataFrame:
    """Per cell and day: the block its rows belong to, and all blocks that read them.

    Only row counts per cell and day are needed, so the running sum below sees
    one row per calendar day of a cell. A day starting at row ``s`` of its
    cell's series belongs to block ``s // rows_per_block``. A day ending before
    row ``e`` is looked back at by rows ``e .. e + lookback - 1``, and looked
    forward at by the day before it. With ``lookback <= rows_per_block`` those
    rows lie in at most two blocks.
    """
    if lookback > rows_per_block:
        raise ValueError("rows_per_block must be at least the longest lag")
    by_day = Window.partitionBy(CELL).orderBy("day")
    before = F.coalesce(F.sum("n").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = F.lit(rows_per_block)

    def block(row: Column) -> Column:
        return F.floor(row / size)

    return (
        demand.groupBy(CELL, _day().alias("day"))
        .agg(F.count("*").alias("n"))
        .withColumn("first_row", before)
        .withColumn("end_row", F.col("first_row") + F.col("n"))
        .withColumn("block", block(F.col("first_row")))
        .withColumn("block_before", F.lag("block").over(by_day))
        .select(
            CELL,
            "day",
            "block",
            F.array_distinct(
                F.array_compact(
                    F.array(
                        F.col("block"),
                        block(F.col("end_row")),
                        block(F.col("end_row") + F.lit(max(lookback, 1) - 1)),
                        F.col("block_before"),
                    )
                )
            ).alias("readers"),
        )
    )


def row_lags(
    demand: DataFrame,
    lags: Sequence[int] = (1, 12, 288),
    rows_per_block: int = ROWS_PER_BLOCK,
    value: str = "pickup_count",
) -> DataFrame:
    """Next value and earlier values of each cell's series, counted in rows.

    Adds ``target_pickup_count`` (next observed window) and one column per lag:
    ``prev_demand`` for lag 1, else ``lag_<n>``. Rows are ordered by window and
    zone. A row has lags only over rows that have a next row themselves, which
    holds for all rows before it. Rows without a cell have no series and are
    left out.
    """
    series = demand.filter(F.col(CELL).isNotNull())
    plan = block_plan(series, max(lags, default=0), rows_per_block)
    copied = (
        series.withColumn("day", _day())
        .join(plan, [CELL, "day"])
        .withColumn("reader", F.explode("readers"))
        .drop("readers", "day")
    )
    order = Window.partitionBy(CELL, "reader").orderBy(START, ZONE)
    columns = {"target_pickup_count": F.lead(value, 1).over(order)}
    for n in lags:
        columns[lag_name(n)] = F.lag(value, n).over(order)
    return copied.withColumns(columns).filter("reader = block").drop("reader", "block")


def lag_name(n: int) -> str:
    return "prev_demand" if n == 1 else f"lag_{n}"


def calendar_lags(
    demand: DataFrame,
    seconds: Sequence[int] = (300, 3600, 86400),
    value: str = "pickup_count",
) -> DataFrame:
    """A cell's total demand exactly so many seconds earlier, NULL where nothing was observed.

    Rows are copied to the days on which they are looked back at, so each task
    holds a cell's day and its halo.
    """
    copied = (
        demand.filter(F.col(CELL).isNotNull())
        .withColumn("at", F.col(START).cast("timestamp").cast("bigint"))
        .withColumn("day", F.floor(F.col("at") / F.lit(86400)))
        .withColumn(
            "reader",
            F.explode(
                F.array_distinct(
                    F.array(F.col("day"), *[F.floor((F.col("at") + F.lit(s)) / F.lit(86400)) for s in seconds])
                )
            ),
        )
    )
    order = Window.partitionBy(CELL, "reader").orderBy("at")
    columns = {f"demand_{s}s_ago": F.sum(value).over(order.rangeBetween(-s, -s)) for s in seconds}
    return copied.withColumns(columns).filter("reader = day").drop("reader", "day", "at")


def densify(
    demand: DataFrame, window_seconds: int = 300, value: str = "pickup_count", tasks: int | None = None
) -> DataFrame:
    """Every window between a cell's first and last one, with 0 where nothing was observed.

    The spine is built per cell and day, so no row or group ever holds more
    than the windows of one day. ``tasks`` says over how many tasks the days
    grow (the number of shuffle partitions if not given).
    """
    tasks = tasks or int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    series = demand.filter(F.col(CELL).isNotNull())
    at = F.col(START).cast("timestamp").cast("bigint")
    totals = series.groupBy(CELL, at.alias("at")).agg(F.sum(value).alias(value))
    span = series.groupBy(CELL).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    step = F.lit(window_seconds)
    day_steps = 86400 // window_seconds
    spine = (
        span.withColumn("windows", F.floor((F.col("last_at") - F.col("first_at")) / step))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor(F.col("windows") / F.lit(day_steps)))))
        # Few cells make many windows; a stated number of partitions isn't merged again.
        .repartition(tasks, CELL, "chunk")
        .withColumn(
            "i",
            F.explode(
                F.sequence(
                    F.col("chunk") * day_steps,
                    F.least(F.col("windows"), F.col("chunk") * day_steps + (day_steps - 1)),
                )
            ),
        )
        .select(CELL, (F.col("first_at") + F.col("i") * step).alias("at"))
    )
    return spine.join(totals, [CELL, "at"], "left").select(
        F.timestamp_seconds("at").alias(START), CELL, F.coalesce(value, F.lit(0)).alias(value)
    )


def dense_lags(
    demand: DataFrame,
    lags: Sequence[int] = (1, 12, 288),
    window_seconds: int = 300,
    value: str = "pickup_count",
) -> DataFrame:
    """Lags and target as over the dense series, without making its empty windows.

    A lag of ``n`` rows of the dense series is the cell's demand exactly ``n``
    windows earlier: 0 where nothing was observed, NULL before the cell's first
    window; the target is NULL after its last one. So it takes the observed rows,
    copied to the days that look at them, and each cell's first and last window.
    """
    at, day = F.col("at"), F.lit(86400)
    series = demand.filter(F.col(CELL).isNotNull()).withColumn("at", F.col(START).cast("timestamp").cast("bigint"))
    span = series.groupBy(CELL).agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    reach = [0, -window_seconds, *(n * window_seconds for n in lags)]
    readers = F.array_distinct(F.array(*[F.floor((at + F.lit(s)) / day) for s in reach]))
    copied = series.withColumns({"day": F.floor(at / day), "reader": F.explode(readers)})
    order = Window.partitionBy(CELL, "reader").orderBy("at")

    def total(seconds: int) -> Column:
        return F.coalesce(F.sum(value).over(order.rangeBetween(seconds, seconds)), F.lit(0))

    found = copied.withColumns(
        {"target_pickup_count": total(window_seconds), **{lag_name(n): total(-n * window_seconds) for n in lags}}
    )
    inside = {"target_pickup_count": F.when(at + F.lit(window_seconds) <= F.col("last_at"), F.col("target_pickup_count"))}
    for n in lags:
        inside[lag_name(n)] = F.when(at - F.lit(n * window_seconds) >= F.col("first_at"), F.col(lag_name(n)))
    return (
        found.filter("reader = day")
        .join(span, CELL)
        .withColumns(inside)
        .select(*demand.columns, "target_pickup_count", *map(lag_name, lags))
    )
