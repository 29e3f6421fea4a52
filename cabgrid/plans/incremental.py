"""Demand, its lags and its typical values kept up to date by date.

A ledger holds, per date, the number of trips and a sum of their hashes, which
no order of rows changes. Only dates whose entry differs are aggregated again and
overwritten; late, corrected and withdrawn trips all show. A table with the rows of each cell
and date tells which lags reach a changed date, and only those are counted again.
All other dates keep their files.

The ledger is written last. A run that dies leaves the old one, so the next
run finds the same dates changed and does them again; every step replaces whole dates,
so doing it twice is doing it once.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.config import Settings
from cabgrid.operators import demand as dm
from cabgrid.operators import typical
from cabgrid.operators.series import CELL, row_lags
from cabgrid.sinks import versions, writers

DATE = "window_start_date"
PICKUP = "tpep_pickup_datetime"


@dataclass(frozen=True)
class Layout:
    """Where the tables live, all partitioned by date but for the ledger."""

    base: str

    @property
    def demand(self) -> str:
        return f"{self.base}/demand"

    @property
    def lags(self) -> str:
        return f"{self.base}/demand_lags"

    @property
    def cell_days(self) -> str:
        return f"{self.base}/demand_cell_days"

    @property
    def typical(self) -> str:
        return f"{self.base}/typical_state"

    @property
    def ledger(self) -> str:
        return f"{self.base}/ledger"


@dataclass(frozen=True)
class Updated:
    """Dates whose trips changed, and dates whose lags were written again."""

    changed: tuple[datetime.date, ...]
    lagged: tuple[datetime.date, ...]


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _dates(rows: DataFrame) -> tuple[datetime.date, ...]:
    """Distinct dates, a number bounded by the calendar."""
    return tuple(sorted(r[0] for r in rows.select(DATE).distinct().collect()))


def _order_free_hash(columns: Iterable[str]) -> Column:
    """A sum of row hashes; NULLs count by where they stand."""
    names = sorted(columns)
    return F.sum(F.xxhash64(*names, *[F.col(f"`{n}`").isNull() for n in names]).cast("decimal(38,0)"))


def with_date(trips: DataFrame, settings: Settings) -> DataFrame:
    """Trips with the date of the window that they are counted in."""
    return trips.withColumn(DATE, F.to_date(F.window(PICKUP, settings.window).start))


def ledger(trips: DataFrame, zone_positions: DataFrame, settings: Settings) -> DataFrame:
    """Per date: trips of known zones, their hash, and a hash of the zones' cells, which all dates depend on."""
    cells = zone_positions.agg(_order_free_hash(zone_positions.columns)).first()[0]
    known = dm.known_zone_trips(trips, settings.unknown_zones).filter(F.col(PICKUP).isNotNull())
    return (
        with_date(known, settings)
        .groupBy(DATE)
        .agg(F.count(F.lit(1)).alias("trips"), _order_free_hash(trips.columns).alias("trips_hash"))
        .withColumn("cells_hash", F.lit(cells).cast("decimal(38,0)"))
    )


def changed_dates(before: DataFrame, now: DataFrame) -> DataFrame:
    """Dates that came, went, or have other trips or cells."""
    entry = F.struct("trips", "trips_hash", "cells_hash")
    old, new = before.select(DATE, entry.alias("old")), now.select(DATE, entry.alias("new"))
    return old.join(new, DATE, "full").filter(~F.col("old").eqNullSafe(F.col("new"))).select(DATE)


def lag_plan(cell_days: DataFrame, changed: DataFrame, lookback: int) -> DataFrame:
    """Which dates of a cell need new lags, and which rows they are counted over.

    ``cell_days`` has the number of rows ``n`` per cell and date, ``changed`` the pairs of
    cell and date that were built again, also those without rows now. A row's
    lags reach a changed date if it is among the ``lookback`` rows after it, and
    its target does if it is the last row before. What those rows look at
    are the ``lookback`` rows before them and the one after.
    """
    pairs = cell_days.join(changed.select(CELL).distinct(), CELL, "left_semi").select(CELL, DATE, "n")
    marked = changed.select(CELL, DATE, F.lit(True).alias("changed"))
    days = pairs.join(marked, [CELL, DATE], "full").fillna({"n": 0, "changed": False})
    by_date = Window.partitionBy(CELL).orderBy(DATE)
    before = by_date.rowsBetween(Window.unboundedPreceding, -1)
    after = by_date.rowsBetween(1, Window.unboundedFollowing)
    days = days.withColumn("first_row", F.coalesce(F.sum("n").over(before), F.lit(0)))
    days = days.withColumn("end_row", F.col("first_row") + F.col("n"))
    last_change = F.max(F.when(F.col("changed"), F.col("end_row"))).over(before)
    near = F.col("first_row") < last_change + F.lit(lookback)
    days = days.withColumn(
        "affected", F.col("changed") | F.coalesce(near, F.lit(False)) | F.coalesce(F.lead("changed").over(by_date), F.lit(False))
    )
    # Dates without rows have told what they change; no row looks at them.
    held = days.filter("n > 0")
    next_affected = F.min(F.when(F.col("affected"), F.col("first_row"))).over(after)
    looked_at = F.col("end_row") > next_affected - F.lit(lookback)
    held = held.withColumn(
        "needed", F.col("affected") | F.coalesce(looked_at, F.lit(False)) | F.coalesce(F.lag("affected").over(by_date), F.lit(False))
    )
    gone = days.filter("n = 0").withColumn("needed", F.lit(False))
    return held.unionByName(gone).filter("needed OR affected").select(CELL, DATE, "affected", "needed")


class DemandTables:
    """The tables of one layout and how to bring them up to date."""

    def __init__(self, spark: SparkSession, layout: Layout, settings: Settings) -> None:
        self.spark, self.layout, self.settings = spark, layout, settings

    def read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def typical_demand(self) -> DataFrame:
        """Typical pickups from the states of all dates; no trip and no window is read."""
        return typical.merged_typical(self.read(self.layout.typical))

    def update(self, trips: DataFrame, zone_positions: DataFrame, key: Column | None = None) -> Updated:
        """Take over the trips as they are now."""
        spark, layout = self.spark, self.layout
        now = self._staged(ledger(trips, zone_positions, self.settings), "ledger")
        known = versions.latest(spark, layout.ledger)
        before = spark.read.parquet(known) if known else now.limit(0)
        changed = _dates(changed_dates(before, now))
        if not changed:
            return Updated((), ())
        old_pairs = self._pairs(layout.cell_days, changed)
        known_trips = with_date(dm.known_zone_trips(trips, self.settings.unknown_zones), self.settings)
        some = self._between(known_trips, changed).drop(DATE)
        key = F.xxhash64(*trips.columns) if key is None else key
        rebuilt = dm.demand_windows(dm.assign_cells(some, zone_positions, key), self.settings)
        demand = self._replace(rebuilt, layout.demand, changed).filter(F.col(DATE).isin(*changed))
        counts = demand.filter(F.col(CELL).isNotNull()).groupBy(DATE, CELL).agg(F.count(F.lit(1)).alias("n"))
        cell_days = self._replace(counts, layout.cell_days, changed)
        self._replace(typical.typical_state(demand, "pickup_count"), layout.typical, changed)
        new_pairs = cell_days.filter(F.col(DATE).isin(*changed)).select(CELL, DATE)
        lagged = self._update_lags(cell_days, old_pairs.unionByName(new_pairs).distinct(), changed)
        versions.write(now, layout.ledger)
        versions.drop_old(spark, layout.ledger)
        return Updated(changed, lagged)

    def _update_lags(
        self, cell_days: DataFrame, pairs: DataFrame, changed: tuple[datetime.date, ...]
    ) -> tuple[datetime.date, ...]:
        lags = self.settings.row_lags
        plan = self._staged(lag_plan(cell_days, pairs, max(lags, default=0)), "lag-plan")
        affected = plan.filter("affected").select(CELL, DATE)
        touched = tuple(sorted({*changed, *_dates(affected)}))
        needed = plan.filter("needed").select(CELL, DATE)
        rows = self._dated(self.layout.demand, _dates(needed)).join(needed, [CELL, DATE], "left_semi")
        fresh = row_lags(rows, lags).join(affected, [CELL, DATE], "left_semi")
        if _exists(self.spark, self.layout.lags):
            kept = self.spark.read.schema(fresh.schema).parquet(self.layout.lags).filter(F.col(DATE).isin(*touched))
            fresh = fresh.unionByName(kept.join(affected, [CELL, DATE], "left_anti"))
        self._replace(self._staged(fresh, "lags"), self.layout.lags, touched)
        return touched

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        path = session.scratch_path(self.spark, name)
        writers.overwrite(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _between(self, rows: DataFrame, dates: tuple[datetime.date, ...]) -> DataFrame:
        """Trips of the given dates; the first and the last of them reach the scan as bounds of the pickup time."""
        slack = datetime.timedelta(days=1)
        low, high = min(dates) - slack, max(dates) + 2 * slack
        return rows.filter(F.col(PICKUP).between(F.lit(low), F.lit(high)) & F.col(DATE).isin(*dates))

    def _dated(self, path: str, dates: tuple[datetime.date, ...]) -> DataFrame:
        return self.read(path).filter(F.col(DATE).isin(*dates))

    def _pairs(self, path: str, dates: tuple[datetime.date, ...]) -> DataFrame:
        """Cells with rows on the dates, as a table of its own: what it is read from is about to change."""
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], f"{CELL} long, {DATE} date")
        return self._staged(self._dated(path, dates).select(CELL, DATE), "cell-days")

    def _replace(self, rows: DataFrame, path: str, dates: tuple[datetime.date, ...]) -> DataFrame:
        """Overwrite the folders of the dates that ``rows`` has, and remove those of the others among ``dates``."""
        seen = Observation()
        written = rows.observe(seen, F.collect_set(DATE).alias("dates"))
        writers.overwrite_partitioned(written, path, [DATE], dynamic=True)
        table = self.spark.read.schema(rows.schema).parquet(path)
        for date in sorted(set(_dates(table.filter(F.col(DATE).isin(*dates)))) - set(seen.get["dates"])):
            target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATE}={date}")
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        return self.spark.read.schema(rows.schema).parquet(path)
