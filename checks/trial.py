"""Skewed trial on enlarged tables: ``python -m checks.trial [sf_dir] [times] [cores]``; prints one JSON line.

Trips are copied ``times`` times, each copy a day later than the one before, and
a third of all goes to one zone. Stations and cells are copied as well, a third
of the stations into one cell. Every step is written, and read by the next.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from cabgrid.functions.hexgrid import neighbours
from cabgrid.operators import demand as dm
from cabgrid.operators import recommend, series, stations, typical
from cabgrid.session import local_session, scratch_path
from checks import fixtures as fx
from checks import registry as reg


def main(sf: str, times: int, cores: str) -> None:
    spark = local_session("trial", cores, 64)
    took: dict[str, dict[str, float]] = {}

    def kept(name: str, df):
        start = time.perf_counter()
        path = scratch_path(spark, f"trial-{name}")
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        seconds = round(time.perf_counter() - start, 1)
        took[name] = {"seconds": seconds, "rows": out.count()}
        return out

    trips = fx.trips(spark, sf)
    copies = trips.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    later = F.timestamp_seconds(F.unix_timestamp("tpep_pickup_datetime") + F.col("copy") * 86400)
    hot = F.pmod(F.xxhash64("trip_id", "copy"), F.lit(3)) == 0
    trips = kept(
        "trips",
        copies.withColumns(
            {
                "tpep_pickup_datetime": later,
                "PULocationID": F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("PULocationID")),
                "trip_id": F.col("trip_id") * times + F.col("copy"),
            }
        ).select(*trips.columns),
    )
    cells = reg.zone_cells(spark, sf)
    demand = kept("demand_windows", dm.demand_from_trips(trips, cells, fx.SETTINGS))
    kept("row_lags", series.row_lags(demand, fx.SETTINGS.row_lags))
    kept("calendar_lags", series.calendar_lags(demand))
    kept("dense_series", series.densify(demand))
    slots = kept("typical_demand", typical.typical_demand(demand, "pickup_count"))
    scores = reg.cell_scores(spark, sf)
    kept("recommendations", recommend.recommendations(slots, scores, fx.SETTINGS))

    wide = reg.cell_rows(spark, sf).select(F.explode(neighbours("h3_cell", 12)).alias("h3_cell")).distinct()
    clean = reg.clean(spark, sf)
    many = clean.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    one = clean.agg(F.min("charger_h3")).first()[0]
    many = many.withColumns(
        {
            "charger_id": F.col("charger_id") * times + F.col("copy"),
            "charger_h3": F.when(F.pmod(F.xxhash64("charger_id", "copy"), F.lit(3)) == 0, F.lit(one)).otherwise(F.col("charger_h3")),
        }
    ).drop("copy")
    kept("nearest_stations", stations.nearest_stations(kept("cells", wide), kept("stations", many)))
    print(json.dumps({"sf": sf, "times": times, "cores": cores, "steps": took}))


if __name__ == "__main__":
    main(
        sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1",
        int(sys.argv[2]) if len(sys.argv) > 2 else 100,
        sys.argv[3] if len(sys.argv) > 3 else "8",
    )
