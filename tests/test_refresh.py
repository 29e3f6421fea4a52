"""The whole refresh, its tables and their export."""

from dataclasses import replace

import pytest

from cabgrid import session
from cabgrid.ml import model as ml
from cabgrid.plans import refresh as plan
from cabgrid.sinks import writers
from cabgrid.sources import tables as src
from checks import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    session.prepare(spark)
    # Lags other than the default ones, and tables registered by name.
    settings = replace(fx.SETTINGS, row_lags=(1, 6), model=replace(fx.SETTINGS.model, trees=3, depth=2))
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    inputs = plan.Inputs(
        trips=fx.trips(spark, SF_SMALL),
        zone_rings=fx.zone_rings(spark, SF_SMALL),
        zones=fx.zones(spark, SF_SMALL),
        weather_landed=fx.region_weather(spark, SF_SMALL),
        stations_raw=fx.stations_csv(spark, SF_SMALL),
        places=fx.zones(spark, SF_SMALL).selectExpr("Borough AS borough").distinct(),
    )
    base = str(tmp_path_factory.mktemp("lake"))
    tables = plan.refresh(
        spark, inputs, plan.Layout(base), settings, fx.trip_key(), fx.station_key(), schema="lake", fit_partitions=4
    )
    yield base, tables
    spark.sql("DROP DATABASE lake CASCADE")


def test_tables_are_read_by_name(spark, built):
    _, tables = built
    for name, df in tables.items():
        assert spark.table(f"lake.{name}").count() == df.count(), name


def test_metrics_and_importances_are_kept(built):
    _, tables = built
    metrics = tables["model_metrics"].first()
    _, unseen = ml.split_by_time(tables["demand_features"], fx.SETTINGS.model.cutoff)
    assert metrics.row_count == unseen.count() > 0 and metrics.rmse > 0
    names = {r.feature for r in tables["feature_importance"].collect()}
    assert {"prev_demand", "lag_6"} <= names and "lag_12" not in names


def test_all_tables_are_written(spark, built):
    base, tables = built
    assert set(tables) == {
        "weather",
        "h3_mappings_resolution_8",
        "h3_mappings_resolution_9",
        "taxi_zones",
        "ny_chargers",
        "demand_h3_res8_5min",
        "demand_features",
        "demand_predictions",
        "typical_demand_lookup",
        "nearest_chargers",
        "recommendations",
        "model_metrics",
        "feature_importance",
        "trip_rejects",
        "station_rejects",
        "missing_weather_places",
        "repeated_weather_hours",
        "repeated_zones",
        "zones_without_cells",
    }
    nothing_found = {"missing_weather_places", "repeated_zones", "zones_without_cells"}
    for name, df in tables.items():
        assert (df.count() > 0) == (name not in nothing_found), name
        assert spark.read.parquet(f"{base}/{name}").count() == df.count()


def test_grain_of_the_tables(built):
    _, tables = built
    keys = {
        "weather": ["borough", "time"],
        "h3_mappings_resolution_8": ["LocationID"],
        "demand_h3_res8_5min": ["window_start", "pickup_zone_id", "pickup_h3"],
        "typical_demand_lookup": ["pickup_h3", "hour_of_day", "day_of_week"],
        "nearest_chargers": ["LocationID", "h3_cell"],
        "recommendations": ["origin_h3", "hour_of_day", "day_of_week", "rank"],
    }
    for name, key in keys.items():
        assert tables[name].groupBy(*key).count().filter("count > 1").count() == 0, name
    ranks = tables["recommendations"].groupBy("origin_h3", "hour_of_day", "day_of_week").agg({"rank": "max", "*": "count"})
    assert ranks.filter("`max(rank)` > 5 OR `max(rank)` <> `count(1)`").count() == 0


def test_export_and_read_back(spark, built, tmp_path):
    _, tables = built
    paths = plan.export_gold(tables, str(tmp_path))
    assert set(paths) == {"recommendations", "typical_demand_lookup", "ny_chargers", "nearest_chargers"}
    for name in ("recommendations", "typical_demand_lookup"):
        slots = src.read_slots(spark, paths[name])
        assert dict(slots.dtypes)["hour_of_day"] == "int" and dict(slots.dtypes)["day_of_week"] == "int"
        assert slots.count() == tables[name].count()


def test_registering_again_points_to_the_new_files(spark, built, tmp_path):
    _, tables = built
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    writers.overwrite(tables["ny_chargers"], one)
    writers.write_slots(tables["typical_demand_lookup"], two)
    assert writers.register(spark, "refresh_table", one).count() == tables["ny_chargers"].count()
    assert writers.register(spark, "refresh_table", two).count() == tables["typical_demand_lookup"].count()
    assert spark.read.parquet(one).count() == tables["ny_chargers"].count()
    spark.sql("DROP TABLE refresh_table")


def test_a_managed_table_is_never_replaced(spark, built, tmp_path):
    _, tables = built
    path = str(tmp_path / "it's here")
    writers.overwrite(tables["ny_chargers"], path)
    spark.range(5).write.saveAsTable("refresh_managed")
    with pytest.raises(ValueError):
        writers.register(spark, "refresh_managed", path)
    assert spark.table("refresh_managed").count() == 5
    spark.sql("DROP TABLE refresh_managed")
    assert writers.register(spark, "refresh_managed", path).count() == tables["ny_chargers"].count()
    spark.sql("DROP TABLE refresh_managed")


def test_scratch_folders_can_be_dropped(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/tmp")


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_dir(spark)
    assert folder == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_versions_are_published_together(spark, tmp_path_factory):
    """With versions, names move once all tables are complete, and the first README example's inputs are enough."""
    session.prepare(spark)
    settings = replace(fx.SETTINGS, row_lags=(1,), model=replace(fx.SETTINGS.model, trees=1, depth=2))
    spark.sql("CREATE DATABASE IF NOT EXISTS versioned_lake")
    sources = (fx.trips, fx.zone_rings, fx.zones, fx.region_weather, fx.stations_csv)
    inputs = plan.Inputs(*[read(spark, SF_SMALL) for read in sources])
    base = plan.Layout(str(tmp_path_factory.mktemp("versions")))
    keys = (fx.trip_key(), fx.station_key())
    with pytest.raises(ValueError):
        plan.refresh(spark, inputs, base, settings, *keys, keep_versions=2)
    first = plan.refresh(spark, inputs, base, settings, *keys, schema="versioned_lake", fit_partitions=2, keep_versions=2)
    opened = spark.table("versioned_lake.recommendations")
    count = opened.count()
    fewer = replace(inputs, trips=inputs.trips.filter("trip_id % 2 = 0"))
    with pytest.raises(Exception, match="lost"):
        lost = replace(fewer, stations_raw=inputs.stations_raw.limit(0).selectExpr("raise_error('lost') AS x"))
        plan.refresh(spark, lost, base, settings, *keys, schema="versioned_lake", fit_partitions=2, keep_versions=2)
    for name, df in first.items():
        assert spark.table(f"versioned_lake.{name}").count() == df.count(), name
    plan.refresh(spark, fewer, base, settings, *keys, schema="versioned_lake", fit_partitions=2, keep_versions=2)
    assert opened.count() == count
    assert spark.table("versioned_lake.demand_h3_res8_5min").count() < first["demand_h3_res8_5min"].count()
    spark.sql("DROP DATABASE versioned_lake CASCADE")
