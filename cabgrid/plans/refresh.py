"""The whole refresh: every table in order, each written once and read by the next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from cabgrid.config import Settings
from cabgrid.ml import model as ml
from cabgrid.operators import demand as dm
from cabgrid.operators import features, quality, recommend, stations, typical, weather, zonefill
from cabgrid.sinks import versions, writers


@dataclass(frozen=True)
class Inputs:
    """Source tables as read by ``cabgrid.sources``."""

    trips: DataFrame
    zone_rings: DataFrame
    zones: DataFrame
    weather_landed: DataFrame
    stations_raw: DataFrame
    #: Places for which weather is expected, checked against what landed; all boroughs of ``zones`` if not given.
    places: DataFrame | None = None
    #: Rows of the station file that have another number of fields (``tables.read_stations_rows``).
    stations_broken: DataFrame | None = None


@dataclass(frozen=True)
class Layout:
    """Where tables live, all under one base folder."""

    base: str

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    writers.overwrite(df, path)
    return spark.read.schema(df.schema).parquet(path)


def refresh(
    spark: SparkSession,
    inputs: Inputs,
    layout: Layout,
    settings: Settings,
    trip_key: Column | None = None,
    station_key: Column | None = None,
    typical_from_test_rows: bool = False,
    schema: str | None = None,
    fit_partitions: int | None = None,
    keep_versions: int | None = None,
) -> dict[str, DataFrame]:
    """Build and write all tables; returns them by name.

    Typical demand averages the predictions of all rows, or only of the rows
    the model was not trained on. With ``schema`` every table is registered
    under its name there. With ``keep_versions`` each table is written to a new
    version's folder, and all names move to the new versions once every table
    is complete; so many versions stay. Beside the tables of the analysis there are the
    metrics of the held-out rows, the importances of the model's inputs, and
    what the checks of the inputs found.
    """
    if keep_versions is not None and schema is None:
        raise ValueError("versions are published by name, so a schema is needed")
    grid = settings.grid
    tables: dict[str, DataFrame] = {}
    folders: dict[str, str] = {}

    def folder(name: str) -> str:
        path = layout.path(name)
        folders[name] = path if keep_versions is None else versions.new_version(path)
        return folders[name]

    def keep(name: str, df: DataFrame) -> DataFrame:
        tables[name] = _written(spark, df, folder(name))
        return tables[name]

    places = inputs.places
    if places is None:
        places = inputs.zones.selectExpr("Borough AS borough").distinct()
    keep("missing_weather_places", weather.missing_places(places, inputs.weather_landed))
    keep("repeated_weather_hours", weather.repeated_hours(inputs.weather_landed))
    hours = keep("weather", weather.hourly_weather(inputs.weather_landed))
    positions = zonefill.zone_positions(inputs.zone_rings, grid)
    positions = _written(spark, positions, folder("zone_cell_positions"))
    cells = keep("h3_mappings_resolution_8", zonefill.cell_lists(positions))
    keep("h3_mappings_resolution_9", zonefill.zone_cells(inputs.zone_rings, grid.finer()))
    zones = keep("taxi_zones", inputs.zones)
    keep("trip_rejects", quality.trip_rejects(inputs.trips, cells, settings.unknown_zones))
    keep("repeated_zones", quality.repeated_zones(zones))
    keep("zones_without_cells", quality.zones_without_cells(cells))
    keep("station_rejects", stations.rejected_stations(inputs.stations_raw))
    if inputs.stations_broken is not None:
        keep("station_broken_rows", inputs.stations_broken)
    chargers = keep("ny_chargers", stations.clean_stations(inputs.stations_raw, settings, station_key))

    path = folder("demand_h3_res8_5min")
    writers.write_demand(dm.demand_from_trips(inputs.trips, positions, settings, trip_key), path)
    demand = spark.read.parquet(path)
    tables["demand_h3_res8_5min"] = demand

    rows = keep("demand_features", features.demand_features(demand, zones, hours, settings))
    train, _ = ml.split_by_time(rows, settings.model.cutoff)
    inputs_of_model = ml.feature_names(features.lag_names(settings))
    model = ml.fit(train, settings.model, inputs_of_model, fit_partitions)
    ml.save(model, layout.path("gbt_model"))
    scored = ml.score(model, rows)
    predictions = keep("demand_predictions", ml.predictions_table(scored))
    _, unseen_rows = ml.split_by_time(scored, settings.model.cutoff)
    keep("model_metrics", ml.regression_metrics(unseen_rows))
    keep("feature_importance", ml.feature_importance(spark, model, scored))
    _, unseen = ml.split_by_time(predictions, settings.model.cutoff)
    averaged = unseen if typical_from_test_rows else predictions
    slots = keep("typical_demand_lookup", typical.typical_demand(averaged))

    nearest = keep(
        "nearest_chargers",
        stations.nearest_table(positions.select("LocationID", "h3_cell"), chargers, settings.stations_per_cell),
    )
    recs = recommend.recommendations(slots, stations.cell_scores(nearest, settings), settings)
    path = folder("recommendations")
    writers.write_slots(recs, path)
    tables["recommendations"] = spark.read.parquet(path)
    if schema is not None:
        for name in tables:
            writers.register(spark, f"{schema}.{name}", folders[name])
    if keep_versions is not None:
        for name in folders:
            versions.drop_old(spark, layout.path(name), keep_versions)
    return tables


def export_gold(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Copy the serving tables to ``base``."""
    served = ("recommendations", "typical_demand_lookup", "ny_chargers", "nearest_chargers")
    return writers.export({name: tables[name] for name in served}, base)
