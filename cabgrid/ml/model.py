"""Demand model: encoding, boosted trees, scoring, metrics, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.config import ModelConfig, Settings
from cabgrid.operators.series import lag_name

LABEL = "target_pickup_count"

# Model inputs in vector order, before the lags; the two *_vec columns are one-hot.
BEFORE_LAGS = [
    "pickup_count",
    "avg_trip_distance",
    "avg_fare",
    "avg_speed",
    "avg_tip_pct",
    "avg_passengers",
    "temp_2m",
    "rain",
    "snow",
    "wind",
    "is_raining",
    "is_snowing",
    "weather_type_vec",
    "temperature_bucket_vec",
    "window_start_hour",
    "day_of_week",
]


def feature_names(lags: Sequence[str]) -> list[str]:
    """Model inputs in vector order: the fixed ones, then the lag columns."""
    return [*BEFORE_LAGS, *lags]


#: Model inputs with the lags of the default settings.
FEATURES = feature_names([lag_name(n) for n in Settings().row_lags])


def split_by_time(rows: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff for training, the rest for testing."""
    at = F.to_timestamp(F.lit(cutoff))
    return rows.filter(F.col("window_start") < at), rows.filter(F.col("window_start") >= at)


def encoder(inputs: Sequence[str] = FEATURES) -> Pipeline:
    """Category indexes, one-hot vectors and the assembled ``features`` vector."""
    indexer = StringIndexer(
        inputCols=["weather_type", "temp_bucket"],
        outputCols=["weather_type_index", "temperature_bucket_index"],
        handleInvalid="keep",
    )
    one_hot = OneHotEncoder(
        inputCols=["weather_type_index", "temperature_bucket_index"],
        outputCols=["weather_type_vec", "temperature_bucket_vec"],
    )
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
    return Pipeline(stages=[indexer, one_hot, assembler])


def regressor(config: ModelConfig) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features",
        labelCol=LABEL,
        predictionCol="prediction",
        maxIter=config.trees,
        maxDepth=config.depth,
        seed=config.seed,
        # Trees build on each other; cutting lineage keeps a lost executor cheap.
        checkpointInterval=10,
    )


def fit_encoder(train: DataFrame, inputs: Sequence[str] = FEATURES) -> PipelineModel:
    """Categories are learned from training rows only."""
    return encoder(inputs).fit(train)


def fit(
    train: DataFrame, config: ModelConfig, inputs: Sequence[str] = FEATURES, partitions: int | None = None
) -> PipelineModel:
    """Encoder and trees as one model. ``train`` is scanned once per tree level: pass a written table.

    ``partitions`` spreads the training rows over so many tasks; files of a
    small table would else give fewer tasks than cores. Every tenth tree cuts
    its lineage, which needs a checkpoint folder: the shared one is set if none is.
    """
    session.ensure_checkpoint_dir(train.sparkSession)
    encoded = fit_encoder(train, inputs)
    rows = train if partitions is None else train.repartition(partitions)
    trees = regressor(config).fit(encoded.transform(rows))
    return PipelineModel(stages=[*encoded.stages, trees])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def predictions_table(scored: DataFrame) -> DataFrame:
    """The predictions table."""
    return scored.select(
        "window_start",
        "pickup_h3",
        "pickup_lat",
        "pickup_lon",
        F.col("prediction").alias("predicted_demand"),
    )


def regression_metrics(rows: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """``rmse``, ``mae`` and ``r2`` in one pass over the rows that have both values."""
    rows = rows.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y, error = F.col(label), F.col(prediction) - F.col(label)
    total = F.var_pop(y) * F.count(y)
    return rows.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1.0 - F.sum(error * error) / F.nullif(total, F.lit(0.0))).alias("r2"),
        F.count(y).alias("row_count"),
    )


def feature_importance(spark: SparkSession, model: PipelineModel, scored: DataFrame) -> DataFrame:
    """``(feature, importance)`` with names taken from the vector's metadata."""
    trees = model.stages[-1]
    assert isinstance(trees, GBTRegressionModel)
    groups = scored.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in groups.values() for a in group}
    values = trees.featureImportances.toArray()
    return spark.createDataFrame(
        [(names[i], float(v)) for i, v in enumerate(values)], "feature string, importance double"
    )
