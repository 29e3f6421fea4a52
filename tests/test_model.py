"""The demand model on a small fit: shapes, determinism, metrics. Metric values are no acceptance test."""

import math
from dataclasses import replace

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.ml import model as ml
from checks import fixtures as fx
from checks import registry as reg
from tests.conftest import SF

SMALL = replace(fx.SETTINGS.model, trees=5, depth=3)


@pytest.fixture(scope="module")
def rows(spark):
    session.prepare(spark)
    return reg.features(spark, SF)


@pytest.fixture(scope="module")
def fitted(rows):
    train, _ = ml.split_by_time(rows, SMALL.cutoff)
    return ml.fit(train, SMALL)


def test_split_is_complete_and_ordered(rows):
    train, test = ml.split_by_time(rows, SMALL.cutoff)
    assert train.count() + test.count() == rows.count()
    assert train.agg(F.max("window_start")).first()[0] < test.agg(F.min("window_start")).first()[0]


def test_vector_has_24_entries(rows, fitted):
    scored = ml.score(fitted, rows)
    sizes = scored.select(F.size(vector_to_array("features")).alias("n")).distinct()
    assert [r.n for r in sizes.collect()] == [24]
    assert scored.schema["features"].metadata["ml_attr"]["num_attrs"] == 24


def test_every_row_is_scored_with_a_finite_number(rows, fitted):
    table = ml.predictions_table(ml.score(fitted, rows))
    assert table.columns == ["window_start", "pickup_h3", "pickup_lat", "pickup_lon", "predicted_demand"]
    assert table.count() == rows.count()
    assert table.filter("predicted_demand IS NULL OR isnan(predicted_demand)").count() == 0


def test_same_seed_and_input_give_the_same_model(rows, fitted):
    train, test = ml.split_by_time(rows, SMALL.cutoff)
    again = ml.fit(train, SMALL)
    total = [ml.score(m, test).agg(F.sum("prediction")).first()[0] for m in (fitted, again)]
    assert total[0] == pytest.approx(total[1], rel=1e-9)


def test_unseen_categories_are_kept(rows, fitted):
    odd = rows.withColumns({"weather_type": F.lit("Fog"), "temp_bucket": F.lit(None).cast("string")})
    first = ml.score(fitted, odd).select("weather_type_vec", "temperature_bucket_vec").first()
    assert first[0].numNonzeros() == 0 and first[1].numNonzeros() == 0


def test_metrics_equal_the_library_evaluator(rows, fitted):
    scored = ml.score(fitted, rows)
    got = ml.regression_metrics(scored, "pickup_count", "prediction").first()
    wide = scored.withColumn("pickup_count", F.col("pickup_count").cast("double"))
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="pickup_count", predictionCol="prediction", metricName=name)
        assert got[name] == pytest.approx(evaluator.evaluate(wide), rel=1e-6)


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    got = ml.regression_metrics(df, "y", "p").first()
    assert (got.rmse, got.mae, got.r2, got.row_count) == (1.0, 1.0, None, 2)


def test_importances_are_named_and_sum_to_one(spark, rows, fitted):
    got = ml.feature_importance(spark, fitted, ml.score(fitted, rows)).collect()
    assert len({r.feature for r in got}) == 24
    assert {"pickup_count", "prev_demand", "lag_288"} <= {r.feature for r in got}
    assert math.isclose(sum(r.importance for r in got), 1.0, rel_tol=1e-9)


def test_saved_model_scores_as_before(spark, rows, fitted, tmp_path):
    path = str(tmp_path / "model")
    ml.save(fitted, path)
    ml.save(fitted, path)  # replaces
    a, b = (ml.score(m, rows).agg(F.sum("prediction")).first()[0] for m in (fitted, ml.load(path)))
    assert a == b
