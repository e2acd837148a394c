"""The tree stages against Spark ML's trees where nothing is drawn, and the number of their jobs."""

import os
import uuid

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from veld.plans import evaluate as ev
from veld.plans.tree_stages import features_of
from veld.session import checkpoint_root
from veld.sources import io

FEATS = ["a", "b", "c"]


def _data(spark, n=600):
    """Few values of each feature, so every cut lies between two of them here and in Spark ML; two rows equal."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 20, n), rng.integers(0, 12, n) / 10, rng.integers(0, 5, n)]).astype(float)
    y = 1000 + 3 * x[:, 0] + np.where(x[:, 1] > 0.55, 40.0, 0.0) * (x[:, 2] > 1) + rng.normal(size=n)
    x[1], y[1] = x[0], y[0]
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id long, a double, b double, c double, y double").repartition(3)


def _predictions(model, df):
    return [r["prediction"] for r in model.transform(df).orderBy("id").collect()]


def _spark_ml(regressor, df):
    return Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="features"), regressor.setLabelCol("y")]).fit(df)


def _jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "trees")
    run()
    spark.sparkContext.setJobGroup("after", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("leaf", [7])
def test_forest_without_draws_is_spark_ml(spark, leaf):
    df = _data(spark)
    own = ev.fit("random_forest", df, FEATS, "y", n_estimators=2, max_depth=4, min_samples_leaf=leaf, max_features="all", bootstrap=False, scale=False)
    ml = _spark_ml(RandomForestRegressor(numTrees=2, maxDepth=4, minInstancesPerNode=leaf, featureSubsetStrategy="all", bootstrap=False), df)
    np.testing.assert_allclose(_predictions(own, df), _predictions(ml, df), rtol=1e-9)
    np.testing.assert_allclose(own.stages[-1].featureImportances.toArray(), ml.stages[-1].featureImportances.toArray(), rtol=1e-6)
    path = os.path.join(checkpoint_root(spark), "test-models", uuid.uuid4().hex[:12])
    io.save_model(own, path)
    loaded = io.load_model(path)
    assert _predictions(loaded, df) == _predictions(own, df)
    assert loaded.stages[-1].featureImportances == own.stages[-1].featureImportances


def test_boosting_without_draws_is_spark_ml(spark):
    df = _data(spark)
    own = ev.fit("gbt", df, FEATS, "y", n_estimators=8, max_depth=3, learning_rate=0.1, scale=False)
    ml = _spark_ml(GBTRegressor(maxIter=8, maxDepth=3, stepSize=0.1, featureSubsetStrategy="all"), df)
    np.testing.assert_allclose(_predictions(own, df), _predictions(ml, df), rtol=1e-9)
    np.testing.assert_allclose(own.stages[-1].featureImportances.toArray(), ml.stages[-1].featureImportances.toArray(), rtol=1e-6)
    path = os.path.join(checkpoint_root(spark), "test-models", uuid.uuid4().hex[:12])
    io.save_model(own, path)
    assert _predictions(io.load_model(path), df) == _predictions(own, df)


def test_drawn_boosting_is_as_good_as_spark_ml(spark):
    df = _data(spark)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    own = [ev.fit("gbt", train, FEATS, "y", seed=s, n_estimators=12, max_depth=3, subsample=0.5, colsample_bytree=0.5) for s in (1, 2)]
    ml = [_spark_ml(GBTRegressor(maxIter=12, maxDepth=3, stepSize=0.1, subsamplingRate=0.5, featureSubsetStrategy="0.5", seed=s), train) for s in (1, 2)]
    r2 = [[ev.regression_metrics(m.transform(test), "y").first()["r2"] for m in models] for models in (own, ml)]
    assert abs(np.mean(r2[0]) - np.mean(r2[1])) < 0.03 and r2[0][0] != r2[0][1]


def test_drawn_forest_is_as_good_as_spark_ml(spark):
    """Other draws, the same quality: R^2 within the spread of Spark ML's seeds."""
    df = _data(spark)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    params = dict(n_estimators=30, max_depth=5, min_samples_leaf=2)
    own = [ev.fit("random_forest", train, FEATS, "y", seed=s, **params) for s in (1, 2, 3)]
    ml = [_spark_ml(RandomForestRegressor(numTrees=30, maxDepth=5, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=s), train) for s in (1, 2, 3)]
    r2 = [[ev.regression_metrics(m.transform(test), "y").first()["r2"] for m in models] for models in (own, ml)]
    assert abs(np.mean(r2[0]) - np.mean(r2[1])) < 0.02 and len(set(r2[0])) == 3
    weights = [np.mean([m.stages[-1].featureImportances.toArray() for m in models], axis=0) for models in (own, ml)]
    np.testing.assert_allclose(weights[0], weights[1], atol=0.06)


def test_jobs_of_a_forest_grow_neither_with_depth_nor_with_trees(spark):
    df = _data(spark).cache()
    df.count()
    few, many = (_jobs(spark, lambda: ev.fit("random_forest", df, FEATS, "y", n_estimators=n, max_depth=depth)) for n, depth in ((2, 2), (40, 8)))
    assert many <= few


def test_jobs_of_boosting_grow_neither_with_depth_nor_with_trees(spark):
    df = _data(spark).cache()
    df.count()
    few, many = (_jobs(spark, lambda: ev.fit("gbt", df, FEATS, "y", n_estimators=n, max_depth=depth, subsample=0.75)) for n, depth in ((2, 1), (30, 5)))
    assert many <= few


def test_no_split_and_missing_values(spark):
    df = _data(spark)
    mean = df.agg(F.avg("y")).first()[0]
    own = ev.fit("random_forest", df, FEATS, "y", n_estimators=2, max_depth=0, bootstrap=False)
    np.testing.assert_allclose(_predictions(own, df), mean)
    flat = ev.fit("gbt", df, FEATS, "y", n_estimators=2, max_depth=0)
    np.testing.assert_allclose(_predictions(flat, df), mean)
    for column, value in (("a", None), ("y", None), ("y", float("nan"))):
        bad = df.withColumn(column, F.when(F.col("id") != 3, F.col(column)).otherwise(F.lit(value)))
        with pytest.raises(Exception):
            ev.fit("random_forest", bad, FEATS, "y", n_estimators=2)


def test_features_of_a_node():
    assert [features_of(s, 5) for s in ("all", "sqrt", "log2", "onethird", "0.5", "2", 9)] == [5, 3, 3, 2, 3, 2, 5]
