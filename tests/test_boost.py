"""Boosted trees on shared histograms against a plain exhaustive grower."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veld.operators.select import fold_column
from veld.plans import boost

FEATS = ["a", "b", "c"]
KEY = ["id"]


def _data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)) * [1, 5, 2], 1)
    y = 3 + np.where(x[:, 0] > 0.3, 4.0, 0.0) + np.abs(x[:, 1]) + 0.2 * x[:, 2] + rng.normal(scale=0.3, size=n)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id long, a double, b double, c double, y double")
    return df.withColumn("fold", fold_column(KEY, 4, 1)).repartition(5), x, y


def _brute(x, y, cuts, p):
    """Grow row sets recursively, trying every cut of every feature."""
    soft = lambda g: np.sign(g) * max(abs(g) - p["reg_alpha"], 0)
    score = lambda g, h: soft(g) ** 2 / (h + p["reg_lambda"])
    pred = np.full(len(y), y.mean())

    def grow(rows, depth, g):
        best = None
        for f in range(x.shape[1]) if depth < p["max_depth"] else ():
            for c in cuts[f]:
                left = rows[x[rows, f] <= c]
                right = rows[x[rows, f] > c]
                if min(len(left), len(right)) < max(p["min_child_weight"], 1e-9):
                    continue
                gain = 0.5 * (score(g[left].sum(), len(left)) + score(g[right].sum(), len(right)) - score(g[rows].sum(), len(rows))) - p["gamma"]
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                    best = gain, left, right
        if best is None:
            pred[rows] += -p["learning_rate"] * soft(g[rows].sum()) / (len(rows) + p["reg_lambda"])
        else:
            grow(best[1], depth + 1, g)
            grow(best[2], depth + 1, g)

    for _ in range(p["n_estimators"]):
        grow(np.arange(len(y)), 0, pred - y)
    return pred


@pytest.mark.parametrize("params", [
    {"n_estimators": 1, "max_depth": 1}, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5},
    {"n_estimators": 2, "max_depth": 3, "gamma": 5.0, "reg_alpha": 3.0, "reg_lambda": 2.5, "min_child_weight": 12.0}])
def test_trees_equal_an_exhaustive_grower(spark, params):
    df, x, y = _data(spark)
    model = boost.fit_boosted(df, FEATS, "y", KEY, [params], max_bins=16)[0][0]
    got = [r["prediction"] for r in model.transform(df).orderBy("id").collect()]
    np.testing.assert_allclose(got, _brute(x, y, model.cuts, boost.DEFAULTS | params), rtol=1e-9)


def test_models_grown_together_equal_models_grown_alone(spark):
    """Draws of rows and columns hang on the model's place, so the first of two is the one alone."""
    df, _, _ = _data(spark)
    params = {"n_estimators": 4, "max_depth": 2, "subsample": 0.7, "colsample_bytree": 0.67}
    both = boost.fit_boosted(df, FEATS, "y", KEY, [params, {"n_estimators": 6, "max_depth": 3}])
    alone = boost.fit_boosted(df.repartition(2), FEATS, "y", KEY, [params])[0][0]
    assert len(both[0][0].trees) == 4 and len(both[1][0].trees) == 6
    for t, u in zip(both[0][0].trees, alone.trees):
        np.testing.assert_array_equal(t.feature, u.feature)
        np.testing.assert_allclose(t.value, u.value, rtol=1e-9)
    assert all(len(set(t.feature[t.feature >= 0])) <= 2 for t in alone.trees)


def test_early_stopping_and_held_out_scores(spark):
    df, x, y = _data(spark)
    params = {"n_estimators": 40, "max_depth": 4, "learning_rate": 0.9, "reg_lambda": 0.0, "early_stopping_rounds": 3}
    model = boost.fit_boosted(df, FEATS, "y", KEY, [params], "fold", [2])[0][0]
    assert model.stopped and model.best_iteration < len(model.trees) < 40
    assert len(model.scores) == len(model.trees) + 1 and len(model.scores) - 1 - model.best_iteration == 3
    held = model.transform(df.filter("fold = 2"))
    rmse = held.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0]
    assert rmse == pytest.approx(model.scores[model.best_iteration], rel=1e-9)
    assert sum(w for _, w in model.importance()) == pytest.approx(1)


def test_search_scores(spark):
    df, _, _ = _data(spark)
    rows = boost.boosted_search(df, FEATS, "y", KEY, [{"n_estimators": 1, "max_depth": 1}, {"n_estimators": 12, "max_depth": 3}]).collect()
    assert rows[1]["mean_r2"] > rows[0]["mean_r2"] + 0.2 and [r["trees"] for r in rows] == [1.0, 12.0]


def test_missing_values_unknown_parameters_and_constant_labels(spark):
    df, _, _ = _data(spark, 50)
    with pytest.raises(ValueError, match="lack"):
        boost.fit_boosted(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), FEATS, "y", KEY, [{}])
    with pytest.raises(ValueError, match="unknown"):
        boost.fit_boosted(df, FEATS, "y", KEY, [{"depth": 3}])
    model = boost.fit_boosted(df.withColumn("y", F.lit(2.0)), FEATS, "y", KEY, [{"n_estimators": 2}])[0][0]
    assert {r["prediction"] for r in model.transform(df).collect()} == {2.0}
