"""The tree models' search bins the rows of all folds once; its scores are those of a fit for each fold."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from veld.operators.quantiles import exact_quantiles
from veld.plans import evaluate as ev
from veld.plans import ranks
from veld.session import checkpoint_root, materialize

FEATS = ["a", "b", "c"]


def _data(spark, n=500):
    """A feature with ties at a bound, one of few values (one of them in fold 0 alone), one without ties."""
    rng = np.random.default_rng(8)
    a, b, c = np.clip(rng.normal(size=n), -0.7, 0.9) * 1e4, rng.integers(0, 32, n) / 7, rng.normal(size=n)
    fold = rng.integers(0, 3, n)
    b[np.flatnonzero(fold == 0)[0]] = 9.0
    y = 100 + a / 1e3 + np.where(b > 2, 5.0, 0.0) * (c > 0) + rng.normal(size=n)
    rows = [(i, int(fold[i]), *(float(v[i]) for v in (a, b, c, y))) for i in range(n)]
    return materialize(spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, y double").repartition(3), "search-test")


@pytest.mark.parametrize("kind, params", [
    ("random_forest", {"n_estimators": 4, "max_depth": 5, "min_samples_leaf": 2}),
    ("random_forest", {"n_estimators": 3, "max_depth": 4, "max_features": "log2", "bootstrap": False}),
    ("gbt", {"n_estimators": 5, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.7})])
def test_search_scores_are_those_of_a_fit_for_each_fold(spark, kind, params):
    df = _data(spark)
    want = []
    for i in range(3):
        model = ev.fit(kind, df.where(F.col("fold") != i), FEATS, "y", **params)
        want.append(ev.regression_metrics(model.transform(df.where(F.col("fold") == i)), "y").first()["r2"])
    got = ev.random_search(df, kind, FEATS, "y", [params]).first()
    np.testing.assert_allclose([got["mean_r2"], got["std_r2"]], [np.mean(want), np.std(want)], rtol=1e-9)


def test_rows_are_written_once_for_all_candidates_and_folds(spark):
    df, stages = _data(spark), os.path.join(checkpoint_root(spark).removeprefix("file:"), "stages")
    before = set(os.listdir(stages))
    ev.random_search(df, "gbt", FEATS, "y", [{"n_estimators": n, "max_depth": 2} for n in (1, 2)])
    assert len(set(os.listdir(stages)) - before) == 2


def test_search_with_gaps_raises(spark):
    df = _data(spark)
    for column in ("a", "y"):
        with pytest.raises(Exception):
            ev.random_search(df.withColumn(column, F.when(F.col("id") != 3, F.col(column))), "gbt", FEATS, "y", [{"n_estimators": 1}])


@pytest.mark.parametrize("by_value, parts", [(100_000, 1 << 15), (0, 64)])
def test_order_values_outside_a_fold_are_exact(spark, monkeypatch, by_value, parts):
    """NaN and NULL, both zeros, ties, infinities and very unlike sizes."""
    monkeypatch.setattr(ranks, "BY_VALUE", by_value)
    monkeypatch.setattr(ranks, "MAX_PARTS", parts)
    rng, n = np.random.default_rng(2), 2000
    x, z = np.clip(rng.normal(size=n), -0.5, 0.7), rng.lognormal(0, 30, n) * rng.choice([-1, 1], n)
    x[::5], x[::7], x[::11], z[3], z[4] = np.nan, 0.0, -0.0, np.inf, -np.inf
    df = spark.createDataFrame([(i % 3, float(x[i]) if i % 13 else None, float(z[i])) for i in range(n)], "fold int, x double, z double").repartition(3)
    probs = [0.0, *[k / 32 for k in range(1, 32)], 1.0]
    counts, values = ranks.order_values(df, ["x", "z"], "fold", [None, 0, 2], probs)
    for h in (None, 0, 2):
        want = exact_quantiles(df if h is None else df.where(F.col("fold") != h), ["x", "z"], probs)
        for c in ("x", "z"):
            np.testing.assert_array_equal(ranks.between(counts[c, h], lambda r: values[c, h, r], probs), want[c])


@pytest.mark.parametrize("kind, candidates", [
    ("random_forest", [{"n_estimators": 3, "max_depth": None, "max_features": "log2"}, {"n_estimators": 5, "max_depth": 2, "min_samples_leaf": 4},
                       {"n_estimators": 4, "max_depth": 3, "max_features": "all", "bootstrap": False}]),
    ("gbt", [{"n_estimators": 2, "max_depth": 3, "subsample": 0.6}, {"n_estimators": 4, "max_depth": 2, "subsample": 0.6, "colsample_bytree": 0.5},
             {"n_estimators": 3, "max_depth": 2}])])
def test_candidates_that_share_scans_score_as_alone(spark, monkeypatch, kind, candidates):
    """The sums of a fold's tree serve all candidates; few cells a task mean more scans, not other scores."""
    from veld.plans import boost, tree_search
    df = _data(spark)
    bins = tree_search.FoldBins(df, FEATS, "y", "fold", 3)
    alone = [[bins.r2(tree_search.make_regressor(kind, label="y", seed=42, **p), i) for i in range(3)] for p in candidates]
    monkeypatch.setattr(tree_search.FoldBins, "r2", None)
    monkeypatch.setattr(boost, "MAX_CELLS", 300_000)
    got = ev.random_search(df, kind, FEATS, "y", candidates).orderBy("candidate").collect()
    np.testing.assert_allclose([r["mean_r2"] for r in got], [np.mean(r) for r in alone], rtol=1e-9)
    np.testing.assert_allclose([r["std_r2"] for r in got], [np.std(r) for r in alone], rtol=1e-6)
