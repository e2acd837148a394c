import os
import uuid

import numpy as np
import pytest

from veld.plans.evaluate import regression_metrics
from pyspark.sql import functions as F

from veld.operators.select import fold_column, holdout_split
from veld.plans import evaluate as ev
from veld.plans.linear_cv import cross_validate_linear, fit_least_squares
from veld.plans.models import label_stats, make_pipeline, weights_table
from veld.session import checkpoint_root
from veld.sources import io


def _data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2] + [0.0, 10.0, 1.0]
    y = 3.0 + x @ np.array([2.0, -0.5, 4.0]) + rng.normal(scale=0.5, size=n)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    return df.withColumn("fold", fold_column(["id"], 5, 1)), x, y


def _cd(x, y, l1, l2, iters=5000):
    """Brute-force coordinate descent for 1/(2n)|y-b-Xw|^2 + l1|w|_1 + l2/2|w|^2."""
    n, p = x.shape
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    w = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / n
            z = xc[:, j] @ xc[:, j] / n + l2
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / z
    return w, ym - xm @ w


FEATS = ["a", "b", "c"]


def test_least_squares_matches_numpy(spark):
    df, x, y = _data(spark)
    m = fit_least_squares(df, FEATS, "y")
    xa = np.c_[np.ones(len(y)), x]
    coef = np.linalg.lstsq(xa, y, rcond=None)[0]
    assert m.intercept == pytest.approx(coef[0], rel=1e-9)
    np.testing.assert_allclose(m.coefficients, coef[1:], rtol=1e-9)


def test_spark_ols_and_ridge_conversion(spark):
    df, x, y = _data(spark)
    ols = make_pipeline("linear", FEATS, label="y", scale=False).fit(df)
    xa = np.c_[np.ones(len(y)), x]
    np.testing.assert_allclose(ols.stages[-1].coefficients.toArray(),
                               np.linalg.lstsq(xa, y, rcond=None)[0][1:], rtol=1e-8)
    alpha = 500.0
    ridge = make_pipeline("ridge", FEATS, label="y", scale=False, stats=label_stats(df, "y"),
                          alpha=alpha).fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    np.testing.assert_allclose(ridge.stages[-1].coefficients.toArray(), want, rtol=1e-6)


def test_lasso_and_elastic_net_conversion(spark):
    df, x, y = _data(spark)
    lasso = make_pipeline("lasso", FEATS, label="y", scale=False, stats=label_stats(df, "y"),
                          alpha=0.3).fit(df)
    w, _ = _cd(x, y, 0.3, 0.0)
    np.testing.assert_allclose(lasso.stages[-1].coefficients.toArray(), w, atol=2e-4)
    en = make_pipeline("elastic_net", FEATS, label="y", scale=False, stats=label_stats(df, "y"),
                       alpha=0.5, l1_ratio=0.3).fit(df)
    w, _ = _cd(x, y, 0.5 * 0.3, 0.5 * 0.7)
    np.testing.assert_allclose(en.stages[-1].coefficients.toArray(), w, atol=2e-3)


def test_fused_cv_equals_per_fold_fits(spark):
    df, _, _ = _data(spark)
    for kind, params in [("linear", {}), ("linear", {"fit_intercept": False}),
                         ("ridge", {"alpha": 50.0})]:
        fused = {r["fold"]: r["r2"] for r in
                 cross_validate_linear(df, FEATS, "y", "fold", [dict(params, kind=kind)]).collect()}
        # reference: numpy fit per fold with the sklearn pipeline semantics
        pdf = df.toPandas()
        for k, r2 in fused.items():
            tr, te = pdf[pdf.fold != k], pdf[pdf.fold == k]
            xt = tr[FEATS].to_numpy()
            mu, sd = xt.mean(0), xt.std(0)
            xs = (xt - mu) / sd
            yt = tr.y.to_numpy()
            a = params.get("alpha", 0.0)
            if params.get("fit_intercept", True):
                w = np.linalg.solve(xs.T @ xs + a * np.eye(3), xs.T @ (yt - yt.mean()))
                b = yt.mean()
            else:
                w = np.linalg.solve(xs.T @ xs + a * np.eye(3), xs.T @ yt)
                b = 0.0
            pred = b + ((te[FEATS].to_numpy() - mu) / sd) @ w
            yy = te.y.to_numpy()
            want = 1 - ((yy - pred) ** 2).sum() / ((yy - yy.mean()) ** 2).sum()
            assert r2 == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_spark_ml_cv_path_agrees(spark):
    df, _, _ = _data(spark)
    fused = {r["fold"]: r["r2"] for r in ev.cross_validate(df, "linear", FEATS, "y").collect()}
    per_fit = {r["fold"]: r["r2"] for r in ev.cross_validate(df, "linear", FEATS, "y", k=5).collect()}
    for k in fused:
        assert fused[k] == pytest.approx(per_fit[k], rel=1e-7)


def test_random_search_and_best(spark):
    df, _, _ = _data(spark)
    cands = ev.sample_params({"alpha": [0.1, 10.0, 1000.0], "fit_intercept": [True, False]}, 4, 1)
    assert len(cands) == 4 and len({tuple(sorted(c.items())) for c in cands}) == 4
    res = ev.random_search(df, "ridge", FEATS, "y", cands)
    best = ev.best_of(res).first()
    assert best["mean_r2"] == max(r["mean_r2"] for r in res.collect())
    tie = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.5), ("c", 2, 0.4)],
                                "model string, candidate int, mean_r2 double")
    assert ev.best_of(tie).first()["model"] == "a"


def test_metrics_edge_cases(spark):
    perfect = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    m = ev.regression_metrics(perfect).first()
    assert m["r2"] == 1.0 and m["rmse"] == 0.0 and m["mae"] == 0.0
    const = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label double, prediction double")
    assert ev.regression_metrics(const).first()["r2"] is None
    bad = spark.createDataFrame([(1.0, 3.0), (2.0, -1.0), (3.0, 0.0)], "label double, prediction double")
    mb = ev.regression_metrics(bad).first()
    assert mb["r2"] < 0 and mb["mse"] == pytest.approx((4 + 9 + 9) / 3)


def test_trees_and_importance(spark):
    df, _, _ = _data(spark, n=300)
    train, test = holdout_split(df, ["id"], 0.2, 42)
    rf, metrics, _ = ev.train_evaluate(train, test, "random_forest", FEATS, "y", cv=False,
                                       n_estimators=10, max_depth=5)
    assert {r["phase"] for r in metrics.collect()} == {"train", "test"}
    w = dict(weights_table(rf, FEATS))
    assert abs(sum(w.values()) - 1.0) < 1e-9 and w["b"] > w["c"]  # b: |0.5| x sd 5 dominates
    gbt = ev.fit("gbt", train, FEATS, "y", n_estimators=5, max_depth=3)
    assert ev.regression_metrics(gbt.transform(test), "y").first()["r2"] > 0.5


def test_model_save_load_identical(spark):
    df, _, _ = _data(spark, n=100)
    model = make_pipeline("linear", FEATS, label="y").fit(df)
    path = os.path.join(checkpoint_root(spark), "test-models", uuid.uuid4().hex[:12])
    io.save_model(model, path)
    loaded = io.load_model(path)
    a = [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()]
    b = [r[0] for r in loaded.transform(df).orderBy("id").select("prediction").collect()]
    assert a == b
    assert io.load_model(path + "-missing") is None


def test_split_and_folds_stable(spark):
    df, _, _ = _data(spark, n=1000)
    train, test = holdout_split(df, ["id"], 0.2, 42)
    n_test = test.count()
    assert 120 < n_test < 280 and train.count() + n_test == 1000
    again = df.repartition(7)
    _, test2 = holdout_split(again, ["id"], 0.2, 42)
    assert sorted(r[0] for r in test.select("id").collect()) == sorted(r[0] for r in test2.select("id").collect())
    folds = df.groupBy("fold").count().collect()
    assert len(folds) == 5 and sum(r["count"] for r in folds) == 1000
    assert df.where(F.col("fold").isNull()).count() == 0


def test_gbt_early_stopping_uses_validation_rows(spark):
    df, _, _ = _data(spark, n=400)
    df = df.withColumn("is_valid", F.col("fold") == 0)
    full = ev.fit("gbt", df, FEATS, "y", n_estimators=60, max_depth=3, learning_rate=0.3)
    early = ev.fit("gbt", df, FEATS, "y", n_estimators=60, max_depth=3, learning_rate=0.3,
                   validation_col="is_valid", validation_tol=0.05)
    assert early.stages[-1].getNumTrees <= full.stages[-1].getNumTrees
    assert early.stages[-1].getNumTrees < 60


def test_comoment_merge_and_unmerge(spark):
    from veld.plans.linear_cv import _merge, _minus, fold_statistics
    df, x, y = _data(spark, n=300)
    st = fold_statistics(df, FEATS, "y", "fold")
    allst = fold_statistics(df, FEATS, "y", None)[0]
    total = st[0]
    for k in sorted(st)[1:]:
        total = _merge(total, st[k])
    for key in ("mx", "cxx", "cxy"):
        np.testing.assert_allclose(total[key], allst[key], rtol=1e-9, atol=1e-9)
    back = _minus(total, st[0])
    rest = st[1]
    for k in sorted(st)[2:]:
        rest = _merge(rest, st[k])
    for key in ("n", "mx", "my", "cxx", "cxy", "cyy"):
        np.testing.assert_allclose(back[key], rest[key], rtol=1e-9, atol=1e-7)
    np.testing.assert_allclose(allst["cxx"], (x - x.mean(0)).T @ (x - x.mean(0)), rtol=1e-9)


def test_least_squares_raises_on_missing_values(spark):
    df, x, y = _data(spark, n=200)
    holes = df.withColumn("a", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("a")))
    with pytest.raises(ValueError, match="20 rows"):
        fit_least_squares(holes, FEATS, "y")


def test_metrics_are_over_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None), (3.0, 2.0), (None, 9.0)], "label double, prediction double")
    row = regression_metrics(df).first()
    assert row["n"] == 2 and row["mse"] == pytest.approx((0.25 + 1) / 2) and row["r2"] == pytest.approx(1 - 1.25 / 2)


@pytest.mark.parametrize("alpha, ratio", [(0.05, 1.0), (0.6, 1.0), (0.3, 0.4), (0.0, 1.0), (50.0, 0.7)])
def test_penalised_descent_against_brute_force_and_conditions(spark, alpha, ratio):
    """Coordinate descent on co-moments: a plain descent on the rows, and the optimality conditions."""
    from veld.plans.linear_cv import fold_statistics, optimality_gap, solve_penalised
    df, x, y = _data(spark)
    stats = fold_statistics(df, FEATS, "y", None)[0]
    c0, v = solve_penalised(stats, alpha, ratio)
    sd = x.std(0)
    w, b = _cd((x - x.mean(0)) / sd, y, alpha * ratio, alpha * (1 - ratio))
    np.testing.assert_allclose(v * sd, w, atol=1e-7)
    assert c0 == pytest.approx(y.mean() - v @ x.mean(0), rel=1e-9) and b == pytest.approx(y.mean())
    z = (x - x.mean(0)) / sd
    grad = z.T @ (y - y.mean() - z @ (v * sd)) / len(y)
    assert optimality_gap(grad, v * sd, alpha * ratio, alpha * (1 - ratio)) < 1e-8


def test_fused_lasso_folds_equal_spark_fits(spark):
    df, _, _ = _data(spark)
    for kind, params in (("lasso", {"alpha": 0.2}), ("elastic_net", {"alpha": 0.3, "l1_ratio": 0.4}), ("lasso", {"alpha": 0.2, "fit_intercept": False})):
        fused = {r["fold"]: r["r2"] for r in ev.cross_validate(df, kind, FEATS, "y", "fold", **params).collect()}
        fits = {r["fold"]: r["r2"] for r in ev.cross_validate(df, kind, FEATS, "y", "fold", k=5, **params).collect()}
        assert fused == pytest.approx(fits, abs=1e-5)


def test_constant_and_repeated_features(spark):
    """A constant feature gets no weight; twins share it in an elastic net."""
    from veld.plans.linear_cv import fit_linear
    df, _, _ = _data(spark)
    df = df.withColumn("k", F.lit(7.0)).withColumn("twin", F.col("a"))
    m = fit_linear(df, "elastic_net", ["a", "twin", "k"], "y", alpha=0.2, l1_ratio=0.5)
    assert m.coefficients[2] == 0 and m.coefficients[0] == pytest.approx(m.coefficients[1], rel=1e-6)
