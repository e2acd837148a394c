"""Registered model queries (L1-L8, V1-V8, K1, K2, K5, S6) and the flagship chain.

Single-feature linear fits have closed forms, so OLS, ridge, per-fold CV scores, their
summary, the best-model choice, residual samples and the flagship preparation chain get
DuckDB oracles.  Lasso, elastic net, trees, persistence and searches are checked on rows
only (and against brute force in ``tests/``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from veld.operators import encode, select
from veld.plans import evaluate as ev
from veld.plans.catalog import LI_KEYS, query, r
from veld.plans.inputs import table
from veld.plans.linear_cv import cross_validate_linear, fit_least_squares
from veld.plans.models import label_stats, make_pipeline, weights_frame
from veld.session import checkpoint_root, materialize
from veld.sources import io

KEY_SQL = ("concat_ws(chr(1), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
           "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))")
FEATURES = ["l_quantity", "l_discount", "l_tax"]
LABEL = "l_extendedprice"


def _h(seed: str, modulo: int) -> str:
    return f"((('0x' || substr(md5('{seed}:' || {KEY_SQL}), 1, 8))::BIGINT) % {modulo})"


MODEL_DATA_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice,
       {_h('42', 10000)} < 2000 AS is_test, CAST({_h('fold42', 6)} AS INTEGER) AS fold
FROM lineitem"""


def model_data(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*LI_KEYS, *FEATURES, LABEL,
                     select.split_flag(LI_KEYS, 0.2, 42).alias("is_test"),
                     select.fold_column(LI_KEYS, 6, 42).alias("fold"))


def _train(spark, d):
    data = model_data(spark, d)
    return data, data.where(~F.col("is_test")), data.where(F.col("is_test"))


# ====================================================================== linear closed forms

@query("ols_fit", f"""
WITH t AS ({MODEL_DATA_SQL})
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 9) AS r2_train FROM t WHERE NOT is_test""")
def q_ols_fit(spark, d):
    _, train, _ = _train(spark, d)
    m = make_pipeline("linear", ["l_quantity"], label=LABEL, scale=False).fit(train)
    lr = m.stages[-1]
    r2 = ev.regression_metrics(m.transform(train), LABEL)
    return r2.select(F.round(F.lit(float(lr.coefficients[0])), 6).alias("slope"),
                     F.round(F.lit(float(lr.intercept)), 4).alias("intercept"),
                     r("r2", 9).alias("r2_train"))


RIDGE_ALPHA = 1.0e6


@query("ridge_fit", f"""
WITH t AS ({MODEL_DATA_SQL}), s AS (
  SELECT covar_pop(l_extendedprice, l_quantity) * count(*) AS sxy, var_pop(l_quantity) * count(*) AS sxx,
         avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM t WHERE NOT is_test)
SELECT round(sxy / (sxx + {RIDGE_ALPHA}), 6) AS slope,
       round(my - sxy / (sxx + {RIDGE_ALPHA}) * mx, 4) AS intercept FROM s""")
def q_ridge_fit(spark, d):
    _, train, _ = _train(spark, d)
    m = make_pipeline("ridge", ["l_quantity"], label=LABEL, scale=False,
                      stats=label_stats(train, LABEL), alpha=RIDGE_ALPHA).fit(train)
    lr = m.stages[-1]
    return spark.range(1).select(F.round(F.lit(float(lr.coefficients[0])), 6).alias("slope"),
                                 F.round(F.lit(float(lr.intercept)), 4).alias("intercept"))


# ====================================================================== CV, summary, best

CV_SQL = f"""
WITH t AS ({MODEL_DATA_SQL}), tr AS (SELECT * FROM t WHERE NOT is_test),
f AS (SELECT DISTINCT fold AS k FROM tr),
c1 AS (SELECT f.k, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
       FROM f JOIN tr ON tr.fold <> f.k GROUP BY f.k),
m2 AS (SELECT f.k, avg(l_quantity) AS mx FROM f JOIN tr ON tr.fold <> f.k GROUP BY f.k),
c2 AS (SELECT m2.k, m2.mx, sum((l_quantity - m2.mx) * l_extendedprice) / sum((l_quantity - m2.mx) * (l_quantity - m2.mx)) AS b
       FROM m2 JOIN tr ON tr.fold <> m2.k GROUP BY m2.k, m2.mx),
s1 AS (SELECT 'linear' AS model, c1.k AS fold,
              1 - sum(pow(l_extendedprice - (a + b * l_quantity), 2)) / (count(*) * var_pop(l_extendedprice)) AS r2
       FROM c1 JOIN tr ON tr.fold = c1.k GROUP BY c1.k),
s2 AS (SELECT 'linear_no_intercept' AS model, c2.k AS fold,
              1 - sum(pow(l_extendedprice - b * (l_quantity - mx), 2)) / (count(*) * var_pop(l_extendedprice)) AS r2
       FROM c2 JOIN tr ON tr.fold = c2.k GROUP BY c2.k),
cv AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2)"""

CV_MODELS = [("linear", {"fit_intercept": True}), ("linear_no_intercept", {"fit_intercept": False})]


def _cv(spark, d):
    """Both linear variants, all six folds, from one fused aggregation."""
    _, train, _ = _train(spark, d)
    cands = [dict(p, kind="linear") for _, p in CV_MODELS]
    cv = cross_validate_linear(train, ["l_quantity"], LABEL, "fold", cands,
                               [name for name, _ in CV_MODELS])
    return cv.select("model", "fold", "r2")


@query("cross_validate", CV_SQL + "\nSELECT model, CAST(fold AS INTEGER) AS fold, round(r2, 6) AS r2 FROM cv")
def q_cross_validate(spark, d):
    return _cv(spark, d).select("model", "fold", r("r2").alias("r2"))


@query("fold_score_summary", CV_SQL + """
SELECT model, count(r2) AS n, round(avg(r2), 6) AS mean, round(stddev_pop(r2), 6) AS std,
       round(avg(r2) - 2 * stddev_pop(r2), 6) AS low_2std, round(avg(r2) + 2 * stddev_pop(r2), 6) AS high_2std,
       round(quantile_cont(r2, 0.025), 6) AS q025, round(quantile_cont(r2, 0.075), 6) AS q075
FROM cv GROUP BY model""")
def q_fold_score_summary(spark, d):
    from veld.operators.profile import score_summary
    s = score_summary(_cv(spark, d), "model", "r2", (0.025, 0.075))
    return s.select("model", "n", *[r(c).alias(c) for c in
                                    ["mean", "std", "low_2std", "high_2std", "q025", "q075"]])


@query("best_model", CV_SQL + """
SELECT model, round(avg(r2), 6) AS mean_r2 FROM cv GROUP BY model
ORDER BY avg(r2) DESC, CASE model WHEN 'linear' THEN 0 ELSE 1 END LIMIT 1""")
def q_best_model(spark, d):
    cv = _cv(spark, d)
    pos = F.when(F.col("model") == "linear", 0).otherwise(1)
    res = cv.groupBy("model").agg(F.avg("r2").alias("mean_r2")).withColumn("candidate", pos)
    return ev.best_of(res, "mean_r2", "candidate").select("model", r("mean_r2").alias("mean_r2"))


@query("sample_residuals", f"""
WITH t AS ({MODEL_DATA_SQL}),
c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
      FROM t WHERE NOT is_test)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 4) AS predicted,
       l_extendedprice AS actual, round(a + b * l_quantity - l_extendedprice, 4) AS difference
FROM t, c ORDER BY md5('42:' || {KEY_SQL}) LIMIT 5""")
def q_sample_residuals(spark, d):
    data, train, _ = _train(spark, d)
    m = make_pipeline("linear", ["l_quantity"], label=LABEL, scale=False).fit(train)
    s = ev.sample_residuals(m.transform(data), LI_KEYS, n=5, seed=42, label=LABEL)
    return s.select(*LI_KEYS, r("predicted", 4).alias("predicted"), "actual",
                    r("difference", 4).alias("difference"))


# ====================================================================== least squares in SQL

def fit_sql(rows: str, p: int, models: str = "('linear', 0.0)") -> str:
    """CTEs that end in ``fit``: per group ``k`` of ``rows`` (k, x0 .. x{p-1}, y) and per model
    (name, penalty on coefficients of standardised features) the means ``m0 ..``, ``my`` and
    coefficients ``w0 ..``: normal equations on centred sums, solved by elimination."""
    sums = [f"sum((r.x{i} - m{i}) * (r.x{j} - m{j})) AS s{i}_{j}" for i in range(p) for j in range(i, p)]
    sums += [f"sum((r.x{i} - m{i}) * (r.y - my)) AS s{i}_{p}" for i in range(p)]
    means = ", ".join(f"m{i}" for i in range(p)) + ", my"
    cell = lambda i, j: f"s{min(i, j)}_{max(i, j)}" + (" * (1 + alpha / n)" if i == j else "")
    ctes = [f"mm AS (SELECT k, count(*) AS n, {', '.join(f'avg(x{i}) AS m{i}' for i in range(p))}, avg(y) AS my FROM {rows} GROUP BY k)",
            f"ss AS (SELECT r.k, {', '.join(sums)} FROM {rows} r JOIN mm ON r.k = mm.k GROUP BY r.k)",
            f"cand AS (SELECT model, CAST(a AS DOUBLE) AS alpha FROM (VALUES {models}) AS v(model, a))",
            f"g0 AS (SELECT mm.k, model, {means}, {', '.join(f'{cell(i, j)} AS a{i}_{j}' for i in range(p) for j in range(p + 1))} "
            "FROM mm JOIN ss ON mm.k = ss.k, cand)"]
    for c in range(p):
        left = [(i, j, f"a{c}_{j} / a{c}_{c}" if i == c else f"a{i}_{j} - a{i}_{c} * a{c}_{j} / a{c}_{c}")
                for i in range(p) for j in range(c + 1, p + 1)]
        ctes.append(f"g{c + 1} AS (SELECT k, model, {means}, {', '.join(f'{e} AS a{i}_{j}' for i, j, e in left)} FROM g{c})")
    ctes.append(f"fit AS (SELECT k, model, {means}, {', '.join(f'a{i}_{p} AS w{i}' for i in range(p))} FROM g{p})")
    return ",\n".join(ctes)


def pred_sql(p: int) -> str:
    return "(my + " + " + ".join(f"w{i} * (x{i} - m{i})" for i in range(p)) + ")"


X3_SQL = ", ".join(f"{c} AS x{i}" for i, c in enumerate(FEATURES)) + f", {LABEL} AS y"
BOTH_MODELS = "('linear', 0.0), ('ridge', 1.0)"


# ====================================================================== flagship chain (V1)

FLAG_SQL = f"""
WITH j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
                  o.o_orderpriority, {_h('42', 10000)} < 2000 AS is_test
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
q AS (SELECT quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM j),
c AS (SELECT j.*, least(greatest(l_extendedprice, lo), hi) AS y FROM j, q),
m AS (SELECT o_orderpriority AS k, avg(y) AS enc FROM c WHERE NOT is_test GROUP BY 1),
e AS (SELECT c.*, m.enc AS x FROM c LEFT JOIN m ON c.o_orderpriority = m.k),
f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM e WHERE NOT is_test),
p AS (SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS phase, y, a + b * x AS pred FROM e, f)
SELECT phase, count(*) AS n, round(sqrt(avg(pow(y - pred, 2))), 4) AS rmse,
       round(1 - sum(pow(y - pred, 2)) / (count(*) * var_pop(y)), 9) AS r2,
       round(avg(abs(y - pred)), 4) AS mae, round(avg(pow(y - pred, 2)), -3) AS mse
FROM p GROUP BY phase"""


def prepared_orders_lines(spark, d):
    """lineitem joined to orders, written once to the checkpoint folder.

    The fit steps after it (quantile passes, encoder, scaler, solver, metrics) each scan
    their input; reading the written join keeps the shuffle join from running for each
    of them, and the written table survives executor loss.  Join strategy (broadcast or
    sort-merge) is Catalyst's choice from the file sizes, re-planned by AQE.
    """
    li = table(spark, d, "lineitem").select(*LI_KEYS, *FEATURES, LABEL, "l_returnflag")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
    return materialize(j.withColumn("is_test", select.split_flag(LI_KEYS, 0.2, 42)), "orders-lines")


@query("regression_metrics", FLAG_SQL)
def q_regression_metrics(spark, d):
    j = prepared_orders_lines(spark, d)
    clip = encode.QuantileClip({LABEL: (0.05, 0.95)}).fit(j)
    c = clip.transform(j)
    train = c.where(~F.col("is_test"))
    te = encode.TargetEncoder(["o_orderpriority"], LABEL).fit(train)
    e = te.transform(c)
    tr = e.where(~F.col("is_test"))
    m = fit_least_squares(tr, ["o_orderpriority_encoded"], LABEL)
    pred = m.transform(e).withColumn("phase", F.when(F.col("is_test"), "test").otherwise("train"))
    out = ev.regression_metrics_by(pred, "phase", LABEL)
    return out.select("phase", "n", r("rmse", 4).alias("rmse"), r("r2", 9).alias("r2"),
                      r("mae", 4).alias("mae"), r("mse", -3).alias("mse"))


FLAG5_SQL = f"""
WITH j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_discount, l.l_tax,
                  l.l_extendedprice, l.l_returnflag, o.o_orderpriority, {_h('42', 10000)} < 2000 AS is_test
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
q AS (SELECT quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM j),
c AS (SELECT j.*, least(greatest(l_extendedprice, lo), hi) AS y FROM j, q),
e1 AS (SELECT o_orderpriority AS v, avg(y) AS enc FROM c WHERE NOT is_test GROUP BY 1),
e2 AS (SELECT l_returnflag AS v, avg(y) AS enc FROM c WHERE NOT is_test GROUP BY 1),
e AS (SELECT 1 AS k, is_test, l_quantity AS x0, l_discount AS x1, l_tax AS x2, e1.enc AS x3, e2.enc AS x4, y
      FROM c LEFT JOIN e1 ON c.o_orderpriority = e1.v LEFT JOIN e2 ON c.l_returnflag = e2.v),
tr AS (SELECT * FROM e WHERE NOT is_test),
{fit_sql('tr', 5)},
p AS (SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS phase, y, {pred_sql(5)} AS pred FROM e, fit)
SELECT phase, count(*) AS n, round(sqrt(avg(pow(y - pred, 2))), 4) AS rmse,
       round(1 - sum(pow(y - pred, 2)) / (count(*) * var_pop(y)), 9) AS r2,
       round(avg(abs(y - pred)), 4) AS mae, round(avg(pow(y - pred, 2)), -3) AS mse
FROM p GROUP BY phase"""


@query("price_model", FLAG5_SQL)
def price_model(spark, d):
    """Flagship: join -> clip -> target-encode two categories -> split -> OLS -> metrics, by the
    model pipeline of ``veld.plans.models`` (assembler, scaler, linear regression)."""
    j = prepared_orders_lines(spark, d)
    c = encode.QuantileClip({LABEL: (0.05, 0.95)}).fit(j).transform(j)
    train = c.where(~F.col("is_test"))
    te = encode.TargetEncoder(["o_orderpriority", "l_returnflag"], LABEL).fit(train)
    e = te.transform(c)
    feats = FEATURES + ["o_orderpriority_encoded", "l_returnflag_encoded"]
    m = ev.fit("linear", e.where(~F.col("is_test")), feats, LABEL)
    pred = m.transform(e).withColumn("phase", F.when(F.col("is_test"), "test").otherwise("train"))
    return ev.regression_metrics_by(pred, "phase", LABEL).select(
        "phase", "n", r("rmse", 4).alias("rmse"), r("r2", 9).alias("r2"), r("mae", 4).alias("mae"), r("mse", -3).alias("mse"))


# ====================================================================== reports (V2, V3, V8)

REPORT_SQL = f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT 1 AS k, is_test, {X3_SQL} FROM t),
tr AS (SELECT * FROM e WHERE NOT is_test),
{fit_sql('tr', 3, BOTH_MODELS)},
p AS (SELECT model, CASE WHEN is_test THEN 'test' ELSE 'train' END AS phase, y, {pred_sql(3)} AS pred FROM e, fit),
m AS (SELECT model, phase, sqrt(avg(pow(y - pred, 2))) AS rmse, avg(abs(y - pred)) AS mae, avg(pow(y - pred, 2)) AS mse,
             1 - sum(pow(y - pred, 2)) / (count(*) * var_pop(y)) AS r2 FROM p GROUP BY model, phase)
SELECT model, phase, 'rmse' AS metric, round(rmse, 4) AS value FROM m UNION ALL
SELECT model, phase, 'r2', round(r2, 9) FROM m UNION ALL
SELECT model, phase, 'mae', round(mae, 4) FROM m UNION ALL
SELECT model, phase, 'mse', round(mse, -3) FROM m"""


def _report(spark, d):
    from veld.plans.flow import model_report
    _, train, test = _train(spark, d)
    return model_report(train, test, FEATURES, LABEL, ["linear", "ridge"])


@query("model_report", REPORT_SQL)
def q_model_report(spark, d):
    """Linear and ridge with default parameters: all metrics on train and test rows."""
    value = F.when(F.col("metric") == "r2", r("value", 9)).when(F.col("metric") == "mse", r("value", -3)).otherwise(r("value", 4))
    return _report(spark, d)[0].select("model", "phase", "metric", value.alias("value"))


@query("cv_report", f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT fold, {X3_SQL} FROM t WHERE NOT is_test),
tr AS (SELECT f.k, x0, x1, x2, y FROM e JOIN (SELECT DISTINCT fold AS k FROM e) f ON e.fold <> f.k),
{fit_sql('tr', 3, BOTH_MODELS)}
SELECT model, CAST(fold AS INTEGER) AS fold,
       round(1 - sum(pow(y - {pred_sql(3)}, 2)) / (count(*) * var_pop(y)), 6) AS r2
FROM e JOIN fit ON e.fold = fit.k GROUP BY model, fold""")
def q_cv_report(spark, d):
    """R^2 of linear and ridge with default parameters on each of six folds."""
    return _report(spark, d)[1].select("model", "fold", r("r2").alias("r2"))


@query("penalised_one_feature", f"""
WITH t AS ({MODEL_DATA_SQL}), s AS (
  SELECT avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sd, avg(l_extendedprice) AS my,
         covar_pop(l_extendedprice, l_quantity) / stddev_pop(l_quantity) AS c FROM t WHERE NOT is_test),
w AS (SELECT 'lasso' AS model, s.*, sign(c) * greatest(abs(c) - 20.0, 0) AS w FROM s UNION ALL
      SELECT 'elastic_net' AS model, s.*, sign(c) * greatest(abs(c) - 0.5 * 0.4, 0) / (1 + 0.5 * 0.6) AS w FROM s)
SELECT model, round(w / sd + 0.0, 2) AS slope, round(my - w * mx / sd, 1) AS intercept FROM w""")
def q_penalised_one_feature(spark, d):
    """Lasso and elastic net of one standardised feature: soft thresholds in closed form."""
    _, train, _ = _train(spark, d)
    rows = []
    for kind, params in (("lasso", {"alpha": 20.0}), ("elastic_net", {"alpha": 0.5, "l1_ratio": 0.4})):
        m = ev.fit(kind, train, ["l_quantity"], LABEL, **params)
        ends = m.transform(spark.createDataFrame([(0.0,), (1.0,)], "l_quantity double")).orderBy("l_quantity").collect()
        rows.append((kind, ends[1]["prediction"] - ends[0]["prediction"], ends[0]["prediction"]))
    out = spark.createDataFrame(rows, "model string, slope double, intercept double")
    return out.select("model", r("slope", 2).alias("slope"), r("intercept", 1).alias("intercept"))


def _two_features_sql(models: list[tuple]) -> str:
    """Lasso / elastic net of two standardised features: of the nine sign patterns of the weights,
    the one whose solution satisfies the optimality conditions."""
    rows = ", ".join(f"('{m}', {l1}, {l2})" for m, l1, l2 in models)
    return f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT l_quantity AS x0, l_extendedprice / l_quantity AS x1, l_extendedprice AS y FROM t WHERE NOT is_test),
s AS (SELECT avg(x0) AS m0, avg(x1) AS m1, avg(y) AS my, stddev_pop(x0) AS d0, stddev_pop(x1) AS d1,
             covar_pop(x0, x1) / (stddev_pop(x0) * stddev_pop(x1)) AS c, covar_pop(x0, y) / stddev_pop(x0) AS b0,
             covar_pop(x1, y) / stddev_pop(x1) AS b1 FROM e),
p AS (SELECT * FROM (VALUES {rows}) AS v(model, l1, l2), (VALUES (-1), (0), (1)) AS u(s0), (VALUES (-1), (0), (1)) AS w(s1)),
r AS (SELECT *, b0 - l1 * s0 AS r0, b1 - l1 * s1 AS r1, 1 + l2 AS a FROM p, s),
w AS (SELECT *, CASE WHEN s0 = 0 THEN 0 WHEN s1 = 0 THEN r0 / a ELSE (r0 * a - c * r1) / (a * a - c * c) END AS w0,
             CASE WHEN s1 = 0 THEN 0 WHEN s0 = 0 THEN r1 / a ELSE (r1 * a - c * r0) / (a * a - c * c) END AS w1 FROM r),
k AS (SELECT *, b0 - w0 - c * w1 AS g0, b1 - w1 - c * w0 AS g1 FROM w)
SELECT model, round(w0 / d0 + 0.0, 3) AS weight_0, round(w1 / d1 + 0.0, 3) AS weight_1,
       round(my - w0 * m0 / d0 - w1 * m1 / d1, 1) AS intercept FROM k
WHERE sign(w0) = s0 AND sign(w1) = s1 AND (s0 <> 0 OR abs(g0) <= l1) AND (s1 <> 0 OR abs(g1) <= l1)"""


#: model, l1 and l2 penalty: alpha and l1_ratio follow
TWO_FEATURE_MODELS = [("lasso_light", 50.0, 0.0), ("lasso_heavy", 15000.0, 0.0), ("net", 200.0, 0.3)]


@query("penalised_two_features", _two_features_sql(TWO_FEATURE_MODELS))
def q_penalised_two_features(spark, d):
    """Lasso and elastic net of two features by coordinate descent on the co-moments."""
    from veld.plans.linear_cv import fold_statistics, solve_penalised
    _, train, _ = _train(spark, d)
    train = train.withColumn("unit", F.col("l_extendedprice") / F.col("l_quantity"))
    stats = fold_statistics(train, ["l_quantity", "unit"], LABEL, None)[0]
    rows = []
    for model, l1, l2 in TWO_FEATURE_MODELS:
        c0, v = solve_penalised(stats, l1 + l2, l1 / (l1 + l2))
        rows.append((model, float(v[0]), float(v[1]), float(c0)))
    out = spark.createDataFrame(rows, "model string, w0 double, w1 double, c0 double")
    return out.select("model", r("w0", 3).alias("weight_0"), r("w1", 3).alias("weight_1"), r("c0", 1).alias("intercept"))


# ====================================================================== rows-only models

def _holdout_metrics(spark, d, kind, feats=FEATURES, **params):
    _, train, test = _train(spark, d)
    model, metrics, _ = ev.train_evaluate(train, test, kind, feats, LABEL, cv=False, **params)
    return model, metrics


@query("lasso_fit")
def q_lasso_fit(spark, d):
    return _holdout_metrics(spark, d, "lasso", alpha=10.0)[1]


@query("elastic_net_fit")
def q_elastic_net_fit(spark, d):
    return _holdout_metrics(spark, d, "elastic_net", alpha=1.0, l1_ratio=0.5)[1]


@query("random_forest_fit")
def q_random_forest_fit(spark, d):
    return _holdout_metrics(spark, d, "random_forest", n_estimators=100, max_depth=8,
                            min_samples_leaf=2, max_features="sqrt")[1]


@query("gbt_fit")
def q_gbt_fit(spark, d):
    return _holdout_metrics(spark, d, "gbt", n_estimators=100, max_depth=4, learning_rate=0.1,
                            subsample=0.75)[1]


def _ols3_sql() -> str:
    """Three-feature OLS on the training rows, solved by Cramer's rule on centred sums,
    then train / test metrics: an independent check of the Spark ML linear pipeline."""
    x = FEATURES
    sums = ", ".join([f"avg({c}) AS m{i}" for i, c in enumerate(x)] + ["avg(l_extendedprice) AS my"])
    cov = ", ".join([f"sum((t.{a} - m{i}) * (t.{b} - m{j})) AS s{i}{j}"
                     for i, a in enumerate(x) for j, b in enumerate(x) if i <= j] +
                    [f"sum((t.{a} - m{i}) * (t.l_extendedprice - my)) AS s{i}y" for i, a in enumerate(x)])

    def a(i, j):
        return f"s{min(i, j)}{max(i, j)}"

    def det(c0, c1, c2):
        return (f"(({c0[0]}) * (({c1[1]}) * ({c2[2]}) - ({c2[1]}) * ({c1[2]})) "
                f"- ({c1[0]}) * (({c0[1]}) * ({c2[2]}) - ({c2[1]}) * ({c0[2]})) "
                f"+ ({c2[0]}) * (({c0[1]}) * ({c1[2]}) - ({c1[1]}) * ({c0[2]})))")
    cols = [[a(r, c) for r in range(3)] for c in range(3)]
    rhs = [f"s{r}y" for r in range(3)]
    d = det(*cols)
    w = [det(*[rhs if k == c else cols[k] for k in range(3)]) for c in range(3)]
    pred = "(my + " + " + ".join(f"w{i} * (t.{c} - m{i})" for i, c in enumerate(x)) + ")"
    return f"""
WITH t AS ({MODEL_DATA_SQL}),
m AS (SELECT {sums} FROM t WHERE NOT is_test),
s AS (SELECT m.*, {cov} FROM t, m WHERE NOT t.is_test GROUP BY ALL),
c AS (SELECT s.*, {", ".join(f"{w[i]} / {d} AS w{i}" for i in range(3))} FROM s),
p AS (SELECT CASE WHEN t.is_test THEN 'test' ELSE 'train' END AS phase, t.l_extendedprice AS y,
             {pred} AS pred FROM t, c)
SELECT phase, 'linear' AS model, count(*) AS n, round(sqrt(avg(pow(y - pred, 2))), 4) AS rmse,
       round(1 - sum(pow(y - pred, 2)) / (count(*) * var_pop(y)), 9) AS r2,
       round(avg(abs(y - pred)), 4) AS mae, round(avg(pow(y - pred, 2)), -3) AS mse
FROM p GROUP BY phase"""


@query("train_evaluate", _ols3_sql())
def q_train_evaluate(spark, d):
    """Spark ML pipeline (assembler -> scaler -> OLS) fitted on train, scored on both."""
    _, train, test = _train(spark, d)
    _, metrics, _ = ev.train_evaluate(train, test, "linear", FEATURES, LABEL, cv=False)
    return metrics.select("phase", "model", "n", r("rmse", 4).alias("rmse"), r("r2", 9).alias("r2"),
                          r("mae", 4).alias("mae"), r("mse", -3).alias("mse"))


@query("feature_importance")
def q_feature_importance(spark, d):
    model, _ = _holdout_metrics(spark, d, "random_forest", n_estimators=100, max_depth=8)
    return weights_frame(spark, model, FEATURES, k=10)


@query("oob_score")
def q_oob_score(spark, d):
    """100 bagged trees of depth 8: out-of-bag R^2 and RMSE, and the test rows' for comparison."""
    from veld.plans.forest import fit_forest
    _, train, test = _train(spark, d)
    forest, state = fit_forest(train, FEATURES, LABEL, LI_KEYS, n_estimators=100, max_depth=8, min_samples_split=20, min_samples_leaf=5)
    held = ev.regression_metrics(forest.transform(test), LABEL)
    return forest.out_of_bag(state).crossJoin(held.select(F.col("r2").alias("test_r2"), F.col("rmse").alias("test_rmse")))


@query("linear_weights", f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT 1 AS k, {X3_SQL} FROM t WHERE NOT is_test),
{fit_sql('e', 3)},
s AS (SELECT stddev_samp(x0) AS d0, stddev_samp(x1) AS d1, stddev_samp(x2) AS d2 FROM e)
""" + "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, round(w{i} * d{i}, 4) AS weight FROM fit, s" for i, c in enumerate(FEATURES)))
def q_linear_weights(spark, d):
    """Coefficients of the standardised features, largest first."""
    _, train, _ = _train(spark, d)
    return weights_frame(spark, ev.fit("linear", train, FEATURES, LABEL), FEATURES, k=10).select("feature", r("weight", 4).alias("weight"))


@query("batch_score", f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT 1 AS k, l_orderkey, l_linenumber, l_partkey, l_suppkey, is_test, {X3_SQL} FROM t),
tr AS (SELECT * FROM e WHERE NOT is_test),
{fit_sql('tr', 3)}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({pred_sql(3)}, 2) AS prediction FROM e, fit""")
def q_batch_score(spark, d):
    data, train, _ = _train(spark, d)
    model = make_pipeline("linear", FEATURES, label=LABEL).fit(train)
    path = os.path.join(checkpoint_root(spark), "models", uuid.uuid4().hex[:12])
    io.save_model(model, path)
    loaded = io.load_model(path)
    return loaded.transform(data).select(*LI_KEYS, r("prediction", 2).alias("prediction"))


@query("model_roundtrip", "SELECT count(*) AS n, CAST(0 AS DOUBLE) AS max_abs_diff FROM lineitem")
def q_model_roundtrip(spark, d):
    data, train, _ = _train(spark, d)
    model = make_pipeline("linear", FEATURES, label=LABEL).fit(train)
    path = os.path.join(checkpoint_root(spark), "models", uuid.uuid4().hex[:12])
    io.save_model(model, path)
    loaded = io.load_model(path)
    both = loaded.transform(model.transform(data).select(*FEATURES, F.col("prediction").alias("p1")))
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p1") - F.col("prediction"))).alias("max_abs_diff"))


RIDGE_SPACE = {"alpha": [round(0.0001 + i * (1 - 0.0001) / 9, 6) for i in range(10)],
               "fit_intercept": [True, False]}


RIDGE_CANDIDATES = ev.sample_params(RIDGE_SPACE, n_iter=10, seed=42)


@query("random_search", f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT fold, {X3_SQL} FROM t WHERE NOT is_test),
tr AS (SELECT f.k, x0, x1, x2, y FROM e JOIN (SELECT DISTINCT fold AS k FROM e) f ON e.fold <> f.k),
{fit_sql('tr', 3, ", ".join(f"({j}, {c['alpha']})" for j, c in enumerate(RIDGE_CANDIDATES)))},
c AS (SELECT * FROM (VALUES {", ".join(f"({j}, {c['alpha']}, {c['fit_intercept']})" for j, c in enumerate(RIDGE_CANDIDATES))}) AS v(candidate, penalty, intercept)),
s AS (SELECT candidate, penalty, intercept, fold,
             1 - sum(pow(y - {pred_sql(3)} + CASE WHEN intercept THEN 0 ELSE my END, 2)) / (count(*) * var_pop(y)) AS r2
      FROM e JOIN fit ON e.fold = fit.k JOIN c ON fit.model = c.candidate GROUP BY ALL)
SELECT 'ridge' AS model, CAST(candidate AS INTEGER) AS candidate, CAST(penalty AS DOUBLE) AS alpha, intercept AS fit_intercept,
       round(avg(r2), 6) AS mean_r2, round(stddev_pop(r2), 6) AS std_r2 FROM s GROUP BY ALL""")
def q_random_search(spark, d):
    """Ten of the ridge candidates, six folds, from one fused aggregation (V4)."""
    _, train, _ = _train(spark, d)
    res = ev.random_search(train, "ridge", FEATURES, LABEL, RIDGE_CANDIDATES, "fold")
    return res.select("model", "candidate", F.col("params")["alpha"].cast("double").alias("alpha"),
                      (F.col("params")["fit_intercept"] == "True").alias("fit_intercept"),
                      r("mean_r2").alias("mean_r2"), r("std_r2").alias("std_r2"))


PATH_ALPHAS = [round(10.0 ** (k / 2), 4) for k in range(-4, 9)]
PATH_RATIOS = [0.1, 0.3, 0.5, 0.7, 0.9, 1.0]


@query("penalised_search")
def q_penalised_search(spark, d):
    """Elastic net over 13 penalties, 6 ratios (1 is the lasso) and 6 folds: 468 fits from one scan."""
    _, train, _ = _train(spark, d)
    cands = [{"alpha": a, "l1_ratio": q} for q in PATH_RATIOS for a in PATH_ALPHAS]
    res = ev.random_search(train, "elastic_net", FEATURES, LABEL, cands, "fold")
    return res.select("candidate", F.col("params")["alpha"].cast("double").alias("alpha"),
                      F.col("params")["l1_ratio"].cast("double").alias("l1_ratio"), "mean_r2", "std_r2")


@query("adaptive_search")
def q_adaptive_search(spark, d):
    """60 elastic-net trials of a Parzen estimator over the reference's continuous ranges, six folds, one scan (V5)."""
    from veld.plans.adaptive import adaptive_linear_search
    from veld.plans.flow import ELASTIC_NET_SPACE
    _, train, _ = _train(spark, d)
    res = adaptive_linear_search(train, "elastic_net", FEATURES, LABEL, ELASTIC_NET_SPACE, "fold", 60)
    return res.select("candidate", F.col("params")["alpha"].cast("double").alias("alpha"),
                      F.col("params")["l1_ratio"].cast("double").alias("l1_ratio"), "mean_r2", "std_r2", "folds", "stopped")


def _stump_sql() -> str:
    """The best single split by second-order gain, over the same quantile cuts, tried one by one."""
    probs = ", ".join(str(k / 64) for k in range(1, 64))
    return f"""
WITH t AS ({MODEL_DATA_SQL}), e AS (SELECT {X3_SQL} FROM t WHERE NOT is_test),
l AS (SELECT 0 AS f, x0 AS x, y FROM e UNION ALL SELECT 1, x1, y FROM e UNION ALL SELECT 2, x2, y FROM e),
q AS (SELECT f, quantile_cont(x, [{probs}]) AS qs FROM l GROUP BY f),
c AS (SELECT DISTINCT f, cut FROM (SELECT f, unnest(qs) AS cut FROM q)),
b AS (SELECT avg(y) AS base, count(*) AS n FROM e),
s AS (SELECT c.f, c.cut, sum(base - y) FILTER (WHERE x <= cut) AS gl, count(*) FILTER (WHERE x <= cut) AS hl,
             sum(base - y) FILTER (WHERE x > cut) AS gr, count(*) FILTER (WHERE x > cut) AS hr
      FROM c JOIN l ON c.f = l.f, b GROUP BY ALL),
w AS (SELECT *, 0.5 * (gl * gl / (hl + 2.0) + gr * gr / (hr + 2.0)) AS gain FROM s WHERE hl >= 5 AND hr >= 5)
SELECT CASE f WHEN 0 THEN '{FEATURES[0]}' WHEN 1 THEN '{FEATURES[1]}' ELSE '{FEATURES[2]}' END AS feature, round(cut, 6) AS cut,
       round(gain / 1e6, 0) AS gain_millions, round(-0.5 * gl / (hl + 2.0), 3) AS left_value, round(-0.5 * gr / (hr + 2.0), 3) AS right_value
FROM w ORDER BY gain DESC LIMIT 1"""


@query("boosted_stump", _stump_sql())
def q_boosted_stump(spark, d):
    """One boosted tree of depth 1: its split, gain and leaf values."""
    from veld.plans.boost import fit_boosted
    _, train, _ = _train(spark, d)
    params = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.5, "reg_lambda": 2.0, "min_child_weight": 5}
    model = fit_boosted(train, FEATURES, LABEL, LI_KEYS, [params])[0][0]
    tree = model.trees[0]
    f = int(tree.feature[0])
    row = (FEATURES[f], float(model.cuts[f][tree.cut[0]]), float(tree.gain[0]), float(tree.value[1]), float(tree.value[2]))
    out = spark.createDataFrame([row], "feature string, cut double, gain double, left double, right double")
    return out.select("feature", r("cut").alias("cut"), F.round(F.col("gain") / 1e6, 0).alias("gain_millions"),
                      r("left", 3).alias("left_value"), r("right", 3).alias("right_value"))


#: Trials and rounds of the registered query: the reference's.
WORKFLOW_TRIALS, WORKFLOW_ROUNDS = 100, 100


@query("boosted_workflow")
def q_boosted_workflow(spark, d):
    """Second-order boosting: trials from the reference's ranges on six folds, all grown together ->
    final fit with early stopping -> test metrics and gain importances (V6)."""
    from veld.plans.boost import boosted_workflow
    _, train, test = _train(spark, d)
    out = boosted_workflow(train, FEATURES, LABEL, LI_KEYS, "fold", WORKFLOW_TRIALS, WORKFLOW_ROUNDS)
    model = out["model"]
    m = ev.regression_metrics(model.transform(test), LABEL)
    weights = spark.createDataFrame(model.importance(), "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(10)
    return m.select(F.lit(out["best"]["candidate"]).alias("candidate"), F.lit(model.best_iteration).alias("trees"),
                    "n", "rmse", "r2", "mae", "mse").crossJoin(weights)


# ====================================================================== listing flows

@query("listing_prep")
def q_listing_prep(spark, d):
    """Stage A on customers shaped as raw listings: cleaning, province, fallback lookup,
    proximity, subtype regroup, recodes, fills, target encoding, clipping, bounds."""
    from veld.operators.geo import lookup_table
    from veld.plans.flow import prepare_listings
    from veld.plans.inputs import listings_full, lookup_raw
    return prepare_listings(listings_full(spark, d), lookup_table(lookup_raw(spark, d))).data


#: Draws of the registered listing searches: the reference's ten of each model.
LISTING_DRAWS = {"linear": 10, "ridge": 10, "lasso": 10, "random_forest": 10, "gbt": 10}


@query("listing_train")
def q_listing_train(spark, d):
    """Stage B on the prepared listings: correlation select, random search over the five
    model kinds, best model (first wins ties), refit; the search table is returned."""
    from veld.operators.geo import lookup_table
    from veld.plans.flow import prepare_listings, train_models
    from veld.plans.inputs import listings_full, lookup_raw
    prep = prepare_listings(listings_full(spark, d), lookup_table(lookup_raw(spark, d))).data
    out = train_models(prep.where(~F.col("is_test")), "Price", 0.2, n_iter=LISTING_DRAWS)
    return out["results"].select("model", "candidate", "params", "mean_r2", "std_r2")


@query("listing_score")
def q_listing_score(spark, d):
    """Stage C: the refit best model of all kinds scores the held-out listings."""
    from veld.operators.geo import lookup_table
    from veld.plans.flow import prepare_listings, score, train_models
    from veld.plans.inputs import listings_full, lookup_raw
    prep = prepare_listings(listings_full(spark, d), lookup_table(lookup_raw(spark, d))).data
    out = train_models(prep.where(~F.col("is_test")), "Price", 0.2, n_iter=LISTING_DRAWS)
    scored = score(out["model"], prep.where(F.col("is_test")))
    return scored.select("id", F.col("Price").alias("actual"), "prediction")


@query("prep_model_stages")
def q_prep_model_stages(spark, d):
    """One persisted PipelineModel: mode imputer -> quantile clipper -> target-mean encoder
    -> assembler -> OLS, fitted on the training orders, saved, loaded, scoring all orders."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from veld.operators.stages import QuantileClipper, StatImputer, TargetMeanEncoder
    from veld.plans.inputs import orders_n
    o = orders_n(spark, d).withColumn("is_test", select.split_flag(["o_orderkey"], 0.2, 42))
    pipe = Pipeline(stages=[
        StatImputer(inputCols=["o_orderpriority"], strategy="mode"),
        QuantileClipper(inputCols=["o_totalprice"], lower=[0.05], upper=[0.95]),
        TargetMeanEncoder(inputCols=["o_orderpriority", "o_orderstatus"], labelCol="o_totalprice"),
        VectorAssembler(inputCols=["o_orderpriority_encoded", "o_orderstatus_encoded"],
                        outputCol="features", handleInvalid="keep"),
        LinearRegression(featuresCol="features", labelCol="o_totalprice", solver="normal")])
    model = pipe.fit(o.where(~F.col("is_test")))
    path = os.path.join(checkpoint_root(spark), "models", uuid.uuid4().hex[:12])
    model.write().overwrite().save(path)
    return PipelineModel.load(path).transform(o).select("o_orderkey", "is_test", "prediction")
