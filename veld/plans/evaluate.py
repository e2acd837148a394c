"""Metrics, cross-validation, random search and model choice (V1-V8, K2, K5)."""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Mapping, Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veld.plans.linear_cv import LINEAR_KINDS, cross_validate_linear
from veld.plans.models import label_stats, make_pipeline


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction"
                       ) -> DataFrame:
    """RMSE, R^2, MAE, MSE and n in one aggregation (V1).

    R^2 = 1 - SSE / SST with SST = n * var_pop(y); NULL for a constant label.  All are over
    complete pairs: a row whose label or prediction is NULL counts in none of them.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    y = F.when(e.isNotNull(), y)
    agg = pred.agg(F.count(e).alias("n"), F.sum(e * e).alias("_sse"),
                   F.sum(F.abs(e)).alias("_sae"), F.var_pop(y).alias("_vy"))
    return agg.select(
        "n",
        F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_vy"))).alias("r2"),
        (F.col("_sae") / F.col("n")).alias("mae"),
        (F.col("_sse") / F.col("n")).alias("mse"))


def regression_metrics_by(pred: DataFrame, group: str, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """``regression_metrics`` per value of ``group`` (e.g. train / test) in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    y = F.when(e.isNotNull(), y)
    agg = pred.groupBy(group).agg(F.count(e).alias("n"), F.sum(e * e).alias("_sse"),
                                  F.sum(F.abs(e)).alias("_sae"), F.var_pop(y).alias("_vy"))
    return agg.select(
        group, "n",
        F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_vy"))).alias("r2"),
        (F.col("_sae") / F.col("n")).alias("mae"),
        (F.col("_sse") / F.col("n")).alias("mse"))


def fit(kind: str, train: DataFrame, features: Sequence[str], label: str, seed: int = 42,
        **params):
    stats = label_stats(train, label) if kind in ("ridge", "lasso", "elastic_net") else None
    return make_pipeline(kind, features, label=label, stats=stats, seed=seed, **params).fit(train)


def cross_validate(data: DataFrame, kind: str, features: Sequence[str], label: str,
                   fold: str = "fold", k: int | None = None, seed: int = 42,
                   name: str | None = None, parallelism: int = 4, **params) -> DataFrame:
    """Per-fold R^2 ``(model, fold, r2)``: fit on ``fold != i``, score ``fold == i`` (V2).

    Linear, ridge, lasso and elastic-net models go through the fused path of ``veld.plans.linear_cv`` (one
    grouped aggregation for all folds).  Other models fit one distributed Spark ML job
    per fold, submitted from ``parallelism`` driver threads (as ``CrossValidator`` does).
    Folds come from ``veld.operators.select.fold_column``: fixed by key, not partition.
    ``k`` given explicitly forces the per-fold Spark ML path.
    """
    spark = data.sparkSession
    if kind in LINEAR_KINDS and k is None:
        cand = dict(params, kind=kind)
        return cross_validate_linear(data, features, label, fold, [cand], [name or kind]) \
            .select("model", "fold", "r2")
    if k is None:
        k = data.agg(F.max(fold)).first()[0] + 1

    def one(i):
        tr, te = data.where(F.col(fold) != i), data.where(F.col(fold) == i)
        m = fit(kind, tr, features, label, seed=seed, **params)
        return (name or kind, i, regression_metrics(m.transform(te), label).first()["r2"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(one, range(k)))
    return spark.createDataFrame(rows, "model string, fold int, r2 double")


def train_evaluate(train: DataFrame, test: DataFrame, kind: str, features: Sequence[str],
                   label: str, fold: str = "fold", seed: int = 42, cv: bool = True, **params):
    """Cross-validate on train, fit on train, metrics on train and test (V3)."""
    cvs = cross_validate(train, kind, features, label, fold, seed=seed, **params) if cv else None
    model = fit(kind, train, features, label, seed=seed, **params)
    m_tr = regression_metrics(model.transform(train), label).withColumn("phase", F.lit("train"))
    m_te = regression_metrics(model.transform(test), label).withColumn("phase", F.lit("test"))
    return model, m_tr.unionByName(m_te).withColumn("model", F.lit(kind)), cvs


def sample_params(space: Mapping[str, Sequence], n_iter: int = 10, seed: int = 42) -> list[dict]:
    """Seeded sample without replacement from the grid (``RandomizedSearchCV`` lists) (V4)."""
    keys = list(space)
    grid = [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]
    if len(grid) <= n_iter:
        return grid
    return random.Random(seed).sample(grid, n_iter)


def sample_continuous(space: Mapping[str, tuple], n_iter: int = 10, seed: int = 42) -> list[dict]:
    """Uniform / log-uniform / integer draws: ``{"name": ("uniform"|"log"|"int", lo, hi)}`` (V5)."""
    import math
    rnd = random.Random(seed)
    out = []
    for _ in range(n_iter):
        d = {}
        for name, (kind, lo, hi) in space.items():
            if kind == "uniform":
                d[name] = rnd.uniform(lo, hi)
            elif kind == "log":
                d[name] = math.exp(rnd.uniform(math.log(lo), math.log(hi)))
            elif kind == "int":
                d[name] = rnd.randint(lo, hi)
            else:
                raise ValueError(kind)
        out.append(d)
    return out


def random_search(data: DataFrame, kind: str, features: Sequence[str], label: str,
                  candidates: Sequence[dict], fold: str = "fold", seed: int = 42,
                  parallelism: int = 8) -> DataFrame:
    """Mean CV R^2 per candidate ``(model, candidate, params, mean_r2, std_r2)`` (V4, V5).

    Linear, ridge, lasso and elastic-net candidates are all scored from one fused aggregation
    (``veld.plans.linear_cv``).  Tree models of all folds are binned together and grown on the same
    written rows (``veld.plans.tree_search``).  Others fit one Spark ML job per (candidate, fold), all submitted
    from ``parallelism`` driver threads; penalised fits recompute the label sd of each training fold.
    """
    spark = data.sparkSession
    if kind in LINEAR_KINDS:
        cv = cross_validate_linear(data, features, label, fold,
                                   [dict(p, kind=kind) for p in candidates])
        summ = {r["candidate"]: r for r in cv.groupBy("candidate").agg(
            F.avg("r2").alias("m"), F.stddev_pop("r2").alias("s")).collect()}
        rows = [(kind, j, {k: str(v) for k, v in p.items()}, summ[j]["m"], summ[j]["s"])
                for j, p in enumerate(candidates)]
        return spark.createDataFrame(
            rows, "model string, candidate int, params map<string,string>, mean_r2 double, std_r2 double")
    k = data.agg(F.max(fold)).first()[0] + 1

    def one(job):
        j, i = job
        params = candidates[j]
        tr, te = data.where(F.col(fold) != i), data.where(F.col(fold) == i)
        m = fit(kind, tr, features, label, seed=seed, **params)
        return j, regression_metrics(m.transform(te), label).first()["r2"]

    from veld.plans.tree_search import shares_bins, tree_scores     # its growers import this module
    if shares_bins(kind, candidates):
        scores = tree_scores(data, kind, features, label, candidates, fold, k, seed, parallelism)
    else:
        # every (candidate, fold) fit is an independent Spark job: submit them together
        jobs = [(j, i) for j in range(len(candidates)) for i in range(k)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            scores = list(pool.map(one, jobs))
    rows = []
    for j, params in enumerate(candidates):
        r2s = [r for jj, r in scores if jj == j]
        scored = r2s and None not in r2s         # a fold without a score leaves none
        mean = sum(r2s) / len(r2s) if scored else None
        std = (sum((r - mean) ** 2 for r in r2s) / len(r2s)) ** 0.5 if scored else None
        rows.append((kind, j, {kk: str(v) for kk, v in params.items()}, mean, std))
    return spark.createDataFrame(
        rows, "model string, candidate int, params map<string,string>, mean_r2 double, std_r2 double")


def best_of(results: DataFrame, score: str = "mean_r2", order: str | Sequence[str] = "candidate") -> DataFrame:
    """The row with the highest score; the earliest one wins ties (strict ``>``) (K2, V7)."""
    order = [order] if isinstance(order, str) else list(order)
    return results.orderBy(F.desc_nulls_last(score), *order).limit(1)


def metrics_report(metrics: DataFrame) -> DataFrame:
    """``(model, phase, metric, value)`` from rows of ``train_evaluate`` metrics (V8)."""
    names = ("rmse", "r2", "mae", "mse")
    return metrics.select("model", "phase", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])))


def sample_residuals(pred: DataFrame, key: Sequence[str], n: int = 1, seed: int = 42,
                     label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Seeded sample of ``n`` rows with prediction, actual and difference (K5)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("\u0001", *[F.col(k).cast("string") for k in key])))
    return (pred.withColumn("_h", h).orderBy("_h").limit(n)
            .select(*key, F.col(prediction).alias("predicted"), F.col(label).alias("actual"),
                    (F.col(prediction) - F.col(label)).alias("difference")))


def r2_evaluator(label: str = "label") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")


def refit_best(spark: SparkSession, data: DataFrame, best_row, features: Sequence[str],
               label: str, seed: int = 42):
    """Refit the chosen model and parameters on all rows (V7)."""
    params = {k: _parse(v) for k, v in (best_row["params"] or {}).items()}
    return fit(best_row["model"], data, features, label, seed=seed, **params)


def _parse(v: str):
    for cast in (int, float):
        try:
            return cast(v)
        except ValueError:
            pass
    return {"True": True, "False": False, "None": None}.get(v, v)
