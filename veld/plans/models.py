"""Regressors as ``pyspark.ml`` pipelines.

``make_pipeline(kind, features, **params)`` gives ``VectorAssembler -> StandardScaler ->
regressor`` with sklearn-style parameters converted to Spark's:

* linear: ``regParam=0``, normal-equation solver.
* ridge ``alpha``: sklearn minimises ``||y-Xw||^2 + alpha ||w||^2``; Spark scales the
  label by its std internally and averages the loss, so ``regParam = alpha * sd(y) / n``
  (population sd with the normal solver, sample sd with l-bfgs).
* lasso ``alpha``: both minimise ``1/(2n)||y-Xw||^2 + alpha ||w||_1`` -> ``regParam=alpha``.
* elastic net ``alpha, l1_ratio``: ``l1 = alpha*l1_ratio``, ``l2 = alpha*(1-l1_ratio)*sd(y)``,
  ``regParam = l1 + l2``, ``elasticNetParam = l1 / regParam``.
* random forest / gradient-boosted trees: ``veld.plans.tree_stages``, with Spark ML's meaning of the
  parameters (boosting with validation rows: Spark ML's own); its deepest tree has 30 levels, which
  is what "no limit" means here; a deeper one raises.

Penalties refer to features scaled by their population std; Spark's scaler divides by the
sample std, so ``make_pipeline`` converts: ``l1`` by ``sqrt((n-1)/n)``, ``l2`` by ``(n-1)/n``.

``sd(y)`` and ``n`` depend on the training rows, so they are passed in (``label_stats``)
and recomputed per fold by the search code.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TREE_DEPTH = 30
MODEL_KINDS = ("linear", "ridge", "lasso", "elastic_net", "random_forest", "gbt")


def label_stats(df: DataFrame, label: str) -> dict:
    r = df.agg(F.count(F.col(label)).alias("n"),
               F.stddev_pop(F.col(label).cast("double")).alias("sd_pop"),
               F.stddev_samp(F.col(label).cast("double")).alias("sd_samp")).first()
    return {"n": r["n"], "sd_pop": r["sd_pop"] or 0.0, "sd_samp": r["sd_samp"] or 0.0}


def _depth(d):
    if d is not None and int(d) > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {d}: Spark grows trees of at most {MAX_TREE_DEPTH} levels")
    return MAX_TREE_DEPTH if d is None else int(d)


def make_regressor(kind: str, label: str = "label", features: str = "features",
                   stats: dict | None = None, seed: int = 42, scaled: bool = False, **p):
    common = dict(labelCol=label, featuresCol=features, predictionCol="prediction")
    if kind == "linear":
        return LinearRegression(regParam=0.0, solver="normal", standardization=False,
                                fitIntercept=p.get("fit_intercept", True), **common)
    if kind in ("ridge", "lasso", "elastic_net"):
        if stats is None:
            raise ValueError(f"{kind} needs label_stats of the training rows")
        alpha = float(p.get("alpha", 1.0))
        # scaled: features were divided by their sample std, penalties mean the population std
        shrink = (stats["n"] - 1) / stats["n"] if scaled and stats["n"] > 1 else 1.0
        fit_intercept = p.get("fit_intercept", True)
        if kind == "ridge":
            reg = shrink * alpha * stats["sd_pop"] / max(1, stats["n"])
            return LinearRegression(regParam=reg, elasticNetParam=0.0, solver="normal",
                                    standardization=False, fitIntercept=fit_intercept, **common)
        if kind == "lasso":
            return LinearRegression(regParam=shrink ** 0.5 * alpha, elasticNetParam=1.0, solver="l-bfgs",
                                    standardization=False, fitIntercept=fit_intercept,
                                    maxIter=p.get("max_iter", 1000), tol=1e-9, **common)
        l1r = float(p.get("l1_ratio", 0.5))
        l1, l2 = shrink ** 0.5 * alpha * l1r, shrink * alpha * (1 - l1r) * stats["sd_samp"]
        reg = l1 + l2
        return LinearRegression(regParam=reg, elasticNetParam=(l1 / reg if reg else 0.0),
                                solver="l-bfgs", standardization=False, fitIntercept=fit_intercept,
                                maxIter=p.get("max_iter", 1000), tol=1e-9, **common)
    if kind == "random_forest":
        from veld.plans.tree_stages import TreesRegressor     # its growers import this module's users
        mf = p.get("max_features", "sqrt")
        mf = {"auto": "sqrt", None: "all", 1.0: "all"}.get(mf, mf)
        return TreesRegressor(kind="forest", settings=json.dumps(
            {"n_estimators": int(p.get("n_estimators", 100)), "max_depth": _depth(p.get("max_depth", 10)),
             "min_samples_leaf": int(p.get("min_samples_leaf", 1)), "max_features": str(mf),
             "bootstrap": bool(p.get("bootstrap", True))}), seed=seed, **common)
    if kind == "gbt":
        cs = float(p.get("colsample_bytree", 1.0))
        trees, depth, rate = int(p.get("n_estimators", 100)), _depth(p.get("max_depth", 3)), float(p.get("learning_rate", 0.1))
        subsample, least = float(p.get("subsample", 1.0)), int(p.get("min_child_weight", 1))
        if p.get("validation_col"):
            # early stopping: rows flagged in validation_col are held out and boosting
            # stops once their error improves by less than validation_tol
            return GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
                                featureSubsetStrategy=("all" if cs >= 1.0 else str(cs)), minInstancesPerNode=least, seed=seed,
                                validationIndicatorCol=p["validation_col"],
                                validationTol=float(p.get("validation_tol", 0.01)), **common)
        from veld.plans.tree_stages import TreesRegressor
        return TreesRegressor(kind="boosted", settings=json.dumps(
            {"n_estimators": trees, "max_depth": depth, "learning_rate": rate, "subsample": subsample,
             "colsample_bynode": cs, "min_child_weight": least}), seed=seed, **common)
    raise ValueError(f"unknown model kind {kind!r}; one of {MODEL_KINDS}")


def make_pipeline(kind: str, features: Sequence[str], label: str = "label",
                  stats: dict | None = None, scale: bool = True, seed: int = 42, **params
                  ) -> Pipeline:
    """Assembler (NULL feature -> error, like sklearn) -> scaler -> regressor."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw" if scale else "features",
                              handleInvalid="error")]
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features",
                                     withMean=True, withStd=True))
    stages.append(make_regressor(kind, label=label, stats=stats, seed=seed, scaled=scale, **params))
    return Pipeline(stages=stages)


def weights_table(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """``(feature, weight)`` - coefficients of a linear model or tree importances."""
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        w = last.coefficients.toArray().tolist()
    elif hasattr(last, "featureImportances"):
        w = last.featureImportances.toArray().tolist()
    else:
        raise ValueError("model has neither coefficients nor importances")
    return list(zip(features, w))


def weights_frame(spark, model, features: Sequence[str], k: int | None = None) -> DataFrame:
    """Weights as a DataFrame, largest first; ``k`` keeps the top-k (K1)."""
    df = spark.createDataFrame(weights_table(model, features), "feature string, weight double")
    df = df.orderBy(F.desc("weight"), "feature")
    return df.limit(k) if k else df
