"""Fused k-fold cross-validation for linear models (linear, ridge, lasso, elastic net).

A per-fold fit of ``StandardScaler -> LinearRegression / Ridge`` only needs the fold's
sufficient statistics: count, means and centred co-moments (``p x p`` at most).  One
``groupBy(fold)`` aggregation of Spark's stable ``avg`` / ``covar_pop`` / ``var_pop``
gives them for every fold; the training statistics of fold ``i`` are the total minus
fold ``i`` (parallel-axis theorem).  Every fold and every candidate penalty is then solved
from those numbers, and the held-out SSE of fold ``i`` comes from fold ``i``'s own
moments - so a search over ``c`` candidates with ``k`` folds costs one scan instead of
``c x k`` fits.

Semantics follow the sklearn pipeline of the reference: features standardised with the
*training* fold's mean and population std (a constant feature keeps scale 1), ridge
penalty ``alpha ||w||^2`` on the standardised coefficients, OLS by least squares
(minimum-norm when singular), ``fit_intercept=False`` drops the intercept after centring.
Lasso and elastic net need no more than the same co-moments: coordinate descent in its
covariance form runs on the ``p x p`` matrix of each training fold, so every fold, ``alpha`` and
``l1_ratio`` of a search comes from the one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINEAR_KINDS = ("linear", "ridge", "lasso", "elastic_net")
MAX_AGGS = 400


def fold_statistics(df: DataFrame, features: Sequence[str], label: str, fold: str | None
                    ) -> dict[int, dict]:
    """``{fold: {n, mx, my, cxx, cxy, cyy}}``: count, means and *centred* co-moments.

    One aggregation with Spark's numerically stable ``avg`` / ``covar_pop`` / ``var_pop``
    (online co-moment updates, no raw sums of squares).  A missing feature or
    label raises, as a Spark ML fit does.  ``fold=None`` aggregates all rows as fold 0.
    """
    feats = list(features)
    p = len(feats)
    xs = [F.col(c).cast("double") for c in feats]
    y = F.col(label).cast("double")
    complete = y.isNotNull()
    for x in xs:
        complete = complete & x.isNotNull()
    aggs = [F.count(F.lit(1)).alias("n"), F.count(F.when(~complete, 1)).alias("missing"), F.avg(y).alias("my"), F.var_pop(y).alias("vy")]
    aggs += [F.avg(xs[i]).alias(f"mx{i}") for i in range(p)]
    aggs += [F.covar_pop(xs[i], y).alias(f"cxy{i}") for i in range(p)]
    aggs += [(F.var_pop(xs[i]) if i == j else F.covar_pop(xs[i], xs[j])).alias(f"cxx{i}_{j}")
             for i in range(p) for j in range(i, p)]
    key = F.col(fold) if fold is not None else F.lit(0)
    # wide feature sets: several passes of at most MAX_AGGS statistics keep codegen in bounds
    merged: dict[int, dict] = {}
    for start in range(0, len(aggs), MAX_AGGS):
        for r in df.groupBy(key.alias("_fold")).agg(*aggs[start:start + MAX_AGGS]).collect():
            merged.setdefault(int(r["_fold"]), {}).update(r.asDict())
    missing = sum(r["missing"] for r in merged.values())
    if missing:
        raise ValueError(f"{missing} rows lack a feature or the label: fill or drop them first")
    out = {}
    for k, r in merged.items():
        n = float(r["n"])
        cxx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                cxx[i, j] = cxx[j, i] = n * r[f"cxx{i}_{j}"]
        out[k] = {"n": n, "my": r["my"], "cyy": n * r["vy"],
                  "mx": np.array([r[f"mx{i}"] for i in range(p)]),
                  "cxy": np.array([n * r[f"cxy{i}"] for i in range(p)]), "cxx": cxx}
    return out


def _merge(a: dict, b: dict) -> dict:
    """Statistics of the union of two disjoint row sets (parallel-axis theorem)."""
    n = a["n"] + b["n"]
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    f = a["n"] * b["n"] / n
    return {"n": n, "mx": a["mx"] + dx * b["n"] / n, "my": a["my"] + dy * b["n"] / n,
            "cxx": a["cxx"] + b["cxx"] + f * np.outer(dx, dx),
            "cxy": a["cxy"] + b["cxy"] + f * dx * dy, "cyy": a["cyy"] + b["cyy"] + f * dy * dy}


def _minus(total: dict, part: dict) -> dict:
    """Statistics of ``total`` without the rows of ``part`` (inverse of ``_merge``)."""
    n = total["n"] - part["n"]
    mx = (total["n"] * total["mx"] - part["n"] * part["mx"]) / n
    my = (total["n"] * total["my"] - part["n"] * part["my"]) / n
    dx, dy = part["mx"] - mx, part["my"] - my
    f = n * part["n"] / total["n"]
    return {"n": n, "mx": mx, "my": my, "cxx": total["cxx"] - part["cxx"] - f * np.outer(dx, dx),
            "cxy": total["cxy"] - part["cxy"] - f * dx * dy,
            "cyy": total["cyy"] - part["cyy"] - f * dy * dy}


def _sum(stats: Sequence[dict]) -> dict:
    out = stats[0]
    for s_ in stats[1:]:
        out = _merge(out, s_)
    return out


def solve(train: dict, alpha: float = 0.0, fit_intercept: bool = True, scale: bool = True
          ) -> tuple[float, np.ndarray]:
    """``(c0, v)`` with prediction ``c0 + v . x`` in the data's own units."""
    n, mx, my, cxx, cxy = train["n"], train["mx"], train["my"], train["cxx"], train["cxy"]
    if not fit_intercept and not scale:
        # plain least squares through the origin: raw second moments from centred ones
        a = cxx + n * np.outer(mx, mx)
        b = cxy + n * mx * my
        w = np.linalg.solve(a + alpha * np.eye(len(b)), b) if alpha > 0 else \
            np.linalg.lstsq(a, b, rcond=None)[0]
        return 0.0, w
    if scale:
        sd = np.sqrt(np.maximum(np.diag(cxx) / n, 0.0))
        sd[sd == 0] = 1.0
    else:
        sd = np.ones(len(mx))
    a = cxx / np.outer(sd, sd)
    b = cxy / sd
    w = np.linalg.solve(a + alpha * np.eye(len(b)), b) if alpha > 0 else \
        np.linalg.lstsq(a, b, rcond=None)[0]
    v = w / sd
    # with an intercept the fit passes through the training means; without one (after
    # centring x) the prediction is v.(x - mean_x)
    c0 = (my if fit_intercept else 0.0) - float(v @ mx)
    return c0, v


def solve_penalised(train: dict, alpha: float, l1_ratio: float = 1.0, fit_intercept: bool = True,
                    start: np.ndarray | None = None, tol: float = 1e-10, max_rounds: int = 100_000) -> tuple[float, np.ndarray]:
    """Lasso (``l1_ratio=1``) or elastic net: ``(c0, v)`` as ``solve`` gives it.

    Minimises ``1/(2n) |y - Xw|^2 + alpha l1_ratio |w|_1 + alpha (1 - l1_ratio) / 2 |w|^2`` over
    features standardised by mean and population std, one coefficient at a time by soft
    threshold.  It ends when no optimality condition is off by more than ``tol`` times the largest
    covariance with the label; reaching ``max_rounds`` raises.  ``start`` warm-starts a path.
    """
    n, mx, my = train["n"], train["mx"], train["my"]
    sd = np.sqrt(np.maximum(np.diag(train["cxx"]) / n, 0.0))
    sd[sd == 0] = 1.0
    a, b = train["cxx"] / np.outer(sd, sd) / n, train["cxy"] / sd / n
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    w = np.zeros(len(b)) if start is None else start * sd
    grad = b - a @ w                                    # covariance of each feature with the residual
    scale = max(float(np.abs(b).max(initial=0.0)), np.finfo(float).tiny)
    curve = np.diag(a) + l2
    for _ in range(max_rounds):
        if optimality_gap(grad, w, l1, l2) <= tol * scale:
            v = w / sd
            return (my if fit_intercept else 0.0) - float(v @ mx), v
        for j in np.flatnonzero(curve > 0):
            z = grad[j] + a[j, j] * w[j]
            new = np.sign(z) * max(abs(z) - l1, 0.0) / curve[j]
            if new != w[j]:
                grad -= a[:, j] * (new - w[j])
                w[j] = new
    raise RuntimeError(f"coordinate descent did not settle in {max_rounds} rounds (alpha={alpha}, l1_ratio={l1_ratio})")


def optimality_gap(grad: np.ndarray, w: np.ndarray, l1: float, l2: float) -> float:
    """The largest violation of the subgradient conditions."""
    held = np.abs(grad - l2 * w - l1 * np.sign(w))
    zero = np.maximum(np.abs(grad) - l1, 0.0)
    return float(np.where(w != 0, held, zero).max(initial=0.0))


def solve_kind(kind: str, train: dict, params: dict, start: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """``(c0, v)`` of a model kind with the reference's parameter names."""
    intercept = params.get("fit_intercept", True)
    if kind in ("lasso", "elastic_net"):
        return solve_penalised(train, float(params.get("alpha", 1.0)),
                               1.0 if kind == "lasso" else float(params.get("l1_ratio", 0.5)), intercept, start)
    alpha = float(params.get("alpha", 0.0)) if kind == "ridge" else 0.0
    return solve(train, alpha, intercept, params.get("scale", True))


def sse(test: dict, c0: float, v: np.ndarray) -> float:
    """``sum (y - c0 - v.x)^2`` over a fold from its own means and co-moments."""
    bias = test["my"] - c0 - float(v @ test["mx"])
    return float(test["cyy"] - 2 * v @ test["cxy"] + v @ test["cxx"] @ v + test["n"] * bias * bias)


def r2_of(test: dict, c0: float, v: np.ndarray) -> float | None:
    return None if test["cyy"] <= 0 else 1.0 - sse(test, c0, v) / test["cyy"]


def cross_validate_linear(df: DataFrame, features: Sequence[str], label: str, fold: str,
                          candidates: Sequence[dict], names: Sequence[str] | None = None
                          ) -> DataFrame:
    """``(model, candidate, fold, r2)`` for every candidate ``{kind, alpha, l1_ratio, fit_intercept}``."""
    stats = fold_statistics(df, features, label, fold)
    total = _sum(list(stats.values()))
    rows = []
    for j, cand in enumerate(candidates):
        kind = cand.get("kind", "linear")
        if kind not in LINEAR_KINDS:
            raise ValueError(f"fused CV handles {LINEAR_KINDS}, not {kind!r}")
        for k in sorted(stats):
            c0, v = solve_kind(kind, _minus(total, stats[k]), cand)
            rows.append(((names[j] if names else kind), j, k, r2_of(stats[k], c0, v)))
    return df.sparkSession.createDataFrame(
        rows, "model string, candidate int, fold int, r2 double")


@dataclass
class LeastSquaresModel:
    """A fitted linear predictor; ``prediction()`` is a plain Column expression."""
    features: list
    intercept: float
    coefficients: list

    def prediction(self) -> Column:
        out = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients):
            out = out + F.lit(float(w)) * F.col(c).cast("double")
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())


def fit_linear(df: DataFrame, kind: str, features: Sequence[str], label: str, **params) -> LeastSquaresModel:
    """Any of ``LINEAR_KINDS`` from one aggregation of the rows."""
    stats = fold_statistics(df, features, label, None)
    if not stats:
        raise ValueError("no rows to fit")
    c0, v = solve_kind(kind, stats[0], params)
    return LeastSquaresModel(list(features), float(c0), [float(x) for x in v])


def fit_least_squares(df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.0,
                      fit_intercept: bool = True, scale: bool = True) -> LeastSquaresModel:
    """OLS / ridge from one aggregation of the normal equations (what Spark's ``normal``
    solver does, but as a DataFrame aggregate inside whole-stage codegen)."""
    stats = fold_statistics(df, features, label, None)
    if not stats:
        raise ValueError("no rows to fit")
    c0, v = solve(stats[0], alpha, fit_intercept, scale)
    return LeastSquaresModel(list(features), float(c0), [float(x) for x in v])
