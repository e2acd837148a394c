"""Bagged trees and their out-of-bag score against a plain grower over the same draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veld.plans import forest as fo

FEATS, KEY = ["a", "b"], ["id"]


def _data(spark, n=300):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, 2)), 1)
    y = np.where(x[:, 0] > 0, 3.0, 0.0) + x[:, 1] ** 2 + rng.normal(scale=0.2, size=n)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id long, a double, b double, y double")
    keys = np.array([r[0] for r in df.select(F.xxhash64("id")).collect()])
    return df.repartition(4), x, y, keys


def _grow(x, y, w, cuts, depth, split, leaf):
    """The predictions of a tree grown on rows of weight ``w`` by trying every cut."""
    out = np.zeros(len(y))

    def node(rows, d):
        drawn = rows[w[rows] > 0]
        weight = w[drawn].sum()
        best = None
        if d < depth and weight >= split:
            for f in range(x.shape[1]):
                for c in cuts[f]:
                    left = drawn[x[drawn, f] <= c]
                    right = drawn[x[drawn, f] > c]
                    if min(w[left].sum(), w[right].sum()) < leaf:
                        continue
                    gain = sum((w[s] @ y[s]) ** 2 / w[s].sum() for s in (left, right)) - (w[drawn] @ y[drawn]) ** 2 / weight
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, c
        if best is None:
            out[rows] = w[drawn] @ y[drawn] / weight
        else:
            node(rows[x[rows, best[1]] <= best[2]], d + 1)
            node(rows[x[rows, best[1]] > best[2]], d + 1)

    node(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("cells", [4_000_000, 40])
def test_forest_and_out_of_bag_score(spark, monkeypatch, cells):
    """Few histogram cells mean more jobs, not other trees."""
    monkeypatch.setattr(fo, "MAX_CELLS", cells)
    df, x, y, keys = _data(spark)
    forest, state = fo.fit_forest(df, FEATS, "y", KEY, n_estimators=6, max_depth=3, min_samples_split=12, min_samples_leaf=4, max_bins=12)
    draws = [fo.times_drawn(keys, 42, m) for m in range(6)]
    each = np.array([_grow(x, y, w.astype(float), forest.cuts, 3, 12, 4) for w in draws])
    got = [r["prediction"] for r in forest.transform(df).orderBy("id").collect()]
    np.testing.assert_allclose(got, each.mean(0), rtol=1e-9)
    out = np.array(draws) == 0
    has = out.any(0)
    oob = (each * out).sum(0)[has] / out.sum(0)[has]
    row = forest.out_of_bag(state).first()
    assert row["n"] == has.sum()
    assert row["oob_r2"] == pytest.approx(1 - ((y[has] - oob) ** 2).mean() / y[has].var(), rel=1e-9)


def test_draws_are_a_bootstrap():
    times = np.array([fo.times_drawn(np.arange(20_000), 1, m) for m in range(3)])
    assert abs(times.mean() - 1) < 0.02 and abs((times == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(times[0], times[1])[0, 1]) < 0.03


def test_depth_beyond_thirty_levels(spark):
    """A staircase that only grows at one end needs a level a step."""
    n = 45
    df = spark.createDataFrame([(i, float(i), 0.0, float(3 ** min(i, 39))) for i in range(n)], "id long, a double, b double, y double")
    forest, _ = fo.fit_forest(df, FEATS, "y", KEY, n_estimators=1, bootstrap=False)
    assert forest.trees[0].depth > 30
    capped, _ = fo.fit_forest(df, FEATS, "y", KEY, n_estimators=1, bootstrap=False, max_depth=5)
    assert capped.trees[0].depth == 5


def test_features_of_a_node(spark):
    assert fo._allowed(9, "sqrt", 1, 0, 0) == fo._allowed(9, "sqrt", 1, 0, 0) and len(fo._allowed(9, "sqrt", 1, 0, 0)) == 3
    assert len(fo._allowed(8, "log2", 1, 0, 0)) == 3 and len(fo._allowed(8, 0.5, 1, 0, 0)) == 4 and fo._allowed(4, None, 1, 0, 0) == [0, 1, 2, 3]
    assert len({tuple(fo._allowed(9, 2, 1, 0, node)) for node in range(20)}) > 5
