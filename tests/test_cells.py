"""Trees grown on the cells of a small grid equal the trees grown level by level on the rows."""

import numpy as np
import pytest

from tests.test_boost import FEATS, KEY, _data
from veld.plans import boost, cells


def _barred(*a):
    raise AssertionError("a job a level")


def test_grid_is_bounded():
    cuts = lambda *n: [np.arange(float(k)) for k in n]
    assert cells.grid_of(cuts(63, 63, 63)) == (64, 64, 64) and cells.grid_of(cuts(63, 63, 64)) is None
    bins = np.array([[0, 2], [3, 1], [0, 2]])
    one, back = cells.distinct(bins, (4, 3))
    assert len(one) == 2 and (one[back] == bins).all()
    assert (cells.bins_of((4, 3))[cells.cell_of(bins, (4, 3))] == bins).all()


@pytest.mark.parametrize("most", [4_000_000, 40])
def test_boosters_on_cells_equal_boosters_by_level(spark, monkeypatch, most):
    """Draws, held-out folds and early stopping included; few cells a task mean more scans, not other trees."""
    df, _, _ = _data(spark)
    params = [{"n_estimators": 5, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.67, "gamma": 0.5, "early_stopping_rounds": 2},
              {"n_estimators": 12, "max_depth": 2, "learning_rate": 0.9, "reg_alpha": 2.0, "early_stopping_rounds": 1}]
    fit = lambda: boost.fit_boosted(df, FEATS, "y", KEY, params, "fold", [0, 1, None], max_bins=12)
    with monkeypatch.context() as m:
        m.setattr(cells, "MAX_GRID", 0)
        want = fit()
    monkeypatch.setattr(boost, "_level", _barred)
    monkeypatch.setattr(boost, "MAX_CELLS", most)
    for a, b in zip(sum(fit(), []), sum(want, [])):
        assert len(a.trees) == len(b.trees) and a.stopped == b.stopped and a.best_iteration == b.best_iteration
        np.testing.assert_allclose(a.scores, b.scores, rtol=1e-9)
        for t, u in zip(a.trees, b.trees):
            np.testing.assert_array_equal(t.feature, u.feature)
            np.testing.assert_array_equal(t.cut, u.cut)
            np.testing.assert_allclose(t.gain, u.gain, rtol=1e-7)
            np.testing.assert_allclose(t.value, u.value, rtol=1e-7)


def test_fold_without_rows_and_trees_without_draws(spark):
    df, _, _ = _data(spark, 20)
    model = boost.fit_boosted(df, FEATS, "y", KEY, [{"n_estimators": 3, "subsample": 1e-9}], "fold", [99], max_bins=4)[0][0]
    assert len(model.trees) == 3 and model.scores == [] and not any((t.feature >= 0).any() for t in model.trees)


@pytest.mark.parametrize("block", [48_000_000, 2000])
def test_search_errors_on_cells_equal_those_of_fitted_boosters(spark, monkeypatch, block):
    """Blocks of any number of trees; candidates that share a draw, draw all rows, or stop early."""
    df, _, _ = _data(spark)
    params = [{"n_estimators": 6, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.67, "gamma": 0.5, "early_stopping_rounds": 2},
              {"n_estimators": 12, "max_depth": 2, "learning_rate": 0.9, "reg_alpha": 2.0, "early_stopping_rounds": 1, "subsample": 0.6},
              {"n_estimators": 4, "max_depth": 4, "subsample": 0.7, "colsample_bynode": 0.67}, {"n_estimators": 2}, {"n_estimators": 0}]
    binned = boost.binned_rows(df, FEATS, "y", KEY, "fold", 12)
    want = [m.scores for models in boost.grow_boosted(*binned, FEATS, params, [0, 1, 2, 3]) for m in models]
    monkeypatch.setattr(boost, "BLOCK_SUMS", block)
    got = boost._scores_on_cells(*binned, FEATS, params, [0, 1, 2, 3], 42)
    assert [len(s) for s in got] == [len(s) for s in want]
    for a, b in zip(got, want):
        np.testing.assert_allclose(a, b, rtol=1e-9)
