"""A forest grown on the cells of a small grid equals the forest grown level by level on the rows."""

import numpy as np
import pytest

from tests.test_boost import FEATS, KEY, _data
from tests.test_cells import _barred
from veld.plans import cells
from veld.plans import forest as fo


@pytest.mark.parametrize("most", [4_000_000, 30])
def test_forest_on_cells_equals_forest_by_level(spark, monkeypatch, most):
    df, _, _ = _data(spark)
    fit = lambda: fo.fit_forest(df, FEATS, "y", KEY, 5, None, 6, 2, "sqrt", max_bins=10)
    with monkeypatch.context() as m:
        m.setattr(cells, "MAX_GRID", 0)
        want, state = fit()
        score, rows = want.out_of_bag(state).first(), want.transform(df).orderBy("id").collect()
    monkeypatch.setattr(fo, "_level", _barred)
    monkeypatch.setattr(fo, "MAX_CELLS", most)
    got, state = fit()
    for t, u in zip(got.trees, want.trees):
        assert (t.feature, t.cut, t.left, t.depth) == (u.feature, u.cut, u.left, u.depth)
        np.testing.assert_allclose(t.value, u.value, rtol=1e-9)
    assert [*got.out_of_bag(state).first()] == pytest.approx([*score], rel=1e-9)
    assert [r["prediction"] for r in got.transform(df).orderBy("id").collect()] == pytest.approx([r["prediction"] for r in rows], rel=1e-9)
