import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veld.operators.quantiles import approx_quantiles, exact_quantiles

PROBS = [0.0, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


def _check(spark, values, probs=PROBS, **kw):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], probs, **kw)["x"]
    present = np.array([v for v in values if v is not None], dtype=float)
    if len(present) == 0:
        assert got == [None] * len(probs)
        return
    want = np.quantile(present, probs)            # numpy 'linear' = pandas = quantile_cont
    np.testing.assert_allclose(got, want, rtol=1e-12, atol=1e-12)


def test_matches_numpy_random(spark):
    rng = np.random.default_rng(1)
    _check(spark, list(rng.normal(size=5000)))


def test_by_digits_to_the_end(spark):
    """Without scans by value every digit is counted."""
    rng = np.random.default_rng(2)
    _check(spark, list(rng.lognormal(size=3000)), by_value_rows=0)


def test_hot_value_third_of_rows(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.uniform(0, 100, size=2000)) + [42.0] * 1000
    _check(spark, vals)


def test_nulls_ignored_and_empty(spark):
    _check(spark, [None, 1.0, None, 3.0, 2.0])
    _check(spark, [None, None])


def test_single_value(spark):
    _check(spark, [7.5])


def test_several_columns_one_call(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b)) for a, b in zip(rng.normal(size=800), rng.integers(0, 5, size=800))]
    df = spark.createDataFrame(rows, "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.1, 0.5, 0.9])
    for i, c in enumerate(["a", "b"]):
        want = np.quantile([r[i] for r in rows], [0.1, 0.5, 0.9])
        np.testing.assert_allclose(got[c], want, rtol=1e-12)


def test_bad_probability(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        exact_quantiles(df, ["x"], [1.5])


def test_approx_close(spark):
    rng = np.random.default_rng(5)
    vals = list(rng.uniform(size=4000))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = approx_quantiles(df, ["x"], [0.5])["x"][0]
    assert abs(got - np.median(vals)) < 0.01


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_property_against_numpy(spark, values, probs):
    _check(spark, values, probs, by_value_rows=20)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (None,), (4.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.0, 0.5, 1.0])["x"] == [1.0, 2.0, 4.0]


@pytest.mark.parametrize("values", [
    [float(i) for i in range(6000)] + [float("inf")],
    [float("-inf"), float("inf"), float("inf")] + [float(i) for i in range(500)],
    [-1.7e308, 1.7e308] + [float(i) for i in range(2000)],
    [2.0 ** k for k in range(-1000, 1000)],
    [42.0] * 4000 + [float(i) for i in range(2000)]])
def test_any_spread_ends_in_few_scans(spark, values, monkeypatch):
    from veld.operators import quantiles as module
    scans = []
    scan = module._melted
    monkeypatch.setattr(module, "_melted", lambda *a: (scans.append(1), scan(*a))[1])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for rows, most in ((0, 4), (1_000_000, 2)):
        scans.clear()
        got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], by_value_rows=rows)["x"]
        np.testing.assert_allclose(got, np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-12)
        assert len(scans) <= most


def test_scale_digit_never_decreases(spark):
    """Neighbours of powers of two, subnormals, zeros and infinities; at most 4.5 % in a digit."""
    from pyspark.sql import functions as F

    from veld.operators.quantiles import scale_digit
    rng = np.random.default_rng(6)
    powers = 2.0 ** np.arange(-1074, 1024)
    values = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), rng.normal(size=500),
                             rng.integers(0, 2**63 - 2**53, 2000).view(np.float64), [0.0, np.inf, 1.7976931348623157e308]])
    values = np.unique(np.concatenate([values, -values]))
    values = values[~np.isnan(values)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = df.select("x", scale_digit(F.col("x")).alias("d")).orderBy("x").collect()
    digits = np.array([r["d"] for r in got])
    assert (np.diff(digits) >= 0).all() and (digits[values < 0] < 0).all() and (digits[values > 0] > 0).all()
    normal = values > 1e-300
    for d in np.unique(digits[normal]):
        cell = values[normal][digits[normal] == d]
        assert cell[-1] / cell[0] <= 1.045


def test_both_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (0.0,), (-0.0,), (5.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]) == {"x": [0.0, 0.0, 5.0]}


def test_more_columns_than_a_scan_takes(spark, monkeypatch):
    from veld.operators import quantiles as module
    monkeypatch.setattr(module, "COLUMNS", 2)
    df = spark.createDataFrame([(float(i), 2.0 * i, None, float(-i), 1.0) for i in range(11)], "a double, b double, c double, d double, e double")
    assert exact_quantiles(df, df.columns, [0.5]) == {"a": [5.0], "b": [10.0], "c": [None], "d": [-5.0], "e": [1.0]}
