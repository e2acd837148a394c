import numpy as np
import pytest

from tests.fixtures import listings
from veld.operators import encode, profile


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "s string")
    assert encode.modes(df, ["s"]) == {"s": "a"}


def test_mode_hot_value(spark):
    rows = [("hot",)] * 300 + [(f"v{i}",) for i in range(600)]
    df = spark.createDataFrame(rows, "s string")
    assert encode.modes(df, ["s"])["s"] == "hot"


def test_fill_methods(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    assert encode.fill_values(df, ["x"], "median") == {"x": 2.0}
    assert encode.fill_values(df, ["x"], "mean")["x"] == pytest.approx(13 / 3)
    out = encode.fill_missing(df, ["x"], method="median")
    assert sorted(r[0] for r in out.collect()) == [1.0, 2.0, 2.0, 10.0]
    with pytest.raises(ValueError):
        encode.fill_values(df, ["x"], "max")


def test_quantile_clip_keeps_null_and_bounds(spark):
    rng = np.random.default_rng(7)
    vals = [float(v) for v in rng.normal(size=500)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    clip = encode.QuantileClip({"x": (0.05, 0.95)}).fit(df)
    lo, hi = clip.bounds["x"]
    present = np.array([v for v in vals if v is not None])
    assert lo == pytest.approx(np.quantile(present, 0.05)) and hi == pytest.approx(np.quantile(present, 0.95))
    out = [r[0] for r in clip.transform(df).collect()]
    assert out.count(None) == 1
    assert all(lo <= v <= hi for v in out if v is not None)


def test_target_encoder_fit_on_train_apply_elsewhere(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 5.0)], "c string, y double")
    test = spark.createDataFrame([("a", 0.0), ("z", 0.0), (None, 0.0)], "c string, y double")
    enc = encode.TargetEncoder(["c"], "y").fit(train)
    got = {r["c"]: r["c_encoded"] for r in enc.transform(test).collect()}
    assert got == {"a": 2.0, "z": None, None: None}


def test_target_encoder_leaves_the_join_to_spark(spark):
    train = spark.createDataFrame([(str(i % 50), float(i)) for i in range(200)], "c string, y double")
    enc = encode.TargetEncoder(["c"], "y").fit(train)
    assert "strategy=broadcast" not in enc.transform(train)._jdf.queryExecution().optimizedPlan().toString()
    assert enc.transform(train).count() == 200


def test_compose_groups_in_sequence():
    groups = {"House": ["House", "Town house"], "Luxury": ["Villa", "Mansion"],
              "Other": ["Bungalow", "House"]}
    m = encode.compose_groups(groups)
    # 'Town house' -> 'House' -> 'Other' (the later group catches the earlier result)
    assert m["Town house"] == "Other" and m["House"] == "Other" and m["Villa"] == "Luxury"


def test_combine_categories_null_becomes_nan(spark):
    df = spark.createDataFrame([("Villa",), (None,), ("Farmhouse",)], "s string")
    out = [r[0] for r in df.select(encode.combine_categories("s", {"Luxury": ["Villa"]})).collect()]
    assert out == ["Luxury", "nan", "Farmhouse"]


def test_recode_keeps_unmapped_and_null(spark):
    df = spark.createDataFrame([("To restore",), ("Good",), (None,)], "s string")
    m = {"To restore": "To renovate", "Just renovated": "Good"}
    assert [r[0] for r in df.select(encode.recode("s", m)).collect()] == ["To renovate", "Good", None]


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, p string")
    out = encode.one_hot_drop_first(df, "p")
    assert out.columns == ["id", "b", "c"]
    rows = {r["id"]: (r["b"], r["c"]) for r in out.collect()}
    assert rows == {1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (0, 1)}


def test_ordinal_orders(spark):
    df = spark.createDataFrame([("A",), ("C",), ("B",), (None,)], "e string")
    order = encode.descending_categories(df, "e")
    assert order == ["C", "B", "A"]
    got = [r[0] for r in df.select(encode.ordinal_expr("e", order)).collect()]
    assert got == [2.0, 0.0, 1.0, None]
    bad = spark.createDataFrame([("X",)], "e string")
    with pytest.raises(Exception):
        bad.select(encode.ordinal_expr("e", ["A"], unknown="error")).collect()


@pytest.mark.parametrize("descending", [True, False])
def test_ordinal_codes_over_several_ranges(spark, descending):
    values = [f"v{i * 7919 % 500:03d}" for i in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 2)] + [(-1, None)], "id long, v string")
    codes = encode.ordinal_codes(df, "v", descending)
    got = {r.id: r.v_code for r in encode.ordinal_encode(df, "v", codes).collect()}
    place = {v: float(k) for k, v in enumerate(sorted(values, reverse=descending))}
    assert got == {i: place[v] for i, v in enumerate(values * 2)} | {-1: None}
    none = encode.ordinal_codes(df.where("v IS NULL"), "v")
    assert none.count() == 0


def test_standardizer_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    got = [r[0] for r in encode.Standardizer(["x"]).fit(df).transform(df).collect()]
    np.testing.assert_allclose(got, (np.array([1, 2, 3]) - 2) / np.std([1, 2, 3]))


def test_category_profile_rare(spark):
    df = listings(spark)
    prof = profile.category_profile(df, ["epc"], threshold=0.15)
    rows = {r["value"]: (r["count"], r["rare"]) for r in prof.collect()}
    assert rows["B"] == (2, False) and rows["A++"] == (1, True)


def test_value_counts_present_vs_all(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    pres = {r["value"]: r["percentage"] for r in profile.value_counts(df, "s").collect()}
    allr = {r["value"]: r["percentage"] for r in profile.value_counts(df, "s", over="all").collect()}
    assert pres == {"a": 66.67, "b": 33.33} and allr == {"a": 50.0, "b": 25.0}


def test_numeric_columns_binary_rules(spark):
    df = spark.createDataFrame([(0, 0, 1.5, 1), (1, None, 2.5, 2), (1, 1, 3.5, 3)],
                               "bin int, bin_null int, x double, x_encoded int")
    assert profile.numeric_columns(df) == ["bin_null", "x"]


def test_describe_and_skew(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = profile.describe(df, ["x"]).first()
    assert d["q25"] == 2.0 and d["q50"] == 3.0 and d["q75"] == 4.0
    assert d["std"] == pytest.approx(np.std(vals, ddof=1))
    n = len(vals)
    m = np.mean(vals)
    g1 = np.mean((np.array(vals) - m) ** 3) / np.mean((np.array(vals) - m) ** 2) ** 1.5
    want = g1 * np.sqrt(n * (n - 1)) / (n - 2)
    assert profile.skewness(df, ["x"]).first()["skewness"] == pytest.approx(want)


def test_iqr_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = profile.iqr_outliers(df, ["x"]).first()
    assert r["q1"] == 2.0 and r["q3"] == 4.0 and r["outliers"] == 1 and r["whisker_high"] == 4.0


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 7.0)], "a double, c double, b double")
    m = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None and m[("a", "a")] == 1.0
    assert m[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert m[("a", "b")] == m[("b", "a")]


def test_approx_profiles_close_to_exact(spark):
    rng = np.random.default_rng(11)
    vals = [float(v) for v in rng.normal(size=3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    exact = profile.describe(df, ["x"]).first()
    approx = profile.describe(df, ["x"], approx=True).first()
    for q in ("q25", "q50", "q75"):
        assert abs(exact[q] - approx[q]) < 0.05
    clip = encode.QuantileClip({"x": (0.05, 0.95)}, approx=True).fit(df)
    lo, hi = clip.bounds["x"]
    assert abs(lo - np.quantile(vals, 0.05)) < 0.1 and abs(hi - np.quantile(vals, 0.95)) < 0.1
