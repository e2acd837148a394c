"""One key holding a third of all rows: results stay whole and exact, and the plans
combine map-side before the shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veld.operators import clean, encode, profile
from veld.plans.linear_cv import fit_least_squares


@pytest.fixture(scope="module")
def hot(spark):
    n = 3000
    rows = [(0 if i % 3 == 0 else i, i, float(i % 97)) for i in range(n)]   # key 0: 1/3 of rows
    return spark.createDataFrame(rows, "k long, pos long, v double").repartition(6)


def test_dedup_hot_key(spark, hot):
    out = clean.dedup_first(hot, ["k"], ["pos"])
    got = {r["k"]: r["pos"] for r in out.collect()}
    assert got[0] == 0 and len(got) == 1 + 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan


def test_target_encoding_hot_category(spark, hot):
    df = hot.withColumn("cat", F.when(F.col("k") == 0, "hot").otherwise((F.col("k") % 5).cast("string")))
    out = encode.TargetEncoder(["cat"], "v").fit(df).transform(df)
    want = df.where("cat = 'hot'").agg(F.avg("v")).first()[0]
    got = out.where("cat = 'hot'").select("cat_encoded").distinct().collect()
    assert len(got) == 1 and got[0][0] == pytest.approx(want)
    assert out.count() == 3000                       # every row kept


def test_counts_and_mode_hot_value(spark, hot):
    df = hot.withColumn("s", F.when(F.col("k") == 0, "hot").otherwise(F.col("k").cast("string")))
    vc = {r["value"]: r["count"] for r in profile.value_counts(df, "s").collect()}
    assert vc["hot"] == 1000 and sum(vc.values()) == 3000
    assert encode.modes(df, ["s"])["s"] == "hot"


def test_session_has_aqe_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_wide_least_squares_chunks_equal_numpy(spark):
    rng = np.random.default_rng(3)
    p = 30                                          # 528 sums -> two aggregation passes
    x = rng.normal(size=(500, p))
    y = x @ rng.normal(size=p) + 2.0 + rng.normal(scale=0.1, size=500)
    cols = [f"x{i}" for i in range(p)]
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)],
                               ", ".join(f"{c} double" for c in cols) + ", y double")
    m = fit_least_squares(df, cols, "y")
    coef = np.linalg.lstsq(np.c_[np.ones(500), x], y, rcond=None)[0]
    assert m.intercept == pytest.approx(coef[0], rel=1e-8)
    np.testing.assert_allclose(m.coefficients, coef[1:], rtol=1e-7, atol=1e-9)
