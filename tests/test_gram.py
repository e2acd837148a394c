"""Correlation from Gram matrices against pandas, pairwise complete."""

import numpy as np
import pandas as pd

from veld.operators.gram import correlation_long


def _check(spark, frame, parts=4):
    df = spark.createDataFrame([tuple(None if pd.isna(v) and k % 2 else float(v) for k, v in enumerate(row)) for row in frame.to_numpy()],
                               ", ".join(f"`{c}` double" for c in frame.columns)).repartition(parts)
    got = correlation_long(df, list(frame.columns)).toPandas()
    wide = got.pivot(index="a", columns="b", values="r").loc[frame.columns, frame.columns].astype(float)
    np.testing.assert_allclose(wide.to_numpy(), frame.corr().to_numpy(), atol=1e-9)
    counts = got.pivot(index="a", columns="b", values="n").loc[frame.columns, frame.columns].to_numpy()
    there = frame.notna().to_numpy().astype(int)
    np.testing.assert_array_equal(counts, there.T @ there)


def test_missing_constant_and_large_offsets(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6))
    x[:, 1] += x[:, 0]
    x[:, 2] = 5.0
    x[:, 3] = 1e9 + x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = np.nan
    _check(spark, pd.DataFrame(x, columns=list("abcdef")))


def test_five_hundred_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 500)) + rng.normal(size=(60, 1))
    _check(spark, pd.DataFrame(x, columns=[f"column {i}" for i in range(500)]), 3)
