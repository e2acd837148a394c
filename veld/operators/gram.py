"""Correlation of very many columns from Gram matrices.

One expression a pair is fine for some dozens of columns; 500 columns are 125,000 pairs, which no
plan should hold.  Here a task multiplies its Arrow batches as matrices: with Z the values less
a first mean (0 where missing) and M the mask of present values, ``M'M``, ``Z'M``, ``(Z*Z)'M`` and ``Z'Z``
give count, sums, squares and products of every pair over the rows where both are present.
Tasks emit their sums as one row per column (``4 k`` numbers), a shuffle by column adds them up, and
the result is long.  Two scans whatever the number of columns; a task holds ``4 k^2`` numbers.

Missing is NULL or NaN.  A pair without two complete rows, or constant on them, has a NULL ``r``;
infinities make the pair's ``r`` NULL too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of one aggregation of means.
CHUNK = 200


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, n, r)`` for all ordered pairs, the diagonal included; ``n`` counts complete rows."""
    cols = list(columns)
    k = len(cols)
    means = np.zeros(k)
    for start in range(0, k, CHUNK):
        part = cols[start:start + CHUNK]
        finite = [F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")) for c in part]
        row = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(finite)]).first()
        means[start:start + len(part)] = [m or 0.0 for m in row]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) if batch.num_rows else np.zeros((0, k))
            there = ~np.isnan(x)
            z, m = np.where(there, x - means, 0.0), there.astype(float)
            with np.errstate(invalid="ignore", over="ignore"):
                sums += (m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(k), pa.int32()),
                                          "sums": [np.ascontiguousarray(sums[:, i]).tobytes() for i in range(k)],
                                          "across": [np.ascontiguousarray(sums[1:3, :, i]).tobytes() for i in range(k)]})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine, theirs = None, None, None

        def rows():
            n, s, ss, products = mine.reshape(4, k)
            t, tt = theirs.reshape(2, k)
            with np.errstate(divide="ignore", invalid="ignore"):
                left, right = ss - s * s / n, tt - t * t / n
                # rounding leaves a constant column a speck of variance
                flat = (left <= 1e-12 * ss) | (right <= 1e-12 * tt)
                r = np.where(flat, np.nan, (products - s * t / n) / np.sqrt(left * right))
            if not flat[now]:
                r[now] = 1.0 if np.isfinite(r[now]) else np.nan
            return pa.RecordBatch.from_pydict({"i": pa.array(np.full(k, now), pa.int32()), "j": pa.array(np.arange(k), pa.int32()),
                                               "n": pa.array(n.astype(np.int64)), "r": pa.array(r, mask=~np.isfinite(r))})

        for batch in batches:
            for i, sums, across in zip(*(batch.column(c).to_pylist() for c in ("i", "sums", "across"))):
                if i != now:
                    if now is not None:
                        yield rows()
                    now, mine, theirs = i, 0.0, 0.0
                mine, theirs = mine + np.frombuffer(sums), theirs + np.frombuffer(across)
        if now is not None:
            yield rows()

    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = values.mapInArrow(partial, "i int, sums binary, across binary").repartition("i").sortWithinPartitions("i") \
        .mapInArrow(joined, "i int, j int, n long, r double")
    names = F.array(*[F.lit(c) for c in cols])
    return pairs.select(F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"), "n", "r")
