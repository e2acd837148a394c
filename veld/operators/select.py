"""Feature selection by correlation and repartition-stable splits (M1-M3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veld.functions.numeric import safe_corr
from veld.operators.clean import NUMERIC_TYPES


def target_correlations(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """``(column, r)`` of every numeric column with ``target`` from one aggregation."""
    if target not in df.columns:
        raise ValueError(f"no target column {target!r} among {df.columns}")
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]
    if target not in numeric:
        raise ValueError(f"target {target!r} is not numeric, so it has no correlations")
    wide = df.agg(*[safe_corr(c, target).alias(f"r{i}") if c != target else
                    F.when(F.stddev_pop(F.col(c).cast("double")) > 0, F.lit(1.0)).alias(f"r{i}")
                    for i, c in enumerate(numeric)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r"))
            for i, c in enumerate(numeric)]
    return wide.select(F.inline(F.array(*rows)))


def correlated_columns(df: DataFrame, target: str, threshold: float = 0.25,
                       exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns with ``|r| >= threshold`` (the target included), schema order (M1)."""
    rows = target_correlations(df, target, exclude).collect()
    return [r["column"] for r in rows if r["r"] is not None and abs(r["r"]) >= threshold]


def correlation_select(df: DataFrame, target: str, threshold: float = 0.25,
                       exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*correlated_columns(df, target, threshold, exclude))


# ---------------------------------------------------------------- splits (M2, M3)

def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])


def hash_bucket(keys: Sequence[str], seed: int | str, modulo: int) -> Column:
    """``(first 32 bits of md5(seed:key)) mod modulo`` - the same in Spark and DuckDB.

    Depends only on the row's key, never on partitioning or task order, so a retried
    task or a re-read with other splits puts every row in the same bucket.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), _key_text(keys))), 1, 8), 16, 10)
    return F.pmod(h.cast("long"), F.lit(modulo))


def split_flag(keys: Sequence[str], test_size: float = 0.2, seed: int = 42) -> Column:
    """True for test rows: a share ``test_size`` of the key space (M2)."""
    return hash_bucket(keys, seed, 10_000) < F.lit(int(round(test_size * 10_000)))


def holdout_split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(keys, test_size, seed)
    return df.where(~flag), df.where(flag)


def fold_column(keys: Sequence[str], k: int = 6, seed: int = 42) -> Column:
    """Fold number ``0..k-1`` per row (``KFold(shuffle=True)`` re-expressed) (M3)."""
    return hash_bucket(keys, f"fold{seed}", k).cast("int")
