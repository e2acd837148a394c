"""Imputation, clipping and encoders.

Every encoder is a fit / transform pair.  ``fit`` runs one distributed aggregation and
keeps only small statistics (fill values, bounds, category lists) or, for target
encoding, a mapping table written to the shared checkpoint folder.  ``transform`` is a
lazy projection, so the fitted object can be applied to another split, another day's
data or a stream.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veld.operators.clean import columns_of_kind
from veld.operators.quantiles import quantiles
from veld.session import materialize

# ---------------------------------------------------------------- mode / median / mean

def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column, smallest value on ties.

    Distributed: melt to ``(column, value)``, ``groupBy(column, value).count()`` (map-side
    combined), then ``min_by(value, (-count, value))`` per column, which also combines
    partially - no task ever holds all distinct values of a column.
    """
    cols = list(columns)
    if not cols:
        return {}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = {types[c] for c in cols}
    if len(kinds) > 1:  # melt needs one type: group by type family
        out = {}
        for k in kinds:
            out.update(modes(df, [c for c in cols if types[c] == k]))
        return out
    melted = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])))
    counts = (melted.where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("mode"))
    found = {r["column"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in cols}


def fill_values(df: DataFrame, columns: Sequence[str], method: str = "mode",
                approx: bool = False) -> dict[str, object]:
    """Fitted fill value per column: ``mode`` / ``median`` / ``mean``."""
    if method not in ("mode", "median", "mean"):
        raise ValueError(f"unknown fill statistic {method!r}: use mode, median or mean")
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return {}
    if method == "mode":
        return modes(df, cols)
    if method == "median":
        return {c: v[0] for c, v in quantiles(df, cols, [0.5], approx=approx).items()}
    row = df.agg(*[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    out = {}
    for c, v in values.items():
        if c in df.columns and v is not None:
            dt = df.schema[c].dataType.simpleString()
            out[c] = F.coalesce(F.col(c), F.lit(v).cast(dt))
    return df.withColumns(out) if out else df


def fill_missing(df: DataFrame, columns: Sequence[str] | None = None, method: str = "mode",
                 approx: bool = False) -> DataFrame:
    """Fit and apply in one call (E1/E2); default columns are all string columns."""
    cols = list(columns) if columns is not None else columns_of_kind(df, "string")
    return apply_fill(df, fill_values(df, cols, method, approx))


# ---------------------------------------------------------------- quantile clip

@dataclass
class QuantileClip:
    """Per-column bounds at quantiles ``(lo, hi)``; NULL stays NULL (pandas ``clip``)."""
    probs: dict[str, tuple[float, float]]
    approx: bool = False
    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "QuantileClip":
        allp = sorted({p for pair in self.probs.values() for p in pair})
        qs = quantiles(df, list(self.probs), allp, approx=self.approx)
        self.bounds = {c: (qs[c][allp.index(lo)], qs[c][allp.index(hi)])
                       for c, (lo, hi) in self.probs.items()}
        return self

    def expr(self, c: str) -> Column:
        lo, hi = self.bounds[c]
        x = F.col(c)
        if lo is None:
            return x
        # greatest/least skip NULLs, so guard to keep a missing value missing
        return F.when(x.isNotNull(), F.least(F.greatest(x.cast("double"), F.lit(lo)), F.lit(hi)))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.expr(c) for c in self.bounds})

    def bounds_frame(self, spark) -> DataFrame:
        rows = [(c, self.probs[c][0], self.probs[c][1], lo, hi)
                for c, (lo, hi) in self.bounds.items()]
        return spark.createDataFrame(
            rows, "column string, p_low double, p_high double, lower double, upper double")


# ---------------------------------------------------------------- recode / regroup

def recode(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """``map(d).fillna(self)``: mapped values replaced, others (and NULL) kept."""
    x = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return x
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(m[x], x)


def compose_groups(groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Flatten ``{new: [old, ...]}`` applied in sequence into one value -> value map."""
    values = {v for olds in groups.values() for v in olds} | set(groups)
    final = {v: v for v in values}
    for new, olds in groups.items():
        olds = set(olds)
        for v, cur in final.items():
            if cur in olds:
                final[v] = new
    return {k: v for k, v in final.items() if k != v}


def combine_categories(c: str, groups: Mapping[str, Sequence[str]],
                       missing_text: str = "nan") -> Column:
    """Many-to-one regroup applied in sequence; NULL becomes the text ``nan``."""
    return recode(F.coalesce(F.col(c).cast("string"), F.lit(missing_text)), compose_groups(groups))


# ---------------------------------------------------------------- target encoding

@dataclass
class TargetEncoder:
    """``<col>_encoded`` = mean target of the row's category; NULL/unseen -> NULL.

    ``fit`` computes one ``groupBy(column, category)`` mean over all encoded columns
    (melted, map-side combined) and writes it once to the checkpoint folder, which is
    also the saved mapping (S5).  ``transform`` joins it back per column, without a hint:
    Spark broadcasts it if its bytes allow and shuffles it beyond that.
    """
    columns: Sequence[str]
    target: str
    drop_original: bool = False
    mapping: DataFrame | None = None

    def fit(self, df: DataFrame) -> "TargetEncoder":
        self.mapping = materialize(mapping_frame(df, self.columns, self.target), "target-encoding")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.mapping is None:
            raise RuntimeError("fit first")
        out = df
        for c in self.columns:
            if c not in df.columns:
                continue
            m = (self.mapping.where(F.col("column") == c)
                 .select(F.col("category").alias(f"_cat_{c}"),
                         F.col("encoded").alias(f"{c}_encoded")))
            out = (out.join(m, out[c].cast("string") == F.col(f"_cat_{c}"), "left")
                   .drop(f"_cat_{c}"))
            if self.drop_original:
                out = out.drop(c)
        return out

    def save(self, path: str) -> None:
        """One folder per encoded column (``partitionBy('column')``)."""
        self.mapping.write.mode("overwrite").partitionBy("column").parquet(path)


def mapping_frame(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``(column, category, encoded, rows)``: mean target per category, NULL category dropped."""
    cols = [c for c in columns if c in df.columns]
    melted = df.select(F.col(target).cast("double").alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
        for c in cols])))
    return (melted.where(F.col("category").isNotNull())
            .groupBy("column", "category")
            .agg(F.avg("_y").alias("encoded"), F.count(F.lit(1)).alias("rows")))


# ---------------------------------------------------------------- one-hot / ordinal

def distinct_values(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values, for steps that make a column or an expression of each
    (a plan holds them anyway); ``ordinal_codes`` keeps them in a table."""
    vals = df.where(F.col(column).isNotNull()).select(column).distinct().collect()
    return sorted(r[0] for r in vals)


def ordinal_codes(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """``(value, code)``: the 0-based place of every distinct non-null value in order (K4, E5).

    Values are sorted by ranges and numbered inside each; a range's start is the number of
    values before it, so no task and no driver holds them all.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    order = F.col("value").desc() if descending else F.col("value").asc()
    placed = materialize(values.repartitionByRange(order).sortWithinPartitions(order).select(
        "value", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "ordinal-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    base = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return placed.join(base, "part").select("value", (F.col("base") + F.col("place")).cast("double").alias("code"))


def ordinal_encode(df: DataFrame, column: str, codes: DataFrame, out: str | None = None) -> DataFrame:
    """``df`` with the code of ``column`` from ``ordinal_codes``; NULL and unseen values give NULL."""
    side = codes.select(F.col("value").alias("_value"), F.col("code").alias(out or f"{column}_code"))
    return df.join(side, F.col(column) == F.col("_value"), "left").drop("_value")


def one_hot_drop_first(df: DataFrame, column: str, categories: Sequence | None = None,
                       drop_original: bool = True, prefix: str = "") -> DataFrame:
    """0/1 column per category except the smallest (``get_dummies(drop_first=True)``).

    NULL gives 0 in every dummy.  Expressions on the same row - no join, no shuffle.
    """
    cats = list(categories) if categories is not None else distinct_values(df, column)
    x = F.col(column)
    dummies = {f"{prefix}{v}": F.when(x == F.lit(v), 1).otherwise(0) for v in cats[1:]}
    out = df.withColumns(dummies)
    return out.drop(column) if drop_original else out


def one_hot_vectors(df: DataFrame, column: str, codes: DataFrame, out: str | None = None) -> DataFrame:
    """Dummies as one sparse vector per row, for any number of categories.

    ``codes`` is the (value, code) table of ``ordinal_codes``, whose last code is the smallest category:
    that is the one without a dummy.  NULL and unseen values are all zero.  No value of the column
    reaches the driver, only their number; the join is a broadcast only if Spark finds the
    table's bytes small enough.
    """
    from pyspark.ml.feature import OneHotEncoder
    out = out or f"{column}_vector"
    size = codes.count()
    spare = "_code"
    rows = ordinal_encode(df, column, codes, spare).withColumn(spare, F.coalesce(F.col(spare).cast("double"), F.lit(float(max(size - 1, 0)))))
    # fitted on the codes, not on the rows: the vector's size is the same whatever the rows hold
    encoder = OneHotEncoder(inputCols=[spare], outputCols=[out], dropLast=True)
    sample = codes.select(F.col("code").cast("double").alias(spare))
    return encoder.fit(sample).transform(rows).drop(spare)


def ordinal_expr(c: str, order: Sequence[str], unknown: str = "null") -> Column:
    """Index of the value in ``order`` (0-based); NULL stays NULL.

    ``unknown='error'`` raises for a present value not in the list (sklearn default),
    ``'null'`` gives NULL.
    """
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(float(i)))])
    x = F.col(c)
    code = m[x]
    if unknown == "error":
        return F.when(x.isNull(), F.lit(None).cast("double")).when(code.isNotNull(), code).otherwise(
            F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), x.cast("string"))))
    return code


def descending_categories(df: DataFrame, column: str) -> list:
    """Distinct values sorted descending (the data-derived ordinal order, K4)."""
    return list(reversed(distinct_values(df, column)))


# ---------------------------------------------------------------- standardise

@dataclass
class Standardizer:
    """``(x - mean) / population std`` per column (sklearn ``StandardScaler``)."""
    columns: Sequence[str]
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "Standardizer":
        row = df.agg(*[e for i, c in enumerate(self.columns) for e in (
            F.avg(F.col(c).cast("double")).alias(f"m{i}"),
            F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
        self.stats = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(self.columns)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (m, s) in self.stats.items():
            x = F.col(c).cast("double") - F.lit(m)
            out[c] = x / F.lit(s) if s else x     # constant column: sklearn keeps scale 1
        return df.withColumns(out)

    def to_json(self) -> str:
        return json.dumps(self.stats)
