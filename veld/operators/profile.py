"""Column profiling (A1-A15): one fused aggregation per question, long-form results.

The reference loops over columns and scans once per column; here every statistic of
every column is one expression in a single ``agg`` (partial aggregation on the mappers,
one tiny merge), then unpivoted with ``inline``.  Very wide tables are chunked at
``CHUNK`` expressions so generated code stays under the JVM method-size limits.
Quantile statistics count digits, exactly and in a few scans (``veld.operators.quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veld.functions.numeric import safe_corr, skewness_adjusted
from veld.operators.clean import NUMERIC_TYPES, columns_of_kind
from veld.operators.quantiles import quantiles, value_stats

CHUNK = 200


def _long(df: DataFrame, cols: Sequence[str], stats: dict) -> DataFrame:
    """One aggregation of ``{name: fn(col) -> Column}`` per column, as rows per column."""
    cols = list(cols)
    names = list(stats)
    pieces = []
    step = max(1, CHUNK // max(1, len(names)))
    for start in range(0, len(cols), step):
        part = cols[start:start + step]
        wide = df.agg(*[stats[s](c).alias(f"{s}_{start + i}")
                        for i, c in enumerate(part) for s in names])
        rows = [F.struct(F.lit(c).alias("column"),
                         *[F.col(f"{s}_{start + i}").alias(s) for s in names])
                for i, c in enumerate(part)]
        pieces.append(wide.select(F.inline(F.array(*rows))))
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- nulls

def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` for every column in one pass (A1)."""
    return _long(df, columns or df.columns, {"nulls": lambda c: F.count_if(F.col(c).isNull())})


def conditional_missing_pct(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Share (%) of rows with ``flag`` true whose ``value`` is missing (A2)."""
    f = F.col(flag).cast("boolean")
    return df.agg(
        F.count_if(f).alias("flag_rows"),
        F.count_if(f & F.col(value).isNull()).alias("missing_rows"),
        (F.lit(100.0) * F.try_divide(F.count_if(f & F.col(value).isNull()),
                                     F.nullif(F.count_if(f), F.lit(0)))).alias("missing_pct"))


def table_summary(df: DataFrame, key: Sequence[str], n: int = 15) -> tuple[DataFrame, DataFrame]:
    """``(head, info)``: first ``n`` rows by ``key`` and ``(column, type, nulls, rows)``."""
    head = df.orderBy(*key).limit(n)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    info = _long(df, df.columns, {"nulls": lambda c: F.count_if(F.col(c).isNull()),
                                  "rows": lambda c: F.count(F.lit(1))})
    type_map = F.create_map(*[x for c, t in types.items() for x in (F.lit(c), F.lit(t))])
    info = info.withColumn("type", type_map[F.col("column")]).select("column", "type", "nulls", "rows")
    return head, info


# ---------------------------------------------------------------- value counts (A3-A5)

def value_counts(df: DataFrame, column: str, over: str = "present", digits: int = 2
                 ) -> DataFrame:
    """``(value, count, percentage)`` (A3 / A4).

    ``over='present'`` divides by non-null rows (``value_counts(normalize=True)``),
    ``over='all'`` by all rows.  The total is one scalar aggregate, so no window over the
    whole result and no cross join.
    """
    c = F.col(column)
    tot = df.agg(F.count(c) if over == "present" else F.count(F.lit(1))).first()[0]
    counts = df.where(c.isNotNull()).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn(
        "percentage", F.round(F.lit(100.0) * F.col("count") / F.lit(max(tot, 1)), digits))


def category_profile(df: DataFrame, columns: Sequence[str] | None = None,
                     threshold: float = 0.05, exclude: Sequence[str] = ()) -> DataFrame:
    """``(column, value, count, percentage, rare)`` for all string columns at once (A5).

    Melt to ``(column, value)`` and one ``groupBy(column, value)`` (map-side combined, so
    a hot value is cheap).  The per-column totals are ``count(column)`` from one scalar
    aggregation, applied as a literal map (as many entries as columns): no join.
    """
    cols = [c for c in (columns or columns_of_kind(df, "string")) if c not in set(exclude)]
    if not cols:
        raise ValueError("no categorical columns to profile")
    tot = df.agg(*[F.count(F.col(c)).alias(f"t{i}") for i, c in enumerate(cols)]).first()
    totals = F.create_map(*[x for i, c in enumerate(cols)
                            for x in (F.lit(c), F.lit(max(int(tot[f"t{i}"]), 1)))])
    melted = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))
    counts = (melted.where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    pct = F.lit(100.0) * F.col("count") / totals[F.col("column")]
    return counts.select("column", "value", "count", pct.alias("percentage"),
                         (pct < threshold * 100).alias("rare"))


# ---------------------------------------------------------------- numeric picks

def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are not excluded, not ``*_encoded`` and not binary 0/1.

    A 0/1 column with NULLs is *not* binary (pandas: ``set(unique())`` then holds NaN).
    One aggregation: nulls, min, max and a count of values outside {0, 1}.
    """
    cand = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)
            and not isinstance(f.dataType, T.DecimalType)
            and f.name not in set(exclude) and not f.name.endswith("_encoded")]
    if not cand:
        return []
    row = df.agg(*[e for i, c in enumerate(cand) for e in (
        F.count_if(F.col(c).isNull()).alias(f"z{i}"),
        F.min(F.col(c)).alias(f"a{i}"), F.max(F.col(c)).alias(f"b{i}"),
        F.count_if(~F.col(c).isin(0, 1)).alias(f"o{i}"))]).first()
    out = []
    for i, c in enumerate(cand):
        binary = (row[f"z{i}"] == 0 and row[f"o{i}"] == 0 and row[f"a{i}"] == 0
                  and row[f"b{i}"] == 1)
        if not binary:
            out.append(c)
    return out


# ---------------------------------------------------------------- moments

def describe(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max per column.

    One scan for the moments, and those of the quantiles.
    """
    cols = list(columns)
    st = value_stats(df, cols, {
        "count": lambda c: F.count(F.col(c)),
        "mean": lambda c: F.avg(F.col(c).cast("double")),
        "std": lambda c: F.stddev_samp(F.col(c).cast("double")),
        "min": lambda c: F.min(F.col(c).cast("double")),
        "max": lambda c: F.max(F.col(c).cast("double"))})
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
    rows = [(c, st[c]["count"], st[c]["mean"], st[c]["std"], st[c]["min"], *qs[c], st[c]["max"])
            for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column string, count bigint, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")


def _attach(base: DataFrame, qs: dict, names: Sequence[str]) -> DataFrame:
    """Add fitted per-column scalars as literal lookups (no join)."""
    for j, n in enumerate(names):
        m = F.create_map(*[x for c, v in qs.items() for x in
                           (F.lit(c), F.lit(v[j]).cast("double"))])
        base = base.withColumn(n, m[F.col("column")])
    return base


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness per column (A10)."""
    return _long(df, columns, {"skewness": skewness_adjusted})


def variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample variance per column."""
    return _long(df, columns, {"variance": lambda c: F.var_samp(F.col(c).cast("double"))})


# ---------------------------------------------------------------- outliers, box, histogram

def iqr_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5,
                 approx: bool = False) -> DataFrame:
    """Q1, Q3, bounds Q1-k*IQR / Q3+k*IQR and the count strictly outside them."""
    cols = list(columns)
    qs = quantiles(df, cols, [0.25, 0.75], approx=approx)
    bounds = {c: (v[0], v[1]) for c, v in qs.items()}

    def lo(c):
        q1, q3 = bounds[c]
        return None if q1 is None else q1 - k * (q3 - q1)

    def hi(c):
        q1, q3 = bounds[c]
        return None if q1 is None else q3 + k * (q3 - q1)

    base = _long(df, cols, {
        "outliers": lambda c: F.count_if((F.col(c) < F.lit(lo(c))) | (F.col(c) > F.lit(hi(c)))),
        "whisker_low": lambda c: F.min(F.when(F.col(c) >= F.lit(lo(c)), F.col(c).cast("double"))),
        "whisker_high": lambda c: F.max(F.when(F.col(c) <= F.lit(hi(c)), F.col(c).cast("double"))),
    })
    base = _attach(base, {c: [q1, q3, None if q1 is None else q3 - q1, lo(c), hi(c)]
                          for c, (q1, q3) in bounds.items()},
                   ["q1", "q3", "iqr", "lower", "upper"])
    return base.select("column", "q1", "q3", "iqr", "lower", "upper", "outliers",
                       "whisker_low", "whisker_high")


def box_stats(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """min, Q1, median, Q3, max per column - the numbers behind a box plot."""
    cols = list(columns)
    st = value_stats(df, cols, {"min": lambda c: F.min(F.col(c).cast("double")),
                                "max": lambda c: F.max(F.col(c).cast("double"))})
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
    rows = [(c, st[c]["min"], *qs[c], st[c]["max"]) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column string, min double, q1 double, median double, q3 double, max double")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram ``(bucket, lower, upper, count)`` over [min, max].

    The top edge falls in the last bucket (numpy / seaborn convention).
    """
    mn, mx = df.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    if mn is None:
        return df.sparkSession.createDataFrame(
            [], "bucket int, lower double, upper double, count long")
    width = (mx - mn) / bins if mx > mn else 1.0
    x = F.col(column).cast("double")
    b = F.when(x.isNotNull(), F.least(F.floor((x - F.lit(mn)) / F.lit(width)).cast("int"),
                                      F.lit(bins - 1)))
    counts = df.select(b.alias("bucket")).where("bucket is not null").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("count"))
    return counts.select(
        "bucket",
        (F.lit(mn) + F.col("bucket") * F.lit(width)).alias("lower"),
        (F.lit(mn) + (F.col("bucket") + 1) * F.lit(width)).alias("upper"),
        "count")


def density(df: DataFrame, features: Sequence[str], target: str, bins: int = 20) -> DataFrame:
    """``(feature, x_bin, y_bin, count)``: the table behind scatter plots of every feature against the target.

    Edges are equal-width over each column's finite range, from one scan; one more counts all
    features together.  At most ``len(features) * bins**2`` rows whatever the data.  Rows
    without a finite feature or target value are in no cell; a constant column has bin 0.
    """
    feats = list(features)

    def finite(c):
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)

    cols = [*feats, target]
    edges = df.agg(*[e for i, c in enumerate(cols) for e in (F.min(finite(c)).alias(f"a{i}"), F.max(finite(c)).alias(f"b{i}"))]).first()

    def cell(i):
        a, b = edges[f"a{i}"], edges[f"b{i}"]
        if a is None or not b > a:
            return F.when(finite(cols[i]).isNotNull(), 0)
        x = finite(cols[i])         # guarded: ``least`` passes over a NULL
        return F.when(x.isNotNull(), F.least(F.floor((x - a) / ((b - a) / bins)).cast("int"), F.lit(bins - 1)))

    y = cell(len(feats))
    rows = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), cell(i).alias("x_bin"), y.alias("y_bin"))
                                        for i, c in enumerate(feats)])))
    return rows.dropna().groupBy("feature", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- correlation

def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for all ordered pairs, long form ``(a, b, r)``.

    ``k(k-1)/2`` guarded correlations in one aggregation; the diagonal is 1 for a
    non-constant column and NULL for a constant one (pandas gives NaN there).
    """
    cols = list(columns)
    exprs, idx = [], {}
    for i, a in enumerate(cols):
        exprs.append(F.when(F.stddev_pop(F.col(a).cast("double")) > 0, F.lit(1.0))
                     .alias(f"r{i}_{i}"))
        for j in range(i + 1, len(cols)):
            exprs.append(safe_corr(a, cols[j]).alias(f"r{i}_{j}"))
    wide = df.agg(*exprs)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            name = f"r{min(i, j)}_{max(i, j)}"
            rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(name).alias("r")))
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- fold-score summary

def score_summary(scores: DataFrame, group: str = "model", value: str = "score",
                  probs: Sequence[float] = (0.025, 0.075)) -> DataFrame:
    """Mean, population std, mean +/- 2 std and quantiles of fold scores per model.

    Groups are as large as the fold count (a parameter), so the grouped exact
    ``percentile`` holds a bounded number of values per group.
    """
    v = F.col(value).cast("double")
    q = F.percentile(v, F.array(*[F.lit(p) for p in probs]))
    out = scores.groupBy(group).agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                                    F.stddev_pop(v).alias("std"), q.alias("_q"))
    cols = [F.col(group), "n", "mean", "std",
            (F.col("mean") - 2 * F.col("std")).alias("low_2std"),
            (F.col("mean") + 2 * F.col("std")).alias("high_2std")]
    cols += [F.col("_q")[i].alias(f"q{str(p).replace('0.', '')}") for i, p in enumerate(probs)]
    return out.select(*cols)
