"""Row and column cleaning: projections, type rules, filters, null rules, duplicates.

Operators P1-P10, F1-F7 and D1-D2.  Data-dependent choices (which columns are whole,
which are sparse, which parse as numbers) are made by one fused aggregation that returns
a plain Python list; the transform is then a lazy projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- projections

def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns that exist; missing names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Explicit projection in the given order."""
    return df.select(*[F.col(n) for n in names])


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Column names by type family: numeric, string, boolean."""
    want = {"numeric": NUMERIC_TYPES, "string": (T.StringType,),
            "boolean": (T.BooleanType,)}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, want)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*columns_of_kind(df, "numeric"))


def numeric_parse_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column: how many present values fail a numeric parse (P5).

    One aggregation for all columns, unpivoted to ``(column, n_present, n_failed,
    is_numeric)``; a column whose every present value parses is numeric.
    """
    cols = list(columns) if columns is not None else columns_of_kind(df, "string")
    if not cols:
        raise ValueError("no string columns to test")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count(x).alias(f"p{i}"),
                 F.count_if(x.isNotNull() & x.cast("string").try_cast("double").isNull())
                 .alias(f"f{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"p{i}").alias("n_present"),
                     F.col(f"f{i}").alias("n_failed")) for i, c in enumerate(cols)]
    return (wide.select(F.inline(F.array(*rows)))
            .withColumn("is_numeric", F.col("n_failed") == 0))


def numeric_columns_of(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    rep = numeric_parse_report(df, columns).where("is_numeric").select("column").collect()
    return [r[0] for r in rep]


# ---------------------------------------------------------------- type rules

def null_to_false(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL -> false, typed boolean; names not in the table are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("boolean"), F.lit(False))
                           for c in present})


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULL with a constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()
                           if c in df.columns})


def whole_number_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Fractional-type columns whose every present value is whole and fits a long."""
    fr = [f.name for f in df.schema.fields
          if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType))]
    cols = [c for c in (columns if columns is not None else fr) if c in fr]
    if not cols:
        return []
    row = df.agg(*[F.coalesce(F.bool_and(
        F.col(c).isNull() | ((F.col(c) == F.floor(F.col(c))) & (F.abs(F.col(c)) < 9.2e18))),
        F.lit(True)).alias(f"w{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"w{i}"]]


def convert_types(df: DataFrame, string_columns: Sequence[str] = (),
                  whole: Sequence[str] | None = None) -> DataFrame:
    """Booleans -> 0/1 int; whole-valued fractional columns -> long; listed columns ->
    string (P7, P9).  ``whole`` is the fitted list (``whole_number_columns``)."""
    string_columns = [c for c in string_columns if c in df.columns]
    if whole is None:
        whole = whole_number_columns(df, [c for c in df.columns if c not in string_columns])
    out = {}
    for f in df.schema.fields:
        if f.name in string_columns:
            out[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.BooleanType):
            out[f.name] = F.col(f.name).cast("int")
        elif f.name in whole:
            out[f.name] = F.col(f.name).cast("long")
    return df.withColumns(out) if out else df


# ---------------------------------------------------------------- filters

def _drop_conditions(true_col=None, false_col=None, not_na_col=None, na_col=None
                     ) -> list[tuple[str, Column]]:
    """(label, drop-condition) in the fixed order; a missing boolean is never dropped."""
    conds = []
    if true_col:
        conds.append((f"{true_col} is true", F.col(true_col).eqNullSafe(True)))
    if false_col:
        conds.append((f"{false_col} is false", F.col(false_col).eqNullSafe(False)))
    if not_na_col:
        conds.append((f"{not_na_col} is present", F.col(not_na_col).isNotNull()))
    if na_col:
        conds.append((f"{na_col} is missing", F.col(na_col).isNull()))
    return conds


def drop_rows_where(df: DataFrame, true_col=None, false_col=None, not_na_col=None,
                    na_col=None) -> DataFrame:
    """Drop rows where true_col is true / false_col is false / not_na_col is present /
    na_col is missing (F1).  One filter; Catalyst pushes the null tests to the scan."""
    conds = _drop_conditions(true_col, false_col, not_na_col, na_col)
    keep = F.lit(True)
    for _, c in conds:
        keep = keep & ~c
    return df.where(keep)


def drop_counts(df: DataFrame, true_col=None, false_col=None, not_na_col=None,
                na_col=None) -> DataFrame:
    """Rows each rule removes when the rules apply in sequence, from one aggregation."""
    conds = _drop_conditions(true_col, false_col, not_na_col, na_col)
    aggs, before = [], F.lit(False)
    for i, (_, c) in enumerate(conds):
        aggs.append(F.count_if(~before & c).alias(f"d{i}"))
        before = before | c
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(i + 1).alias("step"), F.lit(lbl).alias("rule"),
                     F.col(f"d{i}").alias("rows_dropped")) for i, (lbl, _) in enumerate(conds)]
    return wide.select(F.inline(F.array(*rows)))


def length_filter(df: DataFrame, column: str, length: int = 4) -> DataFrame:
    """Keep rows whose text length equals ``length``; NULL is dropped (F2)."""
    return df.where(F.length(F.col(column).cast("string")) == length)


def drop_all_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where every listed column is NULL."""
    return df.dropna(how="all", subset=list(columns))


def equality_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals ``value`` (F4); a missing column is an error."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not in table")
    return df.where(F.col(column) == F.lit(value))


def coordinate_bounds(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Latitude in [-90, 90] and longitude in [-180, 180], inclusive; NULL dropped."""
    return df.where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))


def missing_any(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where at least one listed column is NULL."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


# ---------------------------------------------------------------- sparse columns

# Texts that stand for a missing value.
MISSING_TEXTS = ["Nan", "nan"]


def nan_text_to_null(df: DataFrame, texts: Iterable[str] = MISSING_TEXTS) -> DataFrame:
    """Every string column: the texts ``Nan``/``nan`` become NULL."""
    texts = list(texts)
    return df.withColumns({c: F.when(~F.col(c).isin(texts), F.col(c))
                           for c in columns_of_kind(df, "string")})


def null_fraction(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_fraction)`` for all columns from one aggregation (A1 in share form)."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"z{i}")
                    for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"z{i}").alias("null_fraction"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def sparse_columns(df: DataFrame, threshold: float = 0.3,
                   exclude: Sequence[str] = ()) -> list[str]:
    """Columns whose null share is strictly above ``threshold`` (excluded ones kept)."""
    cols = [c for c in df.columns if c not in set(exclude)]
    if not cols:
        return []
    row = null_fraction(df, cols).where(F.col("null_fraction") > threshold).collect()
    return [r["column"] for r in row]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.3,
                        exclude: Sequence[str] = ()) -> DataFrame:
    """Missing texts -> NULL, then drop columns above the null-share threshold."""
    df = nan_text_to_null(df)
    return df.drop(*sparse_columns(df, threshold, exclude))


# ---------------------------------------------------------------- duplicates

def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that is first by ``order``.

    NULL keys group together (pandas ``drop_duplicates``).  One aggregate with a map-side
    partial step: a key holding a third of all rows is reduced on every mapper to one row
    before the shuffle.  The row crosses it once, as the struct (order, other columns) whose
    minimum is kept, so ties in ``order`` are broken by the other columns and the result
    never depends on task order or retries.  Map columns, which have no order, ride along.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    ordered = [*order, *[c for c in rest if c not in order and c not in maps]]
    first = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)])
    grouped = df.groupBy(*[F.col(k) for k in keys])
    if any(c in maps for c in rest):
        row = F.min_by(F.struct(*[F.col(c) for c in rest]), first)
        picked = grouped.agg(row.alias("_row"))
    else:
        picked = grouped.agg(F.min(first).alias("_f")).select(*keys, F.struct(
            *[F.col("_f")[f"_{ordered.index(c)}"].alias(c) for c in rest]).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)
