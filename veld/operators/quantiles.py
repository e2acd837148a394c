"""Exact quantiles (linear interpolation, pandas / ``quantile_cont`` semantics) at scale.

Spark's exact ``percentile`` keeps a map of every distinct value and merges it in one task for a
global aggregate; on a 100 TB column that map does not fit.  Here order statistics (ranks
``floor(h)`` and ``ceil(h)`` with ``h = (n-1)p``) are found by counting digits.

A scan groups all columns at once by (cell, digit) and keeps count, least and greatest value of
each sub-cell; a running sum inside each cell says which sub-cells hold the wanted ranks.  A sub-cell
of one value ends the search for its ranks, the others are the cells of the next scan.  Digits
are any functions that never decrease: ``scale_digit`` in the first scan (sign, and the logarithm in
steps of 4 %), then the place between the cell's least and greatest value in 2^16 equal parts.  As a
cell of 4 % has at most 2^48 different doubles, evenly spaced, three more scans end every search.
When the open cells together hold at most ``by_value_rows`` rows, the next scan's digit is the value
itself.  So there are

* at most four scans whatever the distribution, two for up to some millions of rows;
* at most 70,000 groups for each cell of a scan (``by_value_rows`` in all in a scan by value), and
  open cells are at most twice the probabilities for each column;
* one collected row for each rank: running sums are a window per cell, not driver work.

Infinities are ordinary largest and smallest values, both zeros are one value, NaN is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a cell, steps of the first digit to a factor of two, and columns of one scan
#: (generated code stays in bounds).
PARTS, STEPS, COLUMNS = 1 << 16, 16, 100


def _val(c: str) -> Column:
    """The column as DOUBLE with NaN treated as missing (pandas skips NaN too)."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def scale_digit(x: Column) -> Column:
    """A whole number that never decreases with ``x``: sign and logarithm in ``STEPS`` to a factor of two.
    Least and greatest logarithm of a finite double are -1074 and 1024, so sides don't meet."""
    a = F.abs(x)
    size = F.when(a == float("inf"), 1100.0 * STEPS).otherwise(F.floor(F.log2(a) * STEPS).cast("double"))
    return F.when(x == 0.0, 0.0).otherwise(F.signum(x) * (size + 1100.0 * STEPS))


def _ranks(n: Column, probs: Sequence[float]) -> Column:
    """The ranks that the probabilities need of ``n`` values."""
    out = []
    for p in probs:
        h = F.floor((n - 1) * F.lit(p))
        out += [h, F.least(h + 1, n - 1)]
    return F.array_distinct(F.array(*out))


def _melted(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One row for each struct (cell, digit, v) that has a value."""
    return df.select(F.inline(F.array(*structs))).filter("v IS NOT NULL")


def _hits(rows: DataFrame, wanted: Column) -> list:
    """The sub-cells that hold wanted ranks, which count from the start of their cell."""
    inside = Window.partitionBy("cell")
    cells = rows.groupBy("cell", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")) \
        .withColumn("before", F.sum("n").over(inside.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")) \
        .withColumn("total", F.sum("n").over(inside)).withColumn("ranks", wanted)
    hits = F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    return cells.withColumn("hits", hits).filter(F.size("hits") > 0).drop("ranks").collect()


def order_statistics(df: DataFrame, columns: dict[int, str], probs: Sequence[float],
                     by_value_rows: int) -> tuple[dict, dict]:
    """``{column number: rows}`` and ``{(column number, rank): value}``."""
    values: dict = {}
    # an open cell: its column, least and greatest value, rows, and wanted ranks (in the column, in the cell)
    first = [F.struct(F.lit(i).alias("cell"), scale_digit(_val(c)).alias("digit"), _val(c).alias("v")) for i, c in columns.items()]
    found = _hits(_melted(df, first), _ranks(F.col("total"), probs))
    totals = {r["cell"]: r["total"] for r in found}
    cells = [_cell(r["cell"], r, {k: k for k in r["hits"]}, values) for r in found]
    while cells := [c for c in cells if c]:
        by_value = sum(c["n"] for c in cells) <= by_value_rows
        of_column: dict[int, Column] = {}
        for number, cell in enumerate(cells):
            x, lo, hi = _val(columns[cell["column"]]), cell["lo"], cell["hi"]
            # the parts of lo and hi are taken before the difference: no overflow, no infinity
            digit = x if by_value else F.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * PARTS).cast("double")
            one = F.when((x >= lo) & (x <= hi), F.struct(F.lit(number).alias("cell"), digit.alias("digit"), x.alias("v")))
            of_column[cell["column"]] = F.coalesce(of_column[cell["column"]], one) if cell["column"] in of_column else one
        wanted = F.element_at(F.array(*[F.array(*[F.lit(k).cast("long") for k in c["ranks"]]) for c in cells]), F.col("cell") + 1)
        found = _hits(_melted(df, list(of_column.values())), wanted)
        cells = [_cell(cells[r["cell"]]["column"], r, cells[r["cell"]]["ranks"], values) for r in found]
    return totals, values


def _cell(column: int, found, ranks: dict[int, int], values: dict) -> dict | None:
    """The sub-cell as an open cell; if it has one value, that is the value of its ranks."""
    if found["lo"] == found["hi"]:
        values.update({(column, ranks[k]): found["lo"] + 0.0 for k in found["hits"]})
        return None
    return {"column": column, "lo": found["lo"], "hi": found["hi"], "n": found["n"],
            "ranks": {k - found["before"]: ranks[k] for k in found["hits"]}}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by_value_rows: int = 1_000_000) -> dict[str, list[float | None]]:
    """``{column: [quantile for p in probs]}``; ``None`` where a column has no values."""
    cols = list(columns)
    probs = [float(p) for p in probs]
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"quantile {p} outside [0, 1]")
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    for start in range(0, len(cols) if probs else 0, COLUMNS):
        part = dict(enumerate(cols[start:start + COLUMNS]))
        totals, values = order_statistics(df, part, probs, by_value_rows)
        for i, n in totals.items():
            for j, p in enumerate(probs):
                h = (n - 1) * p
                lo = int(h)
                below, above = values[i, lo], values[i, min(lo + 1, n - 1)]
                out[part[i]][j] = below * (1.0 - (h - lo)) + above * (h - lo) if h > lo else below
    return out


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """One-pass ``percentile_approx`` (bounded sketch per column) when exactness is not needed."""
    cols = list(columns)
    if not cols:
        return {}
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs))
            for i, c in enumerate(cols)}


def value_stats(df: DataFrame, columns: Sequence[str], stats: dict) -> dict:
    """One aggregation of ``{name: fn(col) -> Column}`` statistics, per column."""
    row = df.agg(*[fn(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, fn in stats.items()]).first()
    return {c: {name: row[f"{name}_{i}"] for name in stats} for i, c in enumerate(columns)}


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              approx: bool = False, **kw) -> dict[str, list[float | None]]:
    return (approx_quantiles if approx else exact_quantiles)(df, columns, probs, **kw)
