"""Numeric expressions: coercing parse, range buckets, guarded correlation, skewness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veld.functions._col import as_col

# Belgian postcode ranges -> province, half-open [lo, hi).
POSTCODE_PROVINCES = [
    (1000, 1300, "Brussels"),
    (1300, 2000, "Brabant_Walloon"),
    (2000, 3000, "Antwerp"),
    (3000, 3500, "Flemish Brabant"),
    (3500, 4000, "Limburg"),
    (4000, 5000, "Liège"),
    (5000, 6000, "Namur"),
    (6000, 7000, "Luxembourg"),
    (7000, 8000, "Hainaut"),
    (8000, 9000, "West Flanders"),
    (9000, 10000, "East Flanders"),
]


def parse_int(c) -> Column:
    """Python ``int(str(x).strip())`` or NULL: optional sign and digits only."""
    s = F.regexp_replace(as_col(c).cast("string"), r"^\s+|\s+$", "")
    return F.when(s.rlike(r"^[+-]?[0-9]{1,18}$"), s.cast("long"))


def parse_double(c) -> Column:
    """Coercing numeric parse (``pd.to_numeric(errors='coerce')``)."""
    return as_col(c).cast("string").try_cast("double")


def range_bucket(c, ranges=POSTCODE_PROVINCES) -> Column:
    """Label from the first half-open range ``[lo, hi)`` holding the parsed code."""
    code = parse_int(c)
    out = None
    for lo, hi, label in ranges:
        cond = (code >= lo) & (code < hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def safe_corr(a, b) -> Column:
    """Pearson r on pairwise-complete rows; NULL when either side is constant.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant column; pandas gives NaN,
    which never passes a threshold.  Same value as ``corr`` otherwise.
    """
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a)
    bb = F.when(both, b)
    return F.try_divide(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def skewness_adjusted(c) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``skew``); NULL for n < 3 or constant."""
    x = as_col(c).cast("double")
    n = F.count(x).cast("double")
    # Spark's skewness is the population form g1 = sqrt(n) m3 / m2^1.5 (stable moments)
    return F.when((n >= 3) & (F.var_pop(x) > 0),
                  F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))
