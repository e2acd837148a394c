"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) ->
DataFrame`` over the driver tables, with the equivalent DuckDB SQL where SQL can say it.

Doubles that depend on summation order are rounded to the same digits on both sides.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veld.functions import text as tx
from veld.functions.numeric import POSTCODE_PROVINCES
from veld.operators import clean, encode, geo, profile, select
from veld.plans.inputs import (EVENTS_N_SQL, LISTINGS_SQL, LOOKUP_RAW_SQL, ORDERS_N_SQL,
                               events_n, listings, lookup_raw, orders_n, table)
from veld.session import checkpoint_root
from veld.sources import io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LI_PLAIN = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ====================================================================== sources / sinks

@query("scan_table", f"""
SELECT {', '.join(LI_PLAIN)}, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem""")
def q_scan_table(spark, d):
    df = io.load_table(spark, f"{d}/lineitem.parquet")
    return df.select(*LI_PLAIN, F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))


@query("roundtrip_sink", f"""
SELECT source, {', '.join(LI_PLAIN)}, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem, (VALUES ('csv'), ('parquet')) AS v(source)""")
def q_roundtrip_sink(spark, d):
    """All columns saved as Parquet and CSV, both read back."""
    df = table(spark, d, "lineitem")
    out = os.path.join(checkpoint_root(spark), "sinks", uuid.uuid4().hex[:12])
    paths = io.save_table(df, "lineitem", out, sep=";")
    back = [io.load_table(spark, paths["csv"], fmt="csv", schema=df.schema, sep=";").withColumn("source", F.lit("csv")),
            io.load_table(spark, paths["parquet"]).withColumn("source", F.lit("parquet"))]
    return back[0].unionByName(back[1]).select("source", *LI_PLAIN, F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))


@query("rejected_rows", """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'price: no double: n/a' WHEN o_orderkey % 11 = 0 THEN 'id: no bigint: ' || o_orderkey || 'x'
            ELSE 'accepted' END AS reason, count(*) AS n,
       round(sum(CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN o_totalprice END), 0) AS total
FROM orders GROUP BY 1""")
def q_rejected_rows(spark, d):
    """Orders written as CSV with bad prices and ids: the rows that fit, and the others by reason."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    raw = o.select(F.when((key % 11 == 0) & (key % 7 != 0), F.concat(key.cast("string"), F.lit("x"))).otherwise(key.cast("string")).alias("id"),
                   F.when(key % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"), "o_orderpriority")
    out = os.path.join(checkpoint_root(spark), "sinks", uuid.uuid4().hex[:12])
    path = io.save_table(raw, "orders", out, sep=";")["csv"]
    rows, rejected = io.load_checked(spark, path, "id bigint, price double, o_orderpriority string", sep=";")
    good = rows.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 0).alias("total"))
    bad = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.lit(None).cast("double"))
    return good.unionByName(bad)


# ====================================================================== projections

@query("drop_column", f"""
SELECT {', '.join(c for c in LI_PLAIN if c not in ('l_tax',))} FROM lineitem""")
def q_drop_column(spark, d):
    df = table(spark, d, "lineitem")
    return clean.drop_columns(df, "l_tax", "l_shipdate", "no_such_column")


@query("select_columns", "SELECT l_orderkey, l_returnflag, l_quantity, l_extendedprice FROM lineitem")
def q_select_columns(spark, d):
    return clean.select_columns(table(spark, d, "lineitem"),
                                ["l_orderkey", "l_returnflag", "l_quantity", "l_extendedprice"])


@query("select_numeric", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def q_select_numeric(spark, d):
    return clean.select_numeric(table(spark, d, "lineitem"))


def _li_flagged(spark, d):
    li = table(spark, d, "lineitem")
    return li.withColumn("is_return", F.when(F.col("l_returnflag") == "R", 1).otherwise(0)) \
             .withColumn("returned_or_null", F.when(F.col("l_returnflag") == "R", 1)
                         .when(F.col("l_returnflag") == "A", None).otherwise(0))


def _numeric_columns_sql():
    cand = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "is_return", "returned_or_null"]
    base = ("SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return, "
            "CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN NULL ELSE 0 END "
            "AS returned_or_null FROM lineitem")
    parts = []
    for c in cand:
        parts.append(
            f"SELECT '{c}' AS column_name FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) AS z, "
            f"min({c}) AS a, max({c}) AS b, count(*) FILTER (WHERE {c} NOT IN (0, 1)) AS o FROM t) "
            f"WHERE NOT (z = 0 AND o = 0 AND a = 0 AND b = 1)")
    return f"WITH t AS ({base})\n" + _union_sql(parts)


@query("numeric_columns", _numeric_columns_sql())
def q_numeric_columns(spark, d):
    df = _li_flagged(spark, d)
    cols = profile.numeric_columns(df, exclude=["l_orderkey"])
    return spark.createDataFrame([(c,) for c in cols], "column_name string")


# ====================================================================== profiling

def _describe_sql(cols, src="lineitem"):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 8) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
            f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM {src}")
    return _union_sql(parts)


@query("describe_numeric", _describe_sql(LI_NUM))
def q_describe_numeric(spark, d):
    out = profile.describe(table(spark, d, "lineitem"), LI_NUM)
    # a mean of 2-decimal values over n rows has at most 2 + (powers of 2 and 5 in n)
    # decimals (<= 8 for n up to 600,000): 8 digits keeps exact ties off the grid edge
    return out.select(F.col("column").alias("column_name"), "count", r("mean", 8).alias("mean"),
                      *[r(c).alias(c) for c in ["std", "min", "q25", "q50", "q75", "max"]])


@query("variance_numeric", _union_sql(
    [f"SELECT '{c}' AS column_name, round(var_samp({c}), 2) AS variance FROM lineitem" for c in LI_NUM]))
def q_variance_numeric(spark, d):
    out = profile.variance(table(spark, d, "lineitem"), LI_NUM)
    # variances reach 1e9: two decimals is already 1e-11 relative
    return out.select(F.col("column").alias("column_name"), r("variance", 2).alias("variance"))


@query("skewness_adjusted", _union_sql(
    [f"SELECT '{c}' AS column_name, round(skewness({c}), 6) AS skewness FROM lineitem" for c in LI_NUM]))
def q_skewness(spark, d):
    out = profile.skewness(table(spark, d, "lineitem"), LI_NUM)
    return out.select(F.col("column").alias("column_name"), r("skewness").alias("skewness"))


def _iqr_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
       (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers,
       (SELECT round(min({c}), 6) FROM lineitem WHERE {c} >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       (SELECT round(max({c}), 6) FROM lineitem WHERE {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""")
    return _union_sql(parts)


IQR_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("iqr_outliers", _iqr_sql(IQR_COLS))
def q_iqr_outliers(spark, d):
    out = profile.iqr_outliers(table(spark, d, "lineitem"), IQR_COLS)
    return out.select(F.col("column").alias("column_name"),
                      *[r(c).alias(c) for c in ["q1", "q3", "iqr", "lower", "upper"]],
                      "outliers", r("whisker_low").alias("whisker_low"),
                      r("whisker_high").alias("whisker_high"))


@query("box_stats", _union_sql([f"""
SELECT '{c}' AS column_name, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
       round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3,
       round(max({c}), 6) AS max FROM lineitem""" for c in LI_NUM]))
def q_box_stats(spark, d):
    out = profile.box_stats(table(spark, d, "lineitem"), LI_NUM)
    return out.select(F.col("column").alias("column_name"),
                      *[r(c).alias(c) for c in ["min", "q1", "median", "q3", "max"]])


@query("histogram", """
WITH s AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
w AS (SELECT mn, (mx - mn) / 10 AS width FROM s),
b AS (SELECT least(CAST(floor((l_extendedprice - mn) / width) AS INTEGER), 9) AS bucket
      FROM lineitem, w WHERE l_extendedprice IS NOT NULL)
SELECT bucket, round(mn + bucket * width, 6) AS lower, round(mn + (bucket + 1) * width, 6) AS upper,
       count(*) AS count
FROM b, w GROUP BY bucket, mn, width""")
def q_histogram(spark, d):
    out = profile.histogram(table(spark, d, "lineitem"), "l_extendedprice", 10)
    return out.select("bucket", r("lower").alias("lower"), r("upper").alias("upper"), "count")


def _density_sql(target: str, bins: int) -> str:
    cell = lambda c: f"least(CAST(floor(({c} - a_{c}) / ((b_{c} - a_{c}) / {bins})) AS INTEGER), {bins - 1})"
    edges = ", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in LI_NUM)
    return f"WITH s AS (SELECT {edges} FROM lineitem)\n" + _union_sql(
        [f"SELECT '{c}' AS feature, {cell(c)} AS x_bin, {cell(target)} AS y_bin, count(*) AS count FROM lineitem, s GROUP BY 2, 3"
         for c in LI_NUM if c != target])


@query("scatter_density", _density_sql("l_extendedprice", 20))
def q_scatter_density(spark, d):
    feats = [c for c in LI_NUM if c != "l_extendedprice"]
    return profile.density(table(spark, d, "lineitem"), feats, "l_extendedprice", 20)


# ---------------------------------------------------------------- correlation

CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price"]
NET_SQL = "l_extendedprice * (1 - l_discount)"


def _li_net(spark, d):
    li = table(spark, d, "lineitem")
    return li.withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def _corr_sql():
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            val = (f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END" if a == b
                   else f"round(corr({a}, {b}), 9)")
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {val} AS r FROM t")
    return f"WITH t AS (SELECT *, {NET_SQL} AS net_price FROM lineitem)\n" + _union_sql(parts)


@query("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, d):
    out = profile.correlation_matrix(_li_net(spark, d), CORR_COLS)
    return out.select("a", "b", r("r", 9).alias("r"))


@query("correlation_gram", _corr_sql())
def q_correlation_gram(spark, d):
    """The same matrix by Gram matrices, the way for very many columns."""
    from veld.operators.gram import correlation_long
    return correlation_long(_li_net(spark, d), CORR_COLS).select("a", "b", r("r", 9).alias("r"))


def _corr_select_sql():
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price"]
    parts = []
    for c in cols:
        val = ("CASE WHEN stddev_pop(net_price) > 0 THEN 1.0 END" if c == "net_price"
               else f"corr({c}, net_price)")
        parts.append(f"SELECT '{c}' AS column_name, round({val}, 9) AS r, "
                     f"coalesce(abs({val}) >= 0.2, false) AS selected FROM t")
    return f"WITH t AS (SELECT *, {NET_SQL} AS net_price FROM lineitem)\n" + _union_sql(parts)


@query("correlation_select", _corr_select_sql())
def q_correlation_select(spark, d):
    df = _li_net(spark, d)
    cor = select.target_correlations(df, "net_price",
                                     exclude=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    chosen = select.correlated_columns(df, "net_price", 0.2,
                                       exclude=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return cor.select(F.col("column").alias("column_name"), r("r", 9).alias("r"),
                      F.col("column").isin(chosen).alias("selected"))


# ====================================================================== clip / scale

CLIP = {"l_extendedprice": (0.05, 0.95), "l_quantity": (0.01, 0.99), "l_discount": (0.10, 0.90)}


@query("quantile_bounds", _union_sql([
    f"SELECT '{c}' AS column_name, {lo} AS p_low, {hi} AS p_high, "
    f"round(quantile_cont({c}, {lo}), 6) AS lower, round(quantile_cont({c}, {hi}), 6) AS upper FROM lineitem"
    for c, (lo, hi) in CLIP.items()]))
def q_quantile_bounds(spark, d):
    clip = encode.QuantileClip(CLIP).fit(table(spark, d, "lineitem"))
    return clip.bounds_frame(spark).select(
        F.col("column").alias("column_name"), F.col("p_low").cast("decimal(3,2)").alias("p_low"),
        F.col("p_high").cast("decimal(3,2)").alias("p_high"), r("lower").alias("lower"),
        r("upper").alias("upper"))


def _clip_sql():
    qs = ", ".join(f"quantile_cont({c}, {lo}) AS lo_{c}, quantile_cont({c}, {hi}) AS hi_{c}"
                   for c, (lo, hi) in CLIP.items())
    sel = ", ".join(f"round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END, 6) AS {c}"
                    for c in CLIP)
    return (f"WITH q AS (SELECT {qs} FROM lineitem)\n"
            f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sel} FROM lineitem, q")


@query("quantile_clip", _clip_sql())
def q_quantile_clip(spark, d):
    li = table(spark, d, "lineitem")
    clipped = encode.QuantileClip(CLIP).fit(li).transform(li)
    return clipped.select(*LI_KEYS, *[r(c).alias(c) for c in CLIP])


@query("standard_scale", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round((l_quantity - mq) / sq, 6) + 0.0 AS l_quantity,
       round((l_extendedprice - mp) / sp, 6) + 0.0 AS l_extendedprice
FROM lineitem, s""")
def q_standard_scale(spark, d):
    li = table(spark, d, "lineitem")
    sc = encode.Standardizer(["l_quantity", "l_extendedprice"]).fit(li).transform(li)
    # one value per row: 6 digits keeps cross-engine noise (~1e-14) off the rounding edge
    # (+ 0.0 turns a rounded -0.0 into 0.0 in both engines)
    return sc.select(*LI_KEYS, (r("l_quantity", 6) + 0.0).alias("l_quantity"),
                     (r("l_extendedprice", 6) + 0.0).alias("l_extendedprice"))


# ====================================================================== target encoding

TE_COLS = ["l_returnflag", "l_linestatus"]


@query("target_encode_mapping", _union_sql([
    f"SELECT '{c}' AS column_name, {c} AS category, round(avg(l_extendedprice), 8) AS encoded, "
    f"count(*) AS rows FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}" for c in TE_COLS]))
def q_target_encode_mapping(spark, d):
    li = table(spark, d, "lineitem")
    enc = encode.TargetEncoder(TE_COLS, "l_extendedprice").fit(li)
    out = os.path.join(checkpoint_root(spark), "mappings", uuid.uuid4().hex[:12])
    enc.save(out)                                      # one folder per encoded column
    back = spark.read.parquet(out)
    return back.select(F.col("column").alias("column_name"), "category",
                       r("encoded", 8).alias("encoded"), "rows")


@query("target_encode", """
WITH a AS (SELECT l_returnflag AS k, avg(l_extendedprice) AS v FROM lineitem GROUP BY 1),
     b AS (SELECT l_linestatus AS k, avg(l_extendedprice) AS v FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       round(a.v, 8) AS l_returnflag_encoded, round(b.v, 8) AS l_linestatus_encoded
FROM lineitem LEFT JOIN a ON l_returnflag = a.k LEFT JOIN b ON l_linestatus = b.k""")
def q_target_encode(spark, d):
    li = table(spark, d, "lineitem").select(*LI_KEYS, "l_returnflag", "l_linestatus",
                                             "l_extendedprice")
    out = encode.TargetEncoder(TE_COLS, "l_extendedprice").fit(li).transform(li)
    return out.select(*LI_KEYS, "l_returnflag", r("l_returnflag_encoded", 8).alias("l_returnflag_encoded"),
                      r("l_linestatus_encoded", 8).alias("l_linestatus_encoded"))


# ====================================================================== duplicates

@query("dedup_first", f"""
SELECT {', '.join(LI_PLAIN)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LI_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_first(spark, d):
    li = table(spark, d, "lineitem").select(*LI_PLAIN)
    return clean.dedup_first(li, ["l_orderkey"], LI_ORDER)


DEDUP2_SQL_SRC = ("SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_returnflag, "
                  "l_suppkey AS supp_orig, "
                  "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey, "
                  "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem")


@query("dedup_composite", f"""
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_returnflag, supp_orig, l_suppkey, flag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, flag
                               ORDER BY l_orderkey, l_linenumber, l_partkey, supp_orig, l_extendedprice) AS rn
  FROM ({DEDUP2_SQL_SRC})) WHERE rn = 1""")
def q_dedup_composite(spark, d):
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey")
    src = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag",
                    F.col("l_suppkey").alias("supp_orig"),
                    F.when(k % 11 == 0, None).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
                    F.when(k % 5 == 0, None).otherwise(F.col("l_returnflag")).alias("flag"))
    return clean.dedup_first(src, ["l_suppkey", "flag"],
                             ["l_orderkey", "l_linenumber", "l_partkey", "supp_orig", "l_extendedprice"])


# ====================================================================== orders: categories

PRIORITY_GROUPS = {"Urgent": ["1-URGENT", "2-HIGH"], "Normal": ["3-MEDIUM"],
                   "Low": ["4-NOT SPECIFIED", "5-LOW"]}


@query("value_counts_pct", f"""
WITH t AS ({ORDERS_N_SQL})
SELECT o_orderpriority AS value, count(*) AS count,
       round(100.0 * count(*) / (SELECT count(o_orderpriority) FROM t), 2) AS percentage
FROM t WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def q_value_counts_pct(spark, d):
    return profile.value_counts(orders_n(spark, d), "o_orderpriority", over="present")


def _combine_sql():
    flat = encode.compose_groups(PRIORITY_GROUPS)
    case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in flat.items())
    return f"""
WITH t AS ({ORDERS_N_SQL}),
g AS (SELECT CASE coalesce(o_orderpriority, 'nan') {case} ELSE coalesce(o_orderpriority, 'nan') END AS value FROM t)
SELECT value, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM t), 2) AS percentage
FROM g GROUP BY 1"""


@query("combine_categories", _combine_sql())
def q_combine_categories(spark, d):
    o = orders_n(spark, d)
    g = o.withColumn("o_orderpriority", encode.combine_categories("o_orderpriority", PRIORITY_GROUPS))
    return profile.value_counts(g, "o_orderpriority", over="all")


RECODE = {"P": "F", "O": "Open"}


@query("recode_categories", f"""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)
SELECT o_orderkey, CASE s WHEN 'P' THEN 'F' WHEN 'O' THEN 'Open' ELSE s END AS o_orderstatus FROM t""")
def q_recode_categories(spark, d):
    o = table(spark, d, "orders")
    s = F.when(F.col("o_orderkey") % 17 == 0, None).otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", encode.recode(s, RECODE).alias("o_orderstatus"))


def _onehot_sql():
    cats = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    cols = ", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS \"prio_{v}\""
                     for v in cats[1:])
    return f"WITH t AS ({ORDERS_N_SQL})\nSELECT o_orderkey, {cols} FROM t"


@query("one_hot_vectors", """
WITH c AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority DESC) - 1 AS code, count(*) OVER () AS size
           FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o_orderkey, CASE WHEN code < size - 1 THEN CAST(code AS INTEGER) END AS dummy, CAST(size - 1 AS INTEGER) AS size
FROM orders JOIN c ON o_orderpriority = v""")
def q_one_hot_vectors(spark, d):
    """The sparse dummies of each order: which one is set, and the vector's size."""
    from pyspark.ml.functions import vector_to_array
    o = table(spark, d, "orders")
    v = encode.one_hot_vectors(o, "o_orderpriority", encode.ordinal_codes(o, "o_orderpriority"), "v")
    dense = vector_to_array("v")
    return v.select("o_orderkey", F.nullif(F.array_position(dense, 1.0) - 1, F.lit(-1)).cast("int").alias("dummy"), F.size(dense).alias("size"))


@query("one_hot_drop_first", _onehot_sql())
def q_one_hot(spark, d):
    o = orders_n(spark, d).select("o_orderkey", "o_orderpriority")
    return encode.one_hot_drop_first(o, "o_orderpriority", prefix="prio_")


STATUS_ORDER = ["F", "O", "P"]


@query("ordinal_encode", f"""
WITH t AS ({ORDERS_N_SQL}),
c AS (SELECT v, CAST(row_number() OVER (ORDER BY v DESC) - 1 AS DOUBLE) AS code
      FROM (SELECT DISTINCT o_orderpriority AS v FROM t WHERE o_orderpriority IS NOT NULL))
SELECT o_orderkey, c.code AS priority_code,
       CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS DOUBLE) AS status_code
FROM t LEFT JOIN c ON t.o_orderpriority = c.v""")
def q_ordinal_encode(spark, d):
    o = orders_n(spark, d)
    o = encode.ordinal_encode(o, "o_orderpriority", encode.ordinal_codes(o, "o_orderpriority"), "priority_code")
    return o.select("o_orderkey", "priority_code",
                    encode.ordinal_expr("o_orderstatus", STATUS_ORDER, unknown="error")
                    .alias("status_code"))


def _profile_sql(threshold):
    parts = []
    for c in ["o_orderstatus", "o_orderpriority"]:
        parts.append(f"""
SELECT '{c}' AS column_name, {c} AS value, count(*) AS count,
       round(100.0 * count(*) / (SELECT count({c}) FROM t), 6) AS percentage,
       100.0 * count(*) / (SELECT count({c}) FROM t) < {threshold * 100} AS rare
FROM t WHERE {c} IS NOT NULL GROUP BY {c}""")
    return f"WITH t AS ({ORDERS_N_SQL})\n" + _union_sql(parts)


@query("category_profile", _profile_sql(0.05))
def q_category_profile(spark, d):
    out = profile.category_profile(orders_n(spark, d), ["o_orderstatus", "o_orderpriority"], 0.05)
    return out.select(F.col("column").alias("column_name"), "value", "count",
                      r("percentage").alias("percentage"), "rare")


@query("rare_categories", f"SELECT * FROM ({_profile_sql(0.25)}) WHERE rare")
def q_rare_categories(spark, d):
    out = profile.category_profile(orders_n(spark, d), ["o_orderstatus", "o_orderpriority"], 0.25)
    return out.where("rare").select(F.col("column").alias("column_name"), "value", "count",
                                    r("percentage").alias("percentage"), "rare")


@query("equality_filter", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def q_equality_filter(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return clean.equality_filter(o, "o_orderstatus", "F")


# ====================================================================== splits

def _hash_sql(key_sql: str, seed: str, modulo: int) -> str:
    return (f"((('0x' || substr(md5('{seed}:' || {key_sql}), 1, 8))::BIGINT) % {modulo})")


@query("holdout_split", f"""
SELECT o_orderkey, {_hash_sql("CAST(o_orderkey AS VARCHAR)", "42", 10000)} < 2000 AS is_test FROM orders""")
def q_holdout_split(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", select.split_flag(["o_orderkey"], 0.2, 42).alias("is_test"))


@query("kfold_assign", f"""
SELECT o_orderkey, CAST({_hash_sql("CAST(o_orderkey AS VARCHAR)", "fold42", 6)} AS INTEGER) AS fold FROM orders""")
def q_kfold_assign(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", select.fold_column(["o_orderkey"], 6, 42).alias("fold"))


# ====================================================================== events: nulls

EVENT_COLS = ["event_id", "user_id", "event_type", "value", "props", "big"]


@query("null_counts", f"WITH t AS ({EVENTS_N_SQL})\n" + _union_sql(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM t" for c in EVENT_COLS]))
def q_null_counts(spark, d):
    return profile.null_counts(events_n(spark, d)).withColumnRenamed("column", "column_name")


@query("null_fraction", f"WITH t AS ({EVENTS_N_SQL})\n" + _union_sql(
    [f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS null_fraction FROM t"
     for c in EVENT_COLS]))
def q_null_fraction(spark, d):
    out = clean.null_fraction(events_n(spark, d))
    return out.select(F.col("column").alias("column_name"), r("null_fraction", 9).alias("null_fraction"))


@query("drop_sparse_columns", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, user_id, CASE WHEN event_type IN ('Nan', 'nan') THEN NULL ELSE event_type END AS event_type
FROM t""")
def q_drop_sparse_columns(spark, d):
    return clean.drop_sparse_columns(events_n(spark, d), threshold=0.3)


@query("conditional_missing_pct", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT count(*) FILTER (WHERE big) AS flag_rows,
       count(*) FILTER (WHERE big AND user_id IS NULL) AS missing_rows,
       round(100.0 * count(*) FILTER (WHERE big AND user_id IS NULL) / nullif(count(*) FILTER (WHERE big), 0), 6)
           AS missing_pct FROM t""")
def q_conditional_missing_pct(spark, d):
    out = profile.conditional_missing_pct(events_n(spark, d), "big", "user_id")
    return out.select("flag_rows", "missing_rows", r("missing_pct").alias("missing_pct"))


DROP_RULES = dict(true_col="big", not_na_col="props", na_col="user_id")


@query("conditional_row_drop", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, user_id, event_type, value FROM t
WHERE big IS NOT TRUE AND props IS NULL AND user_id IS NOT NULL""")
def q_conditional_row_drop(spark, d):
    out = clean.drop_rows_where(events_n(spark, d), **DROP_RULES)
    return out.select("event_id", "user_id", "event_type", "value")


@query("drop_counts", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT 1 AS step, 'big is true' AS rule, count(*) FILTER (WHERE big IS TRUE) AS rows_dropped FROM t
UNION ALL
SELECT 2, 'props is present', count(*) FILTER (WHERE big IS NOT TRUE AND props IS NOT NULL) FROM t
UNION ALL
SELECT 3, 'user_id is missing',
       count(*) FILTER (WHERE big IS NOT TRUE AND props IS NULL AND user_id IS NULL) FROM t""")
def q_drop_counts(spark, d):
    return clean.drop_counts(events_n(spark, d), **DROP_RULES)


@query("drop_all_missing", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, user_id, event_type, value FROM t
WHERE NOT (user_id IS NULL AND event_type IS NULL AND value IS NULL)""")
def q_drop_all_missing(spark, d):
    out = clean.drop_all_missing(events_n(spark, d), ["user_id", "event_type", "value"])
    return out.select("event_id", "user_id", "event_type", "value")


@query("missing_any", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, user_id, value FROM t WHERE user_id IS NULL OR value IS NULL""")
def q_missing_any(spark, d):
    return clean.missing_any(events_n(spark, d), ["user_id", "value"]).select("event_id", "user_id", "value")


@query("null_to_false", f"WITH t AS ({EVENTS_N_SQL})\nSELECT event_id, coalesce(big, false) AS big FROM t")
def q_null_to_false(spark, d):
    return clean.null_to_false(events_n(spark, d), ["big", "no_such_column"]).select("event_id", "big")


@query("fill_constant", f"WITH t AS ({EVENTS_N_SQL})\nSELECT event_id, coalesce(value, 0.0) AS value FROM t")
def q_fill_constant(spark, d):
    return clean.fill_constant(events_n(spark, d), {"value": 0.0}).select("event_id", "value")


_MODE_SQL = """(SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""


@query("mode_fill", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, coalesce(event_type, {_MODE_SQL.format(c='event_type')}) AS event_type,
       coalesce(user_id, {_MODE_SQL.format(c='user_id')}) AS user_id FROM t""")
def q_mode_fill(spark, d):
    e = events_n(spark, d)
    out = encode.fill_missing(e, ["event_type", "user_id"], method="mode")
    return out.select("event_id", "event_type", "user_id")


@query("median_fill", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM t)), 6) AS value FROM t""")
def q_median_fill(spark, d):
    out = encode.fill_missing(events_n(spark, d), ["value"], method="median")
    return out.select("event_id", r("value").alias("value"))


@query("mean_fill", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM t)), 6) AS value FROM t""")
def q_mean_fill(spark, d):
    out = encode.fill_missing(events_n(spark, d), ["value"], method="mean")
    return out.select("event_id", r("value").alias("value"))


@query("convert_types", f"""
WITH t AS ({EVENTS_N_SQL})
SELECT event_id, CAST(big AS INTEGER) AS big, CAST(floor(value) AS BIGINT) AS value_whole, value,
       CAST(user_id AS BIGINT) AS user_id_d, CAST(user_id AS VARCHAR) AS user_text FROM t""")
def q_convert_types(spark, d):
    e = events_n(spark, d).select(
        "event_id", "big", F.floor("value").cast("double").alias("value_whole"), "value",
        F.col("user_id").cast("double").alias("user_id_d"), F.col("user_id").alias("user_text"))
    return clean.convert_types(e, string_columns=["user_text"])


@query("try_numeric_columns", f"""
WITH t AS (SELECT *, CAST(user_id AS VARCHAR) AS uid_text FROM ({EVENTS_N_SQL}))
""" + _union_sql([
    f"SELECT '{c}' AS column_name, count({c}) AS n_present, "
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS n_failed, "
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) = 0 AS is_numeric FROM t"
    for c in ["event_type", "props", "uid_text"]]))
def q_try_numeric_columns(spark, d):
    e = events_n(spark, d).withColumn("uid_text", F.col("user_id").cast("string"))
    out = clean.numeric_parse_report(e, ["event_type", "props", "uid_text"])
    return out.withColumnRenamed("column", "column_name")


@query("table_summary", f"WITH t AS ({EVENTS_N_SQL})\nSELECT * FROM t ORDER BY event_id LIMIT 15")
def q_table_summary(spark, d):
    head, _ = profile.table_summary(events_n(spark, d), ["event_id"], 15)
    return head


@query("table_info", f"WITH t AS ({EVENTS_N_SQL})\n" + _union_sql(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS rows FROM t"
     for c in EVENT_COLS]))
def q_table_info(spark, d):
    _, info = profile.table_summary(events_n(spark, d), ["event_id"], 15)
    return info.select(F.col("column").alias("column_name"), "nulls", "rows")


# ====================================================================== text

def _cap_sql(x):
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


@query("text_capitalize", f"""
SELECT p_partkey, {_cap_sql("replace(p_name, '_', ' ')")} AS name_cap,
       {_cap_sql("replace(p_type || '_' || p_brand, '_', ' ')")} AS type_cap FROM part""")
def q_text_capitalize(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", tx.capitalize("p_name").alias("name_cap"),
                    tx.capitalize(F.concat(F.col("p_type"), F.lit("_"), F.col("p_brand"))).alias("type_cap"))


_TITLE_SQL = ("array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)'), "
              "lambda s: upper(substr(s, 1, 1)) || lower(substr(s, 2))), '')")


@query("text_title", f"""
SELECT p_partkey, {_TITLE_SQL.format(x="upper(p_name) || '-l''' || p_brand")} AS name_title,
       {_TITLE_SQL.format(x="p_type || ' 2nd'")} AS type_title FROM part""")
def q_text_title(spark, d):
    p = table(spark, d, "part")
    a = F.concat(F.upper("p_name"), F.lit("-l'"), F.col("p_brand"))
    b = F.concat(F.col("p_type"), F.lit(" 2nd"))
    return p.select("p_partkey", tx.title_case(a).alias("name_title"), tx.title_case(b).alias("type_title"))


@query("text_strip_code", f"""
WITH t AS ({LISTINGS_SQL})
SELECT id, regexp_replace(locality_raw, '\\s*\\(\\d+\\)', '', 'g') AS locality FROM t""")
def q_text_strip_code(spark, d):
    return listings(spark, d).select("id", tx.strip_code("locality_raw").alias("locality"))


def _norm_sql(x):
    s = f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"
    s = f"regexp_replace({s}, 'str\\.', 'straat', 'g')"
    s = f"regexp_replace({s}, '\\bave\\b', 'avenue', 'g')"
    s = f"regexp_replace({s}, '\\bblvd\\b', 'boulevard', 'g')"
    return f"regexp_replace(regexp_replace({s}, '\\s+', ' ', 'g'), '^ | $', '', 'g')"


def _cands_sql():
    st, nu, pc, lo = ("coalesce(street, 'nan')", "coalesce(number, 'nan')",
                      "coalesce(Postal_code, 'nan')", "coalesce(locality_name, 'nan')")
    return [f"{st} || ' ' || {nu} || ', ' || {pc} || ' ' || {lo}",
            f"{st} || ' ' || {nu} || ', ' || {lo}",
            f"{lo} || ' ' || {pc}", lo]


@query("normalize_address", f"""
WITH t AS ({LISTINGS_SQL})
SELECT id, {_norm_sql('street')} AS street_norm,
       {', '.join(f'{_norm_sql(c)} AS k{i + 1}' for i, c in enumerate(_cands_sql()))} FROM t""")
def q_normalize_address(spark, d):
    li = listings(spark, d)
    cand = tx.address_candidates()
    return li.select("id", tx.normalize_address("street").alias("street_norm"),
                     *[tx.normalize_address(cand[i]).alias(f"k{i + 1}") for i in range(4)])


@query("length_filter", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS code FROM customer WHERE length(CAST(c_custkey AS VARCHAR)) = 4")
def q_length_filter(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("code"))
    return clean.length_filter(c, "code", 4)


CODE_SQL = ("CASE c_custkey % 5 WHEN 0 THEN ' ' || CAST((c_custkey * 7) % 11000 AS VARCHAR) || ' ' "
            "WHEN 1 THEN 'abc' WHEN 2 THEN NULL ELSE CAST((c_custkey * 13) % 12000 AS VARCHAR) END")


def _code(c):
    k = F.col("c_custkey")
    return (F.when(k % 5 == 0, F.concat(F.lit(" "), ((k * 7) % 11000).cast("string"), F.lit(" ")))
            .when(k % 5 == 1, F.lit("abc")).when(k % 5 == 2, F.lit(None).cast("string"))
            .otherwise(((k * 13) % 12000).cast("string")))


def _province_sql(x):
    code = (f"CASE WHEN regexp_full_match(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '[+-]?[0-9]{{1,18}}') "
            f"THEN CAST(regexp_replace({x}, '^\\s+|\\s+$', '', 'g') AS BIGINT) END")
    whens = " ".join(f"WHEN ({code}) >= {lo} AND ({code}) < {hi} THEN '{lab}'"
                     for lo, hi, lab in POSTCODE_PROVINCES)
    return f"CASE {whens} END"


@query("range_bucket", f"""
WITH t AS (SELECT c_custkey, {CODE_SQL} AS code FROM customer)
SELECT c_custkey, code, {_province_sql('code')} AS Province FROM t""")
def q_range_bucket(spark, d):
    c = table(spark, d, "customer").select("c_custkey", _code("c_custkey").alias("code"))
    return geo.add_province(c, "code")


@query("range_filter", """
WITH t AS (SELECT c_custkey, c_acctbal / 10.0 AS lat, CAST(c_nationkey * 10 - 100 AS DOUBLE) AS lon FROM customer)
SELECT * FROM t WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180""")
def q_range_filter(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 10.0).alias("lat"),
        (F.col("c_nationkey") * 10 - 100).cast("double").alias("lon"))
    return clean.coordinate_bounds(c, "lat", "lon")


@query("left_join_lookup", """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_left_join_lookup(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")          # Spark broadcasts by bytes
    rg = table(spark, d, "region")
    out = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    out = out.join(rg, out.n_regionkey == rg.r_regionkey, "left")
    return out.select("c_custkey", "n_name", "r_name")


# ====================================================================== geo

def _lookup_sql():
    return f"""
lk AS (SELECT address_key, arg_min(lat, struct_pack(o := orig, a := lat, b := lon)) AS lat,
              arg_min(lon, struct_pack(o := orig, a := lat, b := lon)) AS lon FROM (
         SELECT {_norm_sql('address_key')} AS address_key, address_key AS orig, lat, lon
         FROM ({LOOKUP_RAW_SQL}) WHERE lat IS NOT NULL AND lon IS NOT NULL) GROUP BY address_key)"""


def _fallback_sql():
    c = _cands_sql()
    joins = "\n".join(
        f"LEFT JOIN lk j{i} ON m AND j{i}.address_key = {_norm_sql(c[i])}" for i in range(4))
    hit = lambda f: f"coalesce(j0.{f}, j1.{f}, j2.{f}, j3.{f})"
    lat = f"CASE WHEN j0.address_key IS NOT NULL THEN j0.lat WHEN j1.address_key IS NOT NULL THEN j1.lat WHEN j2.address_key IS NOT NULL THEN j2.lat ELSE j3.lat END"
    lon = lat.replace(".lat", ".lon")
    del hit
    return f"""
WITH t AS (SELECT *, latitude IS NULL OR longitude IS NULL AS m FROM ({LISTINGS_SQL})),
{_lookup_sql()}
SELECT id, CASE WHEN m THEN {lat} ELSE latitude END AS latitude,
           CASE WHEN m THEN {lon} ELSE longitude END AS longitude
FROM t {joins}"""


@query("fallback_lookup", _fallback_sql())
def q_fallback_lookup(spark, d):
    lk = geo.lookup_table(lookup_raw(spark, d))
    out = geo.fallback_lookup(listings(spark, d), lk)
    return out.select("id", "latitude", "longitude")


def _merc_sql(lat, lon):
    a, e = 6378137.0, 0.0818191908426215
    x = f"({a} * radians({lon}))"
    y = (f"({a} * ln(tan(pi() / 4 + radians({lat}) / 2) * "
         f"pow((1 - {e} * sin(radians({lat}))) / (1 + {e} * sin(radians({lat}))), {e} / 2)))")
    return x, y


def _prox_sql():
    hx, hy = _merc_sql("latitude", "longitude")
    cols = []
    for rad in geo.RADII_KM:
        whens = []
        for name, la, lo in geo.CITIES:
            cx, cy = _merc_sql(str(la), str(lo))
            whens.append(f"WHEN sqrt(pow({hx} - {cx}, 2) + pow({hy} - {cy}, 2)) <= {rad * 1000.0} THEN '{name}'")
        case = f"CASE {' '.join(whens)} END"
        cols.append(f"{case} AS Assigned_City_{rad}")
        cols.append(f"CASE WHEN ({case}) IS NOT NULL THEN 1 ELSE 0 END AS Has_Assigned_City_{rad}")
    return f"WITH t AS ({LISTINGS_SQL})\nSELECT id, {', '.join(cols)} FROM t"


@query("proximity_assign", _prox_sql())
def q_proximity_assign(spark, d):
    out = geo.assign_cities(listings(spark, d))
    cols = [c for r_ in geo.RADII_KM for c in (f"Assigned_City_{r_}", f"Has_Assigned_City_{r_}")]
    return out.select("id", *cols)


@query("proximity_flags", f"WITH p AS ({_prox_sql()})\n" + _union_sql([
    f"SELECT {rad} AS radius_km, Assigned_City_{rad} AS city, count(*) AS rows FROM p GROUP BY 2"
    for rad in geo.RADII_KM]))
def q_proximity_flags(spark, d):
    out = geo.assign_cities(listings(spark, d))
    parts = [out.groupBy(F.col(f"Assigned_City_{rad}").alias("city"))
             .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(rad).alias("radius_km"), "city", "rows")
             for rad in geo.RADII_KM]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res
