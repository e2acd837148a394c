"""Stand-in inputs built from the driver tables, each defined twice: as a Spark
DataFrame and as the equivalent SQL text (so an oracle can use the same rows).

These builders only shape rows into the schema an operator expects (inject missing
values, build address texts, derive coordinates); they do none of the operator's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------- events with missing values

EVENTS_N_SQL = """
SELECT event_id,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN NULL
            WHEN event_id % 11 = 0 THEN 'nan' ELSE event_type END AS event_type,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE value > 100 END AS big
FROM events"""


def events_n(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    i = F.col("event_id")
    return e.select(
        "event_id",
        F.when(i % 7 == 0, None).otherwise(F.col("user_id")).alias("user_id"),
        F.when(i % 5 == 0, None).when(i % 11 == 0, "nan").otherwise(F.col("event_type"))
        .alias("event_type"),
        F.when(i % 3 == 0, None).otherwise(F.col("value")).alias("value"),
        F.when(i % 2 == 0, None).otherwise(F.col("props")).alias("props"),
        F.when(i % 3 == 0, None).otherwise(F.col("value") > 100).alias("big"),
    )


# ---------------------------------------------------------------- orders with missing priority

ORDERS_N_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders"""


def orders_n(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                    F.when(F.col("o_orderkey") % 13 == 0, None)
                    .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


# ---------------------------------------------------------------- customers as listings

LISTINGS_SQL = """
SELECT c_custkey AS id,
       CASE c_custkey % 4 WHEN 0 THEN '  Kerkstr. ' || CAST(c_custkey % 50 AS VARCHAR)
                          WHEN 1 THEN 'Park  Ave ' || CAST(c_custkey % 50 AS VARCHAR)
                          WHEN 2 THEN 'Grand BLVD ' || CAST(c_custkey % 50 AS VARCHAR)
                          ELSE 'Avenue Louise ' || CAST(c_custkey % 50 AS VARCHAR) END AS street,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 7 AS VARCHAR) END AS number,
       CAST(1000 + c_nationkey * 300 AS VARCHAR) AS Postal_code,
       'TOWN_' || CAST(c_nationkey AS VARCHAR) || ' (' || CAST(1000 + c_nationkey * 300 AS VARCHAR) || ')'
           AS locality_raw,
       'Town ' || CAST(c_nationkey AS VARCHAR) AS locality_name,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(50.4 AS DOUBLE) + CAST(c_custkey % 97 AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS latitude,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(3.2 AS DOUBLE) + CAST(c_custkey % 89 AS DOUBLE) / CAST(40.0 AS DOUBLE) END AS longitude,
       c_acctbal AS price
FROM customer"""


def listings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(*_listing_columns())


def _listing_columns() -> list:
    k = F.col("c_custkey")
    m50 = (k % 50).cast("string")
    street = (F.when(k % 4 == 0, F.concat(F.lit("  Kerkstr. "), m50))
              .when(k % 4 == 1, F.concat(F.lit("Park  Ave "), m50))
              .when(k % 4 == 2, F.concat(F.lit("Grand BLVD "), m50))
              .otherwise(F.concat(F.lit("Avenue Louise "), m50)))
    pc = (F.lit(1000) + F.col("c_nationkey") * 300).cast("string")
    return [
        k.alias("id"), street.alias("street"),
        F.when(k % 9 == 0, None).otherwise((k % 7).cast("string")).alias("number"),
        pc.alias("Postal_code"),
        F.concat(F.lit("TOWN_"), F.col("c_nationkey").cast("string"), F.lit(" ("), pc, F.lit(")"))
        .alias("locality_raw"),
        F.concat(F.lit("Town "), F.col("c_nationkey").cast("string")).alias("locality_name"),
        F.when(k % 4 == 0, None).otherwise(F.lit(50.4) + (k % 97).cast("double") / F.lit(100.0)).alias("latitude"),
        F.when(k % 6 == 0, None).otherwise(F.lit(3.2) + (k % 89).cast("double") / F.lit(40.0)).alias("longitude"),
        F.col("c_acctbal").alias("price"),
    ]


# ---------------------------------------------------------------- address lookup table

LOOKUP_RAW_SQL = """
SELECT 'Town ' || CAST(n_nationkey AS VARCHAR) AS address_key,
       CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE CAST(50.0 AS DOUBLE) + CAST(n_regionkey AS DOUBLE) / CAST(10.0 AS DOUBLE) END AS lat,
       CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE CAST(4.0 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS lon
FROM nation
UNION ALL
SELECT 'Kerkstraat ' || CAST(s_suppkey % 50 AS VARCHAR) || ' ' || CAST(s_suppkey % 7 AS VARCHAR)
       || ', Town ' || CAST(s_nationkey AS VARCHAR) AS address_key,
       CAST(49.0 AS DOUBLE) + s_acctbal / CAST(10000.0 AS DOUBLE) AS lat, CAST(3.0 AS DOUBLE) + s_acctbal / CAST(5000.0 AS DOUBLE) AS lon
FROM supplier"""


def lookup_raw(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    s = table(spark, d, "supplier")
    nk = F.col("n_nationkey")
    a = n.select(F.concat(F.lit("Town "), nk.cast("string")).alias("address_key"),
                 F.when(nk % 5 == 4, None).otherwise(F.lit(50.0) + F.col("n_regionkey").cast("double") / F.lit(10.0)).alias("lat"),
                 F.when(nk % 5 == 4, None).otherwise(F.lit(4.0) + nk.cast("double") / F.lit(100.0)).alias("lon"))
    sk = F.col("s_suppkey")
    b = s.select(F.concat(F.lit("Kerkstraat "), (sk % 50).cast("string"), F.lit(" "),
                          (sk % 7).cast("string"), F.lit(", Town "),
                          F.col("s_nationkey").cast("string")).alias("address_key"),
                 (F.lit(49.0) + F.col("s_acctbal") / F.lit(10000.0)).alias("lat"),
                 (F.lit(3.0) + F.col("s_acctbal") / F.lit(5000.0)).alias("lon"))
    return a.unionByName(b)


# ---------------------------------------------------------------- full listing schema

def listings_full(spark: SparkSession, d: str) -> DataFrame:
    """Customers shaped into the raw listing schema of the preparation chain.

    Only shapes rows: category texts and flags are picked from key digits, sizes from the
    account balance; missing values are injected the same way for every scale factor.
    """
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")

    def pick(values, m):
        e = None
        for i, v in enumerate(values):
            cond = (m == i)
            e = F.when(cond, F.lit(v)) if e is None else e.when(cond, F.lit(v))
        return e

    seg = F.col("c_mktsegment")
    sub = (F.when(seg == "BUILDING", "HOUSE").when(seg == "AUTOMOBILE", "TOWN_HOUSE")
           .when(seg == "FURNITURE", "VILLA").when(seg == "HOUSEHOLD", "APARTMENT_BLOCK")
           .otherwise("COUNTRY_COTTAGE"))
    town = F.concat(F.lit("TOWN "), F.col("c_nationkey").cast("string"), F.lit(" ("),
                    (F.lit(1000) + F.col("c_nationkey") * 300).cast("string"), F.lit(")"))
    return c.select("*", *_listing_columns()).select(
        "id", "street", "number", "Postal_code", "latitude", "longitude",
        F.when(bal < 0, None).otherwise(bal * 50 + 100000).alias("Price"),
        F.when(k % 50 == 0, "LIFE_ANNUITY").otherwise("RESIDENTIAL_SALE").alias("Type_of_sale"),
        F.when(k % 13 == 0, None).otherwise(k % 17 == 0).alias("Starting_price"),
        F.when(k % 50 == 0, bal / 10).alias("sale_annuity"),
        sub.alias("Subtype"),
        F.when(k % 7 == 0, None).otherwise(pick(["INSTALLED", "HYPER_EQUIPPED", "NOT_INSTALLED"], k % 3))
        .alias("Kitchen_type"),
        F.when(k % 7 == 1, None).otherwise(
            pick(["GOOD", "AS_NEW", "TO_RENOVATE", "JUST_RENOVATED", "TO_BE_DONE_UP", "TO_RESTORE"], k % 6))
        .alias("State_of_building"),
        F.when(k % 11 == 0, None).otherwise(pick(["A++", "A+", "A", "B", "C", "D", "E", "F", "G"], k % 9))
        .alias("epc"),
        F.when(k % 5 == 0, None).otherwise(k % 3 == 0).alias("Swimming_Pool"),
        F.when(k % 6 == 0, None).otherwise(k % 2 == 0).alias("hasTerrace"),
        F.when(k % 2 == 0, (k % 30).cast("double")).alias("terraceSurface"),
        F.when(k % 8 == 0, None).otherwise(k % 4 == 0).alias("hasGarden"),
        F.when(k % 4 == 0, (k % 500).cast("double")).alias("gardenSurface"),
        F.when(k % 9 == 0, None).otherwise(k % 10 == 0).alias("Furnished"),
        (F.lit(1) + k % 5).cast("double").alias("Number_of_bedrooms"),
        F.when(k % 12 == 0, None).otherwise((F.lit(2) + k % 3).cast("double")).alias("Number_of_facades"),
        F.when(k % 10 == 3, None).otherwise(F.abs(bal) / 40 + 50).alias("Living_area"),
        F.when(k % 10 == 4, None).otherwise(F.abs(bal) / 5 + (k % 300)).alias("landSurface"),
        town.alias("locality_name"), k.alias("position"))       # customers come in order of their key
