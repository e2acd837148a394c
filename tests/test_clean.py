from pyspark.sql import functions as F

from tests.fixtures import listings
from veld.functions import text as tx
from veld.operators import clean


def _ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_drop_rows_keeps_missing_booleans(spark):
    df = listings(spark)
    out = clean.drop_rows_where(df, true_col="Starting_price", not_na_col="sale_annuity",
                                na_col="Price")
    # id 2: Starting_price true; id 4 (first): annuity; id 3: Price missing.
    # Starting_price NULL (id 4) is kept by the true-rule, dropped by the annuity rule.
    assert _ids(out) == [1, 4, 5, 6, 7, 8, 9]
    counts = {r["step"]: r["rows_dropped"] for r in
              clean.drop_counts(df, true_col="Starting_price", not_na_col="sale_annuity",
                                na_col="Price").collect()}
    assert counts == {1: 1, 2: 1, 3: 1}


def test_false_rule_keeps_null(spark):
    df = listings(spark)
    out = clean.drop_rows_where(df, false_col="Starting_price")
    assert _ids(out) == [2, 3, 4]          # true and NULL kept


def test_null_to_false(spark):
    df = clean.null_to_false(listings(spark), ["Swimming_Pool", "missing_col"])
    vals = {r["id"]: r["Swimming_Pool"] for r in df.collect()}
    assert vals[2] is False and vals[1] is True
    assert dict(df.dtypes)["Swimming_Pool"] == "boolean"


def test_length_filter_drops_null_and_wrong_length(spark):
    df = listings(spark).withColumn("Postal_code",
                                    F.when(F.col("id") == 9, None).otherwise(F.col("Postal_code")))
    assert _ids(clean.length_filter(df, "Postal_code", 4)) == [1, 2, 3, 4, 4, 7, 8]


def test_drop_all_missing(spark):
    out = clean.drop_all_missing(listings(spark), ["street", "number", "latitude", "longitude"])
    assert 3 not in _ids(out)
    assert 2 in _ids(out)                 # street present


def test_sparse_columns_threshold_strict(spark):
    df = listings(spark)                  # 10 rows: sparse_30 has 3 of 10 present -> 70% null
    frac = {r["column"]: r["null_fraction"] for r in clean.null_fraction(df).collect()}
    assert abs(frac["sparse_30"] - 0.7) < 1e-12
    # make a column with exactly 30 % nulls: it must stay
    df2 = df.withColumn("exact30", F.when(F.col("id").isin(1, 2, 3), None).otherwise(F.lit(1.0)))
    dropped = clean.sparse_columns(df2, 0.3)
    assert "exact30" not in dropped and "sparse_30" in dropped and "sparse_40" in dropped


def test_nan_text_to_null(spark):
    df = clean.nan_text_to_null(listings(spark))
    vals = {r["id"]: (r["epc"], r["State_of_building"]) for r in df.collect()}
    assert vals[4][0] is None or vals[4][0] == "C"   # one of the two id-4 rows
    assert vals[8][1] is None


def test_convert_types_whole_only(spark):
    df = listings(spark)
    whole = clean.whole_number_columns(df)
    assert "Number_of_facades" in whole and "Number_of_bedrooms" not in whole   # 3.5 present
    out = clean.convert_types(df, string_columns=["Postal_code"])
    t = dict(out.dtypes)
    assert t["Number_of_facades"] == "bigint" and t["Number_of_bedrooms"] == "double"
    assert t["Swimming_Pool"] == "int" and t["Postal_code"] == "string"


def test_dedup_first_by_key_and_composite(spark):
    df = listings(spark).withColumn("pos", F.monotonically_increasing_id())
    out = clean.dedup_first(df, ["id"], ["pos"])
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == 9 and rows[4]["Type_of_sale"] == "LIFE_ANNUITY"
    comp = clean.dedup_first(df, ["street", "number", "Postal_code", "latitude", "longitude"], ["pos"])
    # ids 7 and 8 share the address -> 7 kept; NULL parts group together (ids 3 alone)
    got = _ids(comp)
    assert 7 in got and 8 not in got and 3 in got


def test_missing_any_and_bounds(spark):
    df = listings(spark)
    assert _ids(clean.missing_any(df, ["latitude", "longitude"])) == [2, 3, 5]
    bad = df.withColumn("latitude", F.when(F.col("id") == 1, 95.0).otherwise(F.col("latitude")))
    assert _ids(clean.coordinate_bounds(bad)) == [4, 4, 6, 7, 8, 9]


def test_numeric_parse_report(spark):
    df = spark.createDataFrame([("1", "a"), (" 2 ", "3"), (None, "4")], "x string, y string")
    rep = {r["column"]: (r["n_present"], r["n_failed"], r["is_numeric"])
           for r in clean.numeric_parse_report(df).collect()}
    assert rep["x"] == (2, 0, True) and rep["y"] == (3, 1, False)


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("TOWN_HOUSE", "BRAINE-L'ALLEUD", "Tielt (8700)", "  Hoofdstr. 5  Ave  blvd x "),
         (None, None, None, None), ("x", "rue du 1er mai", "A(1)", "havenstraat")],
        "a string, b string, c string, d string")
    rows = df.select(tx.capitalize("a").alias("a"), tx.title_case("b").alias("b"),
                     tx.strip_code("c").alias("c"), tx.normalize_address("d").alias("d"),
                     tx.normalize_address("d", literal=True).alias("e")).collect()
    assert rows[0]["a"] == "Town house"
    assert rows[0]["b"] == "Braine-L'Alleud"
    assert rows[0]["c"] == "Tielt"
    assert rows[0]["d"] == "hoofdstraat 5 avenue boulevard x"
    assert rows[1]["a"] is None and rows[1]["b"] is None and rows[1]["d"] is None
    assert rows[2]["b"] == "Rue Du 1Er Mai"          # Python str.title behaviour
    assert rows[2]["d"] == "havenstraat"             # word boundary: no 'havenuenstraat'
    assert rows[2]["e"] == "havenuenstraat"          # literal substring mode
