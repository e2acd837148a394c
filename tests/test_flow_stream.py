import os
import uuid

from pyspark.sql import functions as F

from tests.fixtures import listings
from veld.plans import flow
from veld.plans.models import make_pipeline
from veld.session import checkpoint_root
from veld.sources.io import load_model
from veld.streaming.scoring import start_scoring


def placed(spark):
    return listings(spark).withColumn("position", F.monotonically_increasing_id())


def test_first_of_duplicate_ids_stays(spark):
    row = [r for r in listings(spark).collect() if r["id"] == 1][0].asDict()
    rows = [row | {"position": 1}, row | {"position": 0, "epc": None}, row | {"position": 2, "epc": "F"}]
    schema = placed(spark).schema
    out = flow.stage_clean(spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema), "position")
    assert out.count() == 1 and out.first().asDict().get("epc") is None and "position" not in out.columns


def test_training_reports_weights_and_saves(spark):
    df = spark.createDataFrame([(i, float(i % 11), float(i % 7), 3.0 * (i % 11) - (i % 7), 1.0 * i, i % 5 == 0) for i in range(300)],
                               "id long, a double, b double, Price double, price_per_sqm double, is_test boolean")
    path = os.path.join(checkpoint_root(spark), "test-models", uuid.uuid4().hex[:8])
    test = df.where("is_test")
    out = flow.train_models(df.where("not is_test"), "Price", 0.2, kinds=["linear", "ridge"], test=test, save_path=path)
    assert out["features"] == ["a", "b"] and out["cv"].count() == 12
    report = {(r.model, r.phase, r.metric): r.value for r in out["report"].collect()}
    assert len(report) == 16 and report["linear", "test", "r2"] > 0.999999
    assert {r.feature for r in out["weights"].collect()} == {"a", "b"} and out["residuals"].count() == 1
    again = {r["id"]: r["prediction"] for r in load_model(path).transform(test).collect()}
    assert again == {r["id"]: r["prediction"] for r in out["model"].transform(test).collect()}


def test_stage_clean_on_fixture(spark):
    out = flow.stage_clean(placed(spark), "position")
    ids = sorted(r["id"] for r in out.select("id").collect())
    # dropped: 2 (starting price), 3 (no price), the annuity row of 4 (its second row stays),
    # 5 (5-char postcode), 6 (3-char postcode), 8 (same address as 7)
    assert ids == [1, 4, 7, 9]
    row = {r["id"]: r for r in out.collect()}[1]
    assert row["locality_name"] == "Tielt" and row["Subtype"] == "House"
    assert row["Swimming_Pool"] == 1 and dict(out.dtypes)["Number_of_facades"] == "bigint"
    assert "sparse_30" not in out.columns and "Type_of_sale" not in out.columns


def test_stage_geo_and_subtype(spark):
    s1 = flow.stage_clean(placed(spark), "position")
    s2 = flow.stage_geo(s1)
    prov = {r["id"]: r["Province"] for r in s2.collect()}
    assert prov == {1: "West Flanders", 4: "Antwerp", 7: "Flemish Brabant", 9: "East Flanders"}
    s3 = flow.stage_subtype(s2)
    assert "Subtype" not in s3.columns
    assert sorted(r["id"] for r in s3.collect()) == [1, 4, 9]       # 7 is a mansion


def test_stream_scoring_matches_batch(spark):
    root = os.path.join(checkpoint_root(spark), "test-stream", uuid.uuid4().hex[:8])
    src, sink = os.path.join(root, "in"), os.path.join(root, "out")
    rows = [(i, float(i), float(i % 7), 2.0 * i + 3.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    model = make_pipeline("linear", ["a", "b"], label="y").fit(df)
    df.repartition(3).write.parquet(src)
    q = start_scoring(spark, model, src, df.schema, sink, "veld_test_" + uuid.uuid4().hex[:6],
                      keep=["id"])
    q.awaitTermination(120)
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(sink).collect()}
    want = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
