import os
import uuid

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from veld.operators import encode
from veld.operators.stages import QuantileClipper, StatImputer, TargetMeanEncoder
from veld.session import checkpoint_root


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, ["a", "b", "c", None][i % 4], float(i % 13) if i % 7 else None,
             float(i) * 2.0 + (i % 4) * 10.0) for i in range(400)]
    return spark.createDataFrame(rows, "id long, cat string, x double, y double")


def test_stages_match_dataframe_operators(spark, data):
    imp = StatImputer(inputCols=["x"], strategy="median").fit(data)
    assert imp.transform(data).where("x is null").count() == 0
    assert encode.fill_values(data, ["x"], "median")["x"] == imp._state()["x"]
    clip = QuantileClipper(inputCols=["y"], lower=[0.1], upper=[0.9]).fit(data)
    ref = encode.QuantileClip({"y": (0.1, 0.9)}).fit(data)
    assert tuple(clip._state()["y"]) == ref.bounds["y"]
    te = TargetMeanEncoder(inputCols=["cat"], labelCol="y").fit(data)
    a = {r["id"]: r["cat_encoded"] for r in te.transform(data).collect()}
    b = {r["id"]: r["cat_encoded"] for r in encode.TargetEncoder(["cat"], "y").fit(data).transform(data).collect()}
    assert a == b


def test_one_pipeline_persists_preparation_and_model(spark, data):
    pipe = Pipeline(stages=[
        StatImputer(inputCols=["x"], strategy="mean"),
        QuantileClipper(inputCols=["y"], lower=[0.05], upper=[0.95]),
        TargetMeanEncoder(inputCols=["cat"], labelCol="y"),
        StatImputer(inputCols=["cat_encoded"], strategy="mean"),
        VectorAssembler(inputCols=["x", "cat_encoded"], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol="y", solver="normal")])
    model = pipe.fit(data)
    path = os.path.join(checkpoint_root(spark), "test-stages", uuid.uuid4().hex[:8])
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    p1 = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
    p2 = {r["id"]: r["prediction"] for r in loaded.transform(data).collect()}
    assert p1 == p2 and len(p1) == 400


def test_target_encoder_stage_keeps_its_mapping_as_a_table(spark):
    df = spark.createDataFrame([(str(i), float(i)) for i in range(50)], "c string, y double")
    model = TargetMeanEncoder(inputCols=["c"], labelCol="y").fit(df)
    path = os.path.join(checkpoint_root(spark), "test-stages", uuid.uuid4().hex[:8])
    model.write().save(path)
    assert spark.read.parquet(f"{path}/mapping").count() == 50
    loaded = type(model).load(path)
    assert sorted(r.c_encoded for r in loaded.transform(df).collect()) == [float(i) for i in range(50)]
    assert loaded.transform(df.limit(1).withColumn("c", F.lit("new"))).first().c_encoded is None
