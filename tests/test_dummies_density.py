"""Sparse dummies, scatter density, and the entry without its optional part."""

import os
import subprocess
import sys

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from veld.operators import encode, profile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_sparse_dummies_drop_the_smallest_and_keep_nulls_at_zero(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c"), (5, "zz")], "id int, c string")
    codes = encode.ordinal_codes(df.filter("id < 5"), "c")
    out = encode.one_hot_vectors(df, "c", codes).select("id", vector_to_array("c_vector").alias("v")).collect()
    assert {r["id"]: r["v"] for r in out} == {1: [0, 1], 2: [0, 0], 3: [0, 0], 4: [1, 0], 5: [0, 0]}


def test_a_hundred_thousand_categories(spark):
    df = spark.range(100_000).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    out = encode.one_hot_vectors(df, "c", encode.ordinal_codes(df, "c"))
    row = out.filter("c = 'c000001'").first()["c_vector"]
    assert row.size == 99_999 and row.indices.tolist() == [99_998] and out.count() == 100_000


def test_density_counts_finite_pairs(spark):
    rows = [(0.0, 5.0, 0.0), (10.0, 5.0, 10.0), (9.9, None, 5.0), (float("nan"), 5.0, 1.0), (float("inf"), 5.0, 1.0), (5.0, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    got = sorted(map(tuple, profile.density(df, ["a", "b"], "y", 2).collect()))
    # x_bin, y_bin: the top edge is in the last bin, a constant feature in bin 0
    assert got == [("a", 0, 0, 1), ("a", 1, 1, 2), ("b", 0, 0, 3), ("b", 0, 1, 1)]


def test_entry_survives_a_left_over_folder(tmp_path):
    """An empty ``llm`` folder is no package: the other queries still register."""
    for name in ("veld", "__spark_entry__.py", "corpus_pipeline.py"):
        if name == "veld":
            os.makedirs(tmp_path / "veld" / "llm")
            for part in os.listdir(os.path.join(ROOT, "veld")):
                if part not in ("llm", "__pycache__"):
                    os.symlink(os.path.join(ROOT, "veld", part), tmp_path / "veld" / part)
        elif os.path.exists(os.path.join(ROOT, name)):
            (tmp_path / name).write_text(open(os.path.join(ROOT, name)).read())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
