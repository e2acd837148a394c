"""Tables in the folder that all executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from veld.session import checkpoint_root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the session's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends here, and a
    lost executor takes nothing with it."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)     # no job to find the schema again


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would, unless they have it
    from ``PYTHONPATH`` or the working folder.  Spark's file server hands the zip out."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    there = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in map(os.path.abspath, filter(None, there)):
        return
    base = os.path.join(tempfile.mkdtemp(), "veld")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "veld"))
    _SHIPPED.add(app)


_SHIPPED: set[str] = set()
