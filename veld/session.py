"""Session construction and lineage cutting.

Long preparation chains call ``fit`` steps that trigger jobs on an ever-growing plan.
``materialize`` writes a stage to Parquet under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) and reads it back, which cuts lineage and survives executor
loss (unlike ``localCheckpoint``).  The folder is read from the session; only when it is
unset (tests, local runs) do we create one under the system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "veld") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:          # else Spark's own setting: the driver's cores say nothing about the data
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("VELD_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", os.environ["VELD_DRIVER_MEMORY"])
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests) gets a fresh temp folder, registered on the
    session so later calls and ``DataFrame.checkpoint`` use the same place; a cluster raises,
    as its executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="veld-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), "stages",
                        f"{name or 'stage'}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
