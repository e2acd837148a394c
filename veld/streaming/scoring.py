"""Continuous batch scoring (stage C on a stream).

A fitted ``PipelineModel`` (assembler, scaler, regressor) and every veld transform are
stateless per row, so they apply to a streaming DataFrame unchanged: no watermark or
state is involved.  Progress is kept in a checkpoint location under the cluster's shared
checkpoint folder, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veld.session import checkpoint_root


def score_stream(model, stream: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``model.transform`` on a streaming DataFrame, projecting ``keep + [prediction]``."""
    out = model.transform(stream)
    return out.select(*(keep or []), "prediction") if keep is not None else out


def start_scoring(spark: SparkSession, model, source: str, schema, sink: str, name: str,
                  keep: list[str] | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Read new files under ``source``, score them, append Parquet under ``sink``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score_stream(model, reader.load(source), keep)
    ckpt = os.path.join(checkpoint_root(spark), "streams", name)
    writer = (scored.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", ckpt).outputMode("append").queryName(name))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
