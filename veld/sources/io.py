"""Readers and writers.

``load_table`` picks the reader by suffix (or an explicit ``fmt``) and raises on an
unknown format instead of returning nothing.  Writers produce Parquet (the stage format)
and, when asked, CSV with the given separator and encoding.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet", ".json": "json",
           ".jsonl": "json", ".orc": "orc"}


def load_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read a table by suffix or ``fmt``.

    CSV gets a header and, without a schema, type inference over all rows, so no value is
    lost to a guessed type; a declared ``schema`` avoids that scan (what a 100 TB job should
    pass).  A header that names other columns than the schema raises, and so does a value or row
    that doesn't fit it; ``load_checked`` sets such rows apart instead.  Floating NaN becomes NULL: one notion of missing value downstream.
    """
    if fmt is None:
        ext = os.path.splitext(path.rstrip("/"))[1].lower()
        if ext not in FORMATS:
            raise ValueError(f"unsupported file format {ext!r}: use one of {sorted(FORMATS)}")
        fmt = FORMATS[ext]
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
        else:
            reader = reader.option("enforceSchema", "false").option("mode", "FAILFAST")
    for k, v in options.items():
        reader = reader.option(k, v)
    return nan_to_null(reader.load(path))


REJECT = "_rejected"


def load_checked(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> tuple[DataFrame, DataFrame]:
    """A CSV table as ``(rows, rejected)`` (S1, S2): the rows that fit ``schema``, and ``(record, file,
    reason)`` of those that don't.  A header that names other columns raises.

    The files are parsed once and written; both results read that.  ``reason`` names the first
    column whose text is no value of its type, else the number of fields is wrong.  Empty
    fields are NULL, not errors.
    """
    from veld.session import materialize
    fields = list((schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields)
    if REJECT in [f.name for f in fields]:
        raise ValueError(f"{REJECT!r} is the name of the rejected records' column")
    reader = spark.read.schema(T.StructType([*fields, T.StructField(REJECT, T.StringType())])).option("header", "true") \
        .option("enforceSchema", "true").option("columnNameOfCorruptRecord", REJECT).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    _check_header(spark, path, [f.name for f in fields], options)
    parsed = materialize(reader.csv(path).withColumn("_file", F.input_file_name()), "parsed")
    texts = F.from_csv(REJECT, T.StructType([T.StructField(f.name, T.StringType()) for f in fields]).simpleString()[7:-1].replace(":", " "),
                       {k: str(v) for k, v in options.items() if k in ("sep", "quote", "escape")})
    bad = [F.when(F.col("_text")[f.name].isNotNull() & F.col(f.name).isNull(),
                  F.concat(F.lit(f"{f.name}: no {f.dataType.simpleString()}: "), F.col("_text")[f.name]))
           for f in fields if not isinstance(f.dataType, T.StringType)]
    rejected = parsed.filter(F.col(REJECT).isNotNull()).withColumn("_text", texts)
    return (nan_to_null(parsed.filter(F.col(REJECT).isNull()).drop(REJECT, "_file")),
            rejected.select(F.col(REJECT).alias("record"), F.col("_file").alias("file"),
                            F.coalesce(*bad, F.lit("wrong number of fields")).alias("reason")))


def _check_header(spark: SparkSession, path: str, names: list[str], options: dict) -> None:
    """Raise if a file's first line names other columns.  Reads the first line of each file by a
    text scan that keeps the lines equal to none of the good headers' place: one row a file."""
    sep = str(options.get("sep", ","))
    lines = spark.read.option("wholetext", "false").text(path).select(
        F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"),
        "value").filter("block = 0")
    firsts = lines.groupBy("file").agg(F.min_by("value", "no").alias("header"))
    want = sep.join(names)
    wrong = firsts.filter(F.translate(F.col("header"), '"\ufeff', "") != want).first()
    if wrong:
        raise ValueError(f"{wrong['file']}: header {wrong['header']!r} instead of {want!r}")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN -> NULL: one notion of missing value downstream."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in fl}) if fl else df


def save_table(df: DataFrame, name: str = "data", directory: str = ".", sep: str = ",",
               encoding: str = "utf-8", csv: bool = True, mode: str = "overwrite") -> dict:
    """Write ``<directory>/<name>.parquet`` (and ``.csv``); returns both paths (S3)."""
    base = os.path.join(directory, name)
    paths = {"parquet": base + ".parquet"}
    df.write.mode(mode).parquet(paths["parquet"])
    if csv:
        paths["csv"] = base + ".csv"
        (df.write.mode(mode).option("header", "true").option("sep", sep)
         .option("encoding", encoding).csv(paths["csv"]))
    return paths


def read_lookup_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{key: [lat, lon] | [null, null]}`` as ``(address_key, lat, lon)``.

    The object is one JSON document, so it is read whole (``wholetext``) and exploded;
    convert it once to Parquet for repeated use.
    """
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,array<double>>")
    return (raw.select(F.explode(m).alias("address_key", "pair"))
            .select("address_key", F.col("pair")[0].alias("lat"), F.col("pair")[1].alias("lon")))


def save_model(model, path: str) -> str:
    """Persist a fitted ``PipelineModel``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a ``PipelineModel``; ``None`` when the path does not exist."""
    from pyspark.ml import PipelineModel
    try:
        return PipelineModel.load(path)
    except Exception as e:  # missing path surfaces as an analysis/IO error
        if "does not exist" in str(e) or "PATH_NOT_FOUND" in str(e) or "FileNotFound" in str(e):
            return None
        raise
