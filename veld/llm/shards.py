"""Shards of shuffled records by a two-pass external shuffle.

Pass one scatters: a seeded hash of (id, text) sends each record to one of as many buckets as
the table has ``BUCKET_BYTES``, so a bucket fits a task's memory and the scatter is uniform
whatever the order of the input.  Pass two gathers one bucket a task, puts it in order of the
hash and permutes it by Spark's Fisher-Yates ``shuffle``, seeded by seed and bucket: the same
table and seed give the same order on any cluster.  Counts of the buckets before it give each
record its place among all, and places are cut into shards whose row counts differ by one
at most (law ``rows``).  A task writes its records to the one or two shards they fall in.

Equal records would share a bucket.  Where the copies of one (id, text) fill a bucket's
``1 / HOT_SHARE`` or more, each copy gets a bucket of its own choice; copies are alike, so it does
not matter which goes where.

Both passes are tables in the shared folder: a lost executor repeats tasks, and a repeated task
finds the same bucket and the same permutation.  All of it is DataFrame expressions.

Defined results.  A null text has no bytes; null ids are ids like others; repeated rows are rows.  An empty table
gives no rows.  Records are kept whole in a column ``record``, so columns of any name come along,
if Spark can order their type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .store import shared_path, written

#: Text and rows of a bucket: what a task has in memory, a few times over, in pass two.
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16
#: Copies of a record that fill this part of a bucket are scattered one by one.
HOT_SHARE = 16
#: Buckets whose counts one task adds up.
COARSE = 4096


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def scatter(docs: DataFrame, seed: int, text: str = "text", id: str = "doc_id",
            bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int, int]:
    """Pass one: ``bucket``, ``hash``, ``no`` and ``record``, the number of buckets and that of rows."""
    mark = F.xxhash64(F.lit(seed), F.col(id), F.col(text))
    copies = written(docs.select(mark.alias("hash"), record_size(text).alias("size")).groupBy("hash")
                     .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")), "record-sizes")
    total = copies.agg(F.sum("rows"), F.sum("bytes")).first()
    rows, size = total[0] or 0, total[1] or 0
    buckets = max(1, -(-size // bucket_bytes))
    records = docs.select(mark.alias("hash"), F.monotonically_increasing_id().alias("no"), F.struct("*").alias("record"))
    hot = copies.filter(F.col("bytes") > bucket_bytes / HOT_SHARE).select("hash", F.lit(True).alias("hot"))
    salt = F.lit(0).cast("long")
    if buckets > 1 and not hot.isEmpty():
        records = records.join(hot, "hash", "left")          # without a hint: Spark goes by the table's bytes
        salt = F.when(F.col("hot"), F.col("no")).otherwise(salt)
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), "hash", salt), F.lit(buckets)).cast("int")
    return written(records.select(bucket.alias("bucket"), "hash", "no", "record"), "scattered"), buckets, rows


def bucket_starts(scattered: DataFrame) -> DataFrame:
    """``bucket`` and ``before``, the rows of the buckets before it; no task adds up more than
    ``COARSE`` buckets, or the sums of that many."""
    counts = scattered.groupBy("bucket").count().withColumn("coarse", F.floor(F.col("bucket") / COARSE))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    fine = before.partitionBy("coarse").orderBy("bucket")
    inside = counts.select("coarse", "bucket", F.coalesce(F.sum("count").over(fine), F.lit(0)).alias("inside"))
    sums = counts.groupBy("coarse").agg(F.sum("count").alias("rows"))
    outside = sums.select("coarse", F.coalesce(F.sum("rows").over(before.partitionBy(F.lit(0)).orderBy("coarse")), F.lit(0))
                          .alias("outside"))
    return inside.join(outside, "coarse").select("bucket", (F.col("inside") + F.col("outside")).alias("before"))


def write_shards(docs: DataFrame, shards: int, seed: int, path: str | None = None, text: str = "text",
                 id: str = "doc_id", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Both passes.  Shard files (one folder a shard, rows by ``slot``) under ``path``, read back:
    ``shard``, ``slot`` (from 0, gapless in its shard) and ``record``."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "shards")
    scattered, buckets, rows = scatter(docs, seed, text, id, bucket_bytes)
    # a bucket's start comes to its task as one more row of the bucket, not by a join
    starts = bucket_starts(scattered)
    gathered = scattered.unionByName(starts, allowMissingColumns=True).repartitionById(buckets, F.col("bucket")) \
        .groupBy("bucket").agg(F.max("before").alias("before"),
                               F.collect_list(F.when(F.col("record").isNotNull(), F.struct("hash", "no", "record"))).alias("all"))
    placed = gathered.select("before", F.posexplode(F.shuffle(F.array_sort("all"), F.lit(seed))).alias("pos", "one"))
    place = "(before + pos)"
    shard = f"({place} * {shards}L div {max(rows, 1)}L)"
    placed.select(F.expr(f"cast({shard} as int)").alias("shard"),
                  F.expr(f"{place} - ({shard} * {rows}L + {shards - 1}L) div {shards}L").alias("slot"), "one.record") \
        .sortWithinPartitions("shard", "slot") \
        .write.option("compression", "zstd").partitionBy("shard").parquet(path)
    schema = StructType([StructField("slot", LongType()), StructField("record", docs.select(F.struct("*").alias("r")).schema["r"].dataType),
                         StructField("shard", IntegerType())])
    return spark.read.schema(schema).parquet(path).select("shard", "slot", "record")
