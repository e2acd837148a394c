"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``:

1. quality rules: documents that the base checks or the learned decision list reject go;
2. SimHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents with a 10-word window of a benchmark item go;
4. personal data: replaced by surrogates, ``n_chars`` is the new length;
5. byte-level BPE: ids of every text, and digests of them and of the bytes decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veld.llm import bpe, decision_list, stages, surrogates
from veld.llm.queries import PII_KEY, table
from veld.llm.store import ship_package, written

#: SQL can't learn a decision list or merge bytes; ``tests/llm`` holds brute-force versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decision_list.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.without_near_duplicates(docs, words=3, bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_entities(docs, PII_KEY, counts=None)
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.bpe_digests(docs, ranks, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
