"""The registered queries of this package: each applies its operator, with production
parameters, to the whole of its tables.  ``queries`` and ``oracle_sql`` are merged into the
driver contract by ``__spark_entry__.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, conversation_repair, decision_list, importance, maxent, orc_tokens, postings, secret_scan, shards, simhash,
               surrogates, token_alignment, url_trees)
from .store import shared_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by Gumbel top-k from their importance weights; the target model is learnt
    from documents labelled good, the raw model from all."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = importance.labelled_target(documents, table(spark, sf_dir, "labels"))
    return importance.resample(marked, F.col("target"))


@_query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed maximum-entropy model learnt from the training documents, scoring all documents."""
    return maxent.score_documents(table(spark, sf_dir, "documents"))


@_query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional inverted index over all documents; exact matches of the 10-word windows of
    every benchmark item."""
    found = postings.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        postings.items_digest().alias("items_sha256"), "contaminated")


@_query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as ORC in ascending doc_id order; digests of what the
    files hold."""
    path = shared_path(spark, "token-files")
    encoder = orc_tokens.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    orc_tokens.write_token_files(table(spark, sf_dir, "documents"), path, encoder, end_id=2)
    return orc_tokens.id_digests(orc_tokens.read_token_files(spark, path))


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base checks and a decision list learnt from the labels."""
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: trigram index, candidates, verified spans."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("found", lambda s: s["kind"] == kind)
    base = F.filter("found", lambda s: s["number"] < len(secret_scan.BASE))
    return found.select(
        "doc_id", *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in secret_scan.BASE],
        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"), secret_scan.span_list(F.col("found")).alias("spans"))


#: Key of the surrogates; a production run passes its own.
PII_KEY = "public-test-key"


@_query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by keyed surrogates."""
    replaced = surrogates.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return replaced.select("doc_id", "text", "entities.*")


@_query
def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at three or fewer differing bits, and groups."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=3)


@_query
def op9_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the two-tier lookup and decoded again."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), ranks)


@_query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, and where none fits by boosted trees that learn
    from the URLs that a rule labels."""
    return url_trees.judge(table(spark, sf_dir, "pages").select("page_id", "url"), F.col("rule_verdict"))


#: Shards and seed of the sharding query.
SHARDS, SHARD_SEED = 40, 11


@_query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into shard files whose row counts differ by one at most; what the files hold."""
    files = shards.write_shards(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    return files.select(
        "record.doc_id", shards.record_size("record.text").alias("size"),
        F.crc32(F.coalesce("record.text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and their lightest repair."""
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut by a byte-level and a piece tokenizer, aligned; links counted corpus-wide."""
    aligner = token_alignment.Aligner(token_alignment.ByteLevelEncoder(public_tokenizers.path("byte_bpe_50k.json")),
                                      token_alignment.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model")))
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), aligner)
