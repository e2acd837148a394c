"""Quality selection by importance resampling.

Two generative models over hashed n-grams (words and pairs of words, ``BUCKETS`` hash
buckets) are counted: one over target texts, one over all raw texts.  A text's log importance
weight is the sum over its n-grams of the log ratio of their shares.  Adding independent
Gumbel noise to the weights and taking the k largest draws k texts without replacement with
probabilities in proportion to their weights.

A word followed by itself is one n-gram, whatever the word.
Words are runs of letters and digits or runs of other characters but white space, after A-Z
are lower-cased.  The noise is a hash of the id, so a retried task draws the same.  The k-th
largest key is found exactly from counts of its leading bits, 16 bits at a time, whatever k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written
from .textbytes import ALNUM, LOWER, NOT_SPACE, Words, buffers, encode, hash_strings, mix64, pieces

BUCKETS = 10_000
#: Bound on the labelled texts that the target model is counted on.
TARGET_ROWS = 100_000
SEED = 20

_KINDS = NOT_SPACE.astype(np.uint8) + (NOT_SPACE & ~ALNUM)


def ngram_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of each text, and the row of each."""
    offsets, data = buffers(column)
    words = Words(offsets, LOWER[data], _KINDS)
    index, distinct = encode(words.strings())
    h = hash_strings(distinct)[index]
    row = words.rows()
    pair = row[1:] == row[:-1]
    with np.errstate(over="ignore"):
        single = mix64(h + np.uint64(1))
        double = np.where(h[:-1] == h[1:], np.uint64(0), mix64(h[:-1] * np.uint64(3) + h[1:] * np.uint64(5) + np.uint64(2)))[pair]
    both = np.concatenate([single, double]) % np.uint64(BUCKETS)
    return both.astype(np.int64), np.concatenate([row, row[:-1][pair]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for piece in pieces(batches, "text"):
        bucket, row = ngram_buckets(piece.column("text"))
        chosen = piece.column("target").to_numpy(zero_copy_only=False)
        raw += np.bincount(bucket, minlength=BUCKETS)
        target += np.bincount(bucket[chosen[row]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen, pa.int32()), "raw": pa.array(raw[seen]),
                                      "target": pa.array(target[seen])})


def log_ratios(docs: DataFrame) -> np.ndarray:
    """Log of (share among target texts / share among all) for each bucket, add-one smoothed.
    ``docs`` has ``text`` and ``target`` (boolean)."""
    counted = docs.select("text", "target").mapInArrow(_count, "bucket int, raw long, target long") \
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    if counted.num_rows:
        at = counted.column("bucket").to_numpy()
        raw[at] += counted.column("raw").to_numpy()
        target[at] += counted.column("target").to_numpy()
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _gumbel(ids: pa.Array, seed: int) -> np.ndarray:
    text = ids.cast(pa.string()).fill_null("").cast(pa.binary())
    u = ((mix64(hash_strings(text, seed)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    return -np.log(-np.log(u))


def _weigh(ratios, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            bucket, row = ngram_buckets(piece.column("text"))
            n = np.bincount(row, minlength=piece.num_rows)
            weight = np.bincount(row, weights=ratios.value[bucket], minlength=piece.num_rows)
            key = weight + _gumbel(piece.column("id"), seed)
            bits = key.view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "id": piece.column("id"), "n_ngrams": pa.array(n, pa.int64()), "log_weight": pa.array(weight, pa.float64()),
                "gumbel_key": pa.array(key), "rank_bits": pa.array(bits ^ ((bits >> 63) & np.int64(2**63 - 1)))})
    return run


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, null if there are fewer rows.  Four counts of
    16 bits each; a count has 65,536 groups at most, and no row leaves Spark."""
    if k < 1:
        return None
    prefix = None
    left = k
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(column, shift)
        part = df if prefix is None else df.filter(F.shiftright(column, shift + 16) == prefix)
        counts = sorted(part.groupBy(digit.alias("d")).count().collect(), key=lambda r: -r["d"])
        for r in counts:
            if r["count"] >= left:
                prefix = r["d"]
                break
            left -= r["count"]
        else:
            return None
    return prefix


def resample(docs: DataFrame, target: Column, keep: int | None = None, text: str = "text", id: str = "doc_id",
             seed: int = SEED) -> DataFrame:
    """Per row: the id, ``n_ngrams``, ``log_weight``, ``gumbel_key`` and ``kept``, whether it is
    among the ``keep`` largest keys (rows that tie with the last are kept too).

    ``target`` marks rows of the target; both models come from this one pass.  Without
    ``keep``, k is the number of texts that the target model finds likelier than the raw one,
    or as likely.  Null and empty texts have no n-grams and weight 0.  Null ids share one draw
    of noise; rows with equal ids and texts get equal keys.  Other columns are ignored."""
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(target, F.lit(False)).alias("target"))
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs))
    kind = docs.schema["id"].dataType.simpleString()
    scored = written(docs.select("id", "text").mapInArrow(
        _weigh(ratios, seed), f"id {kind}, n_ngrams long, log_weight double, gumbel_key double, rank_bits long"), "weights")
    if keep is None:
        keep = scored.filter("log_weight >= 0").count()
    last = kth_largest(scored, "rank_bits", min(keep, scored.count()))
    kept = F.lit(False) if last is None else F.col("rank_bits") >= F.lit(last)
    return scored.select(F.col("id").alias(id), "n_ngrams", "log_weight", "gumbel_key", kept.alias("kept"))


def labelled_target(docs: DataFrame, labels: DataFrame, id: str = "doc_id", rows: int = TARGET_ROWS) -> DataFrame:
    """``docs`` with ``target``: whether the id is one of at most ``rows`` labelled good (quality
    1, not toxic), taken in order of the id's hash.  That bound is what makes the broadcast safe."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col(id).alias("good_id")) \
        .filter("good_id IS NOT NULL").distinct().orderBy(F.xxhash64("good_id"), "good_id").limit(rows)
    return docs.join(F.broadcast(good), docs[id] == good.good_id, "left") \
        .select(docs["*"], F.col("good_id").isNotNull().alias("target"))
