"""Token ids in ORC files, in ascending order of document id.

One row per document: ``part`` (the file's place in the order), the id, ``local_start`` (ids
of the documents before it in its part), ``n_tokens`` and ``ids``.  ORC stores whole numbers
by run-length encoding (ids bit-packed, starts and ids of documents as deltas), keeps
minimum and maximum per stripe and per row group of ``ROWS_PER_INDEX`` rows, and a Bloom
filter on the document id.  A manifest, one row per part, has the range of document ids and
the number of ids before the part, so a document's global ``start`` needs no scan of the ids
before it.  Spark reads stripes in parallel and skips those that a filter on the id excludes.

The ids come from the tokenizers library.  Where a tokenizer file cuts texts by the public
byte-level pattern and does nothing else to them, the distinct pre-tokens of a piece are
encoded once each and joined in order, which gives the same ids (``tests/llm``); a text that
contains an added token, and any text under another kind of tokenizer, is encoded whole.

Null and empty texts have only the end id.  Null document ids come first.  Rows with equal
ids are in order of their texts' hash; equal rows stay as often as they come.  An empty table
gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import spread_ids
from .pretokens import pretokens
from .textbytes import buffers, encode, pieces

ROWS_PER_INDEX = 1000
STRIPE_BYTES = 64 << 20
#: Bytes of text encoded at once; more than elsewhere, as more pre-tokens in it repeat.
PIECE_BYTES = 8 << 20
#: Share of absent ids that a Bloom filter lets pass.
FALSE_POSITIVES = 0.01


class LibraryEncoder:
    """The tokenizers library over text columns.  Holds the tokenizer file's text, which is
    sent to the tasks; each worker builds the tokenizer once."""

    #: Pre-tokens that a worker remembers; a full memory is emptied.
    REMEMBERED = 400_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.text = file.read()
        spec = json.loads(self.text)
        cutter = spec.get("pre_tokenizer") or {}
        self.by_pretoken = (spec.get("normalizer") is None and cutter.get("type") == "ByteLevel"
                            and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
                            and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout"))
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.tokenizer = None
        self.memory: tuple | None = None     # pre-tokens, their ids one after the other, where each's begin

    def __getstate__(self):
        return self.__dict__ | {"tokenizer": None, "memory": None}

    def texts(self, texts: list[str]) -> list[list[int]]:
        if self.tokenizer is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_str(self.text)
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        column = pc.fill_null(column, "")
        if not self.by_pretoken:
            return self._whole(column)
        special = np.zeros(len(column), bool)
        for content in self.added:
            special |= pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        if special.any():
            return self._whole(column)
        strings, first = pretokens(column)
        index, distinct = encode(strings)
        known, flat, starts = self.memory or (distinct[:0], np.zeros(0, np.int64), np.zeros(1, np.int64))
        at = pc.index_in(distinct, value_set=known)
        unseen = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[unseen] = len(known) + np.arange(unseen.sum())
        new = distinct.filter(pa.array(unseen))
        new_ids, new_starts = self._each(new)
        flat = np.concatenate([flat, new_ids])
        starts = np.concatenate([starts[:-1], new_starts + starts[-1]])
        self._remember(pa.concat_arrays([known, new]), flat, starts, at[np.bincount(index, minlength=len(at)) > 1])
        return spread_ids(flat, starts, at[index], first)

    def _remember(self, words: pa.Array, flat: np.ndarray, starts: np.ndarray, repeated: np.ndarray) -> None:
        """Keep what was known and the new pre-tokens that this piece repeats; if that is too
        much, only what it repeats, and if that is too much, nothing."""
        known = 0 if self.memory is None else len(self.memory[0])
        keep = np.zeros(len(words), bool)
        keep[repeated] = True
        if known + keep[known:].sum() <= self.REMEMBERED:
            keep[:known] = True
        elif keep.sum() > self.REMEMBERED:
            keep[:] = False
        counts = np.diff(starts)
        self.memory = (words.filter(pa.array(keep)), flat[np.repeat(keep, counts)],
                       np.append(0, np.cumsum(counts[keep])))

    def _each(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, one after the other, and where each begins.  One call encodes them
        as one text with a line end before each: the pattern cuts there again, and no other
        pre-token has the line end's id.  White space, which would run together with the line
        ends, goes to the library one by one, as does all if the line ends don't come out."""
        blank = pc.utf8_is_space(words.cast(pa.large_string())).to_numpy(zero_copy_only=False)
        if len(words) and not blank.all():
            offsets, data = buffers(words.filter(pa.array(~blank)))
            text = np.insert(data, offsets, 10).tobytes().decode(errors="replace")
            joined, (line_end,) = self.texts([text, "\n"])
            joined = np.array(joined, np.int64)
            at = np.flatnonzero(joined == line_end)
            if len(at) == len(offsets):
                counts = np.empty(len(words), np.int64)
                counts[~blank] = np.diff(at) - 1
                singles = self.texts(pc.filter(words, pa.array(blank)).cast(pa.large_string()).to_pylist())
                counts[blank] = [len(x) for x in singles]
                starts = np.append(0, np.cumsum(counts))
                ids = np.empty(starts[-1], np.int64)
                of_blank = np.repeat(blank, counts)
                ids[~of_blank] = joined[joined != line_end]
                ids[of_blank] = [x for y in singles for x in y]
                return ids, starts
        lists = self.texts(words.cast(pa.large_string()).to_pylist())
        starts = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)
        return np.fromiter((x for y in lists for x in y), np.int64, starts[-1]), starts

    def _whole(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self.texts(column.to_pylist())
        first = np.zeros(len(ids) + 1, np.int64)
        np.cumsum([len(x) for x in ids], out=first[1:])
        return np.fromiter((x for y in ids for x in y), "<u4", first[-1]), first


def with_end(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` behind the ids of each text."""
    return np.insert(ids, first[1:], end), first + np.arange(len(first))


def write_token_files(docs: DataFrame, path: str, encoder: LibraryEncoder, end_id: int,
                      text: str = "text", id: str = "doc_id") -> None:
    """Encode ``docs`` and write the token files and their manifest to ``path``.

    Texts are dealt by ranges of (id, input partition), so a repeated id does not gather in one
    task, and sorted by id and text hash inside each range.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(encoder)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, done = shared.value, TaskContext.get().partitionId(), 0
        for piece in pieces(batches, "text", PIECE_BYTES):
            ids, first = with_end(*coder.encode_column(piece.column("text")), end_id)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(piece.num_rows, part), pa.int32()),
                "id": piece.column("id"),
                "local_start": pa.array(first[:-1] + done, pa.int64()),
                "n_tokens": pa.array(np.diff(first), pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))})
            done += int(first[-1])

    (docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.spark_partition_id().alias("p"))
        .repartitionByRange("id", "p").sortWithinPartitions("id", F.xxhash64("text")).select("id", "text")
        .mapInArrow(run, f"part int, id {kind}, local_start long, n_tokens long, ids array<int>")
        .withColumnRenamed("id", id)
        .write.mode("overwrite").format("orc")
        .option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true").option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", id).option("orc.bloom.filter.fpp", FALSE_POSITIVES)
        .save(f"{path}/ids"))
    parts = spark.read.orc(f"{path}/ids").groupBy("part").agg(
        F.min(id).alias("first_id"), F.max(id).alias("last_id"), F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))) \
        .coalesce(1).write.mode("overwrite").orc(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the token files: id, ``start``, ``n_tokens``, ``ids``.

    A filter on the id reaches the scan and skips stripes and row groups."""
    ids = spark.read.orc(f"{path}/ids")
    base = spark.read.orc(f"{path}/manifest").select("part", "base")
    id = next(c for c in ids.columns if c not in ("part", "local_start", "n_tokens", "ids"))
    return ids.join(base, "part").select(id, (F.col("base") + F.col("local_start")).alias("start"),
                                         "n_tokens", "ids")


def id_digests(tokens: DataFrame, id: str = "doc_id") -> DataFrame:
    """Per document: ``start``, ``n_tokens`` and the CRC-32 of its ids as little-endian
    unsigned 32-bit integers, from what the files hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            first = ids.offsets.to_numpy().astype(np.int64)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "start": batch.column("start"),
                "n_tokens": pa.array(np.diff(first), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(flat[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)], pa.int64())})

    kind = tokens.schema[id].dataType.simpleString()
    return tokens.select(F.col(id).alias("id"), "start", "ids") \
        .mapInArrow(run, f"id {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id)
