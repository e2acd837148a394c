"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has a bit set if more than half of its shingles' hashes have it set.
Fingerprints at most three bits apart are linked.  To find links without comparing all:

* Equal fingerprints are merged first, so copies never meet again.
* A fingerprint is cut into four segments of 16 bits.  Three errors leave one segment
  untouched, and of the other three at least one has one error at most.
* A segment, padded to 23 bits, is decoded to the nearest word of the binary Golay code (the
  perfect code: every word is within three errors of exactly one code word) and named by its
  12-bit index.  A segment's neighbours at one error decode to the same word or, near the
  border, to a few others; those indices are the segment's keys.  Two segments one error
  apart share one: the index that one of them itself decodes to.
* A key joins (the untouched segment, an index of another segment): 28 bits, 12 choices of
  segments and about five indices each.  Fingerprints that share a key, in one of them by its
  own index, are compared.
* A key with more than ``MAX_IN_KEY`` fingerprints is not compared in pairs.  Its members go
  through an exact way whose rows grow only with their number: each names every point within
  two errors, and all that meet at a point which is within one error of one of them are
  linked to that one (at most 2 + 1 errors).

Links become groups by the alternating star algorithm, whose rounds are written to the shared
folder.  No step collects links or fingerprints to the driver, and joins of narrow tables are
hinted to merge: a broadcast would build its table in the driver, 64 MB at least each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .textbytes import LOWER, NOT_SPACE, Words, buffers, pieces
from .xxh64 import xxh64

SEED = 42
#: Fingerprints of one key that are compared in pairs; larger keys take the exact way.
MAX_IN_KEY = 128
MAX_BITS = 3
#: Bytes of text hashed at once; a shingle takes 64 counters of its bits for a moment.
HASH_BYTES = 1 << 20
#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101


def shingle_hashes(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts one after the other, and where each text's begin.
    A text of fewer words is one shingle; one without words has none."""
    offsets, data = buffers(column)
    w = Words(offsets, LOWER[data], NOT_SPACE)
    sizes = w.ends - w.starts
    compact = np.append(0, np.cumsum(sizes))
    spaced = np.insert(w.data[w.inside], compact[1:-1], 0x20) if len(w) else np.zeros(0, np.uint8)
    begin = compact[:-1] + np.arange(len(w))
    end = begin + sizes
    count = np.where(w.counts > 0, np.maximum(w.counts - words + 1, 1), 0)
    first = np.append(0, np.cumsum(count))
    row = np.repeat(np.arange(len(count)), count)
    i = w.first[:-1][row] + np.arange(first[-1]) - first[:-1][row]
    j = np.minimum(i + words, w.first[1:][row]) - 1
    return xxh64(spaced, begin[i], end[j], SEED), first


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The fingerprint of each text; without hashes, zero."""
    out = np.zeros(len(first) - 1, np.uint64)
    count = np.diff(first)
    some = np.flatnonzero(count)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, first[:-1][some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > count[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The id and ``fp`` (the fingerprint as a signed long) of every row.

    Words are cut at white space after A-Z are lower-cased.  A null or empty text, or one
    without words, has fingerprint zero and is linked like any other.  Null and repeated ids
    are kept; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", HASH_BYTES):
            fp = majority_bits(*shingle_hashes(piece.column("text"), words))
            yield pa.RecordBatch.from_pydict({"id": piece.column("id"), "fp": pa.array(fp.view(np.int64))})

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id)


def golay_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the code word nearest to each 23-bit word."""
    errors = np.zeros(2048, np.int64)
    patterns = [sum(1 << b for b in c) for n in range(4) for c in combinations(range(23), n)]
    errors[_syndrome(np.array(patterns))] = patterns
    return (words ^ errors[_syndrome(words)]) >> 11


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ GOLAY << (bit - 11), rest)
    return rest


@lru_cache(maxsize=1)
def segment_keys() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 16-bit segment: the index it decodes to; and, one after the other, all distinct
    indices of itself and its neighbours at one error, and where each segment's begin."""
    segments = np.arange(1 << 16)
    near = np.stack([golay_index((segments ^ flip) << 7) for flip in [0, *(1 << b for b in range(16))]], axis=1)
    own = near[:, 0].copy()
    near.sort(axis=1)
    fresh = np.ones(near.shape, bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    return own, near[fresh], np.append(0, np.cumsum(fresh.sum(axis=1)))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, near, first = segment_keys()
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        segments = [(fp.view(np.uint64) >> np.uint64(16 * k)).astype(np.int64) & 0xFFFF for k in range(4)]
        for i in range(4):
            for j in range(4):
                if i == j:
                    continue
                count = np.diff(first)[segments[j]]
                row = np.repeat(np.arange(len(fp)), count)
                at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[segments[j]][row]
                index = near[at]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array((i * 4 + j) << 28 | segments[i][row] << 12 | index),
                    "fp": pa.array(fp[row]), "own": pa.array(index == own[segments[j]][row])})


def _pairs(fp: np.ndarray, own: np.ndarray, start: np.ndarray, size: np.ndarray, bits: int):
    """Verified pairs inside the groups ``fp[start:start + size]``."""
    for s in np.unique(size[size > 1]):
        groups = start[size == s]
        i, j = np.triu_indices(s, 1)
        step = max(1, (1 << 21) // len(i))
        for k in range(0, len(groups), step):
            at = groups[k:k + step][:, None] + np.arange(s)
            a, b = fp[at][:, i], fp[at][:, j]
            good = (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= bits) & (own[at][:, i] | own[at][:, j])
            yield a[good], b[good]


def _match(bits: int):
    """Links (a, b) among rows sorted by key, and (a, null) for members of overfull keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        overfull = None

        def overfull_rows(fp):
            return pa.RecordBatch.from_pydict({"a": pa.array(fp), "b": pa.nulls(len(fp), pa.int64())})

        def done(key, fp, own):
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.append(start, len(key)))
            big = np.repeat(size > MAX_IN_KEY, size)
            if big.any():
                yield overfull_rows(fp[big])
            fit = (size > 1) & (size <= MAX_IN_KEY)
            for a, b in _pairs(fp, own, start[fit], size[fit], bits):
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(np.maximum(a, b)), "b": pa.array(np.minimum(a, b))})

        for batch in batches:
            key, fp, own = (np.concatenate([r, batch.column(c).to_numpy(zero_copy_only=False)])
                            for r, c in zip(rest, ("key", "fp", "own"), strict=True))
            if overfull is not None:
                known = key == overfull
                if known.any():
                    yield overfull_rows(fp[known])
                key, fp, own = key[~known], fp[~known], own[~known]
            if not len(key):
                rest = [key, fp, own]
                continue
            last = int(np.searchsorted(key, key[-1]))
            yield from done(key[:last], fp[:last], own[:last])
            rest = [key[last:], fp[last:], own[last:]]
            if len(key) - last > MAX_IN_KEY:
                overfull = key[-1]
                yield overfull_rows(fp[last:])
                rest = [r[:0] for r in rest]
        yield from done(*rest)

    return run


def _points(bits: int):
    """Every point within two errors of each fingerprint (one, if ``bits`` is below 3)."""
    near = [0, *(1 << b for b in range(64))] if bits > 1 else [0]
    far = {3: [(1 << a) | (1 << b) for a, b in combinations(range(64), 2)], 2: [], 1: [1 << b for b in range(64)], 0: []}
    flips = np.array(near + far[bits], np.uint64)
    is_near = np.arange(len(flips)) < len(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for k in range(0, len(fps), 256):
                fp = fps[k:k + 256]
                yield pa.RecordBatch.from_pydict({
                    "point": pa.array((fp.view(np.uint64)[:, None] ^ flips).ravel().view(np.int64)),
                    "fp": pa.array(np.repeat(fp, len(flips))), "near": pa.array(np.tile(is_near, len(fp)))})

    return run


def links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) at most ``bits`` apart: all
    pairs outside overfull keys, and inside them enough to connect whatever is linked."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError("the scheme is built for at most three differing bits")
    found = written(distinct.select("fp").mapInArrow(_keys, "key long, fp long, own boolean")
                    .repartition("key").sortWithinPartitions("key")
                    .mapInArrow(_match(bits), "a long, b long").distinct(), "simhash-links")
    overfull = found.filter("b IS NULL").select(F.col("a").alias("fp"))
    points = overfull.mapInArrow(_points(bits), "point long, fp long, near boolean")
    centre = points.filter("near").groupBy("point").agg(F.min("fp").alias("b"))
    more = points.join(centre.hint("merge"), "point").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return found.filter("b IS NOT NULL").union(more).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for all nodes of ``edges`` (a, b).

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the
    smallest node it knows, until the edges are stars.  Rounds grow with the logarithm of the
    longest path; each is written to the shared folder."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "stars")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(smallest.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = written(large.join(low.hint("merge"), "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").filter("a <> b").distinct(), "stars")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
                .union(edges.select(F.col("b"), F.col("b")).distinct())
        before = now


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = MAX_BITS, text: str = "text",
                    id: str = "doc_id") -> DataFrame:
    """Every row's id, ``fingerprint`` (16 hex digits) and ``component_id``: the smallest id of
    all rows reachable over links, its own included (null ids are never the smallest; null if
    there is no other)."""
    prints = written(fingerprints(docs, words, text, id), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min(id).alias("rep")), "distinct-fingerprints")
    roots = written(components(links(distinct, bits)), "simhash-roots")
    linked = roots.join(distinct.hint("merge"), roots.node == distinct.fp).select("fp", "rep", "root")
    smallest = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(smallest.hint("merge"), "root").select("fp", "component_id")
    # written, so that the join below is one plain join, whose large keys Spark can split
    group = written(distinct.join(named.hint("merge"), "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id")),
                    "fingerprint-groups")
    return prints.join(group.hint("merge"), "fp").select(
        id, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
