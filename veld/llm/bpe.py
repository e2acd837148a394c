"""Byte-level BPE encoding and decoding by a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary's byte strings answers for every
pre-token that is itself a token.  Distinct pre-tokens of a piece are looked up together and
each answer is compared with the vocabulary's bytes, so a foreign string never passes.
Second tier: the other pre-tokens are merged byte by byte; the bytes form a linked list and
a heap yields the pair of lowest rank (the leftmost of equals), so a pre-token of n bytes
takes O(n log n) steps however long it is.

Null and empty texts have no ids.  Rows are independent: repeated rows give repeated
results, an empty table gives none, and other columns of the input are never looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import pretokens
from .textbytes import byte_strings, encode, hash_strings, mix64, pieces


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (a base64 token and its rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash: n byte strings to n slots, without empty slots.

    Strings fall into small buckets; buckets, the largest first, try displacements until all
    their strings land in free slots.  Buckets of one string take a free slot directly,
    stored as a negative displacement.
    """

    def __init__(self, strings: pa.Array, per_bucket: int = 2):
        self.size = n = len(strings)
        self.buckets = max(1, n // per_bucket)
        hashes = hash_strings(strings)
        if len(np.unique(hashes)) != n:
            raise ValueError("two strings are equal or share a 64-bit hash")
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        start = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.displacement = np.zeros(self.buckets, np.int64)
        self.slot_of = np.zeros(n, np.int64)
        taken = np.zeros(n, bool)
        sizes = np.diff(start)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[start[b]:start[b + 1]]
            if len(members) < 2:
                break
            first, tries = 0, 16
            while True:
                trial = np.arange(first, first + tries)
                landed = np.sort(self._slots(hashes[members][None, :], trial[:, None]), axis=1)
                fits = ~taken[landed].any(axis=1) & (np.diff(landed, axis=1) > 0).all(axis=1)
                if fits.any():
                    break
                first, tries = first + tries, min(4 * tries, 4096)
            d = first + int(np.argmax(fits))
            slots = self._slots(hashes[members], d)
            taken[slots] = True
            self.displacement[b] = d
            self.slot_of[members] = slots
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            self.displacement[b] = -1 - slot
            self.slot_of[order[start[b]]] = slot

    def _slots(self, hashes: np.ndarray, displacement) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = mix64(hashes + (np.asarray(displacement, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        return (mixed % np.uint64(self.size)).astype(np.int64)

    def lookup(self, strings: pa.Array) -> np.ndarray:
        """The slot of each string; for strings outside the set, any slot."""
        if not self.size:
            return np.zeros(len(strings), np.int64)
        hashes = hash_strings(strings)
        d = self.displacement[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._slots(hashes, np.maximum(d, 0).astype(np.uint64)))


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token by merging its bytes, the pair of lowest rank first."""
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = after.copy()               # a piece begins at its index and ends here; 0 once merged away
    get = ranks.get
    heap = []
    for i in range(n - 1):
        rank = get(word[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        if not end[i]:
            continue
        j = after[i]
        if j >= n or end[j] != stop:     # one of the pair has grown since
            continue
        end[i], end[j] = stop, 0
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = get(word[i:end[k]])
            if rank is not None:
                push(heap, (rank, i, end[k]))
        h = before[i]
        if h >= 0:
            rank = get(word[h:stop])
            if rank is not None:
                push(heap, (rank, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = after[i]
    return out


class TwoTier:
    """Encoder and decoder over a rank table.  Sent to the tasks once, as a broadcast; its
    size is that of the vocabulary.  Every single byte must have a rank."""

    #: Merged pre-tokens that a worker remembers; a full memory is emptied.
    REMEMBERED = 300_000

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs a rank for every byte")
        tokens = list(ranks)
        strings = pa.array(tokens, pa.large_binary())
        self.ranks = ranks
        self.perfect = PerfectHash(strings)
        order = np.empty(len(tokens), np.int64)
        order[self.perfect.slot_of] = np.arange(len(tokens))
        self.by_slot = strings.take(pa.array(order))
        self.slot_id = np.fromiter(ranks.values(), np.int64, len(ranks))[order]
        self.id_slot = np.full(int(self.slot_id.max()) + 1, -1, np.int64)
        self.id_slot[self.slot_id] = np.arange(len(tokens))
        self.memory: dict[bytes, list[int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def distinct_ids(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens, one after the other, and where each begins."""
        slots = self.perfect.lookup(strings)
        hit = pc.equal(self.by_slot.take(pa.array(slots)), strings).to_numpy(zero_copy_only=False)
        counts = np.ones(len(strings), np.int64)
        missed = np.flatnonzero(~hit)
        merged: list[int] = []
        memory = self.memory
        for k, word in zip(missed.tolist(), strings.take(pa.array(missed)).to_pylist(), strict=True):
            ids = memory.get(word)
            if ids is None:
                if len(memory) >= self.REMEMBERED:
                    memory.clear()
                ids = merge_bytes(word, self.ranks)
                if len(word) <= 64:
                    memory[word] = ids
            counts[k] = len(ids)
            merged += ids
        starts = np.zeros(len(strings) + 1, np.int64)
        np.cumsum(counts, out=starts[1:])
        ids = np.empty(starts[-1], np.int64)
        ids[starts[:-1][hit]] = self.slot_id[slots[hit]]
        if len(missed):
            inside = np.ones(len(ids), bool)
            inside[starts[:-1][hit]] = False
            ids[inside] = merged
        return ids, starts

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32-bit) of all texts one after the other, and where each text's begin."""
        strings, first = pretokens(column)
        index, distinct = encode(strings)
        return spread_ids(*self.distinct_ids(distinct), index, first)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after the other, and where each text's begin."""
        from .textbytes import buffers
        slots = self.id_slot[ids]
        if (slots < 0).any():
            raise ValueError("an id is not in the vocabulary")
        offsets, data = buffers(self.by_slot.take(pa.array(slots)))
        return data, offsets[first]


def spread_ids(ids: np.ndarray, starts: np.ndarray, index: np.ndarray,
               first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pre-tokens ``index`` in order, from the ids of the distinct ones."""
    counts = np.diff(starts)[index]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts[:-1][index], counts)
    bounds = np.append(0, ends)[first]
    return ids[at].astype("<u4"), bounds


def bpe_encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", id: str = "doc_id",
               decoded: bool = False) -> DataFrame:
    """``id``, ``ids`` (array of int) and, with ``decoded``, ``bytes`` decoded back from them."""
    shared = docs.sparkSession.sparkContext.broadcast(TwoTier(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for piece in pieces(batches, "text"):
            ids, first = coder.encode_column(piece.column("text"))
            out = {"id": piece.column("id"),
                   "ids": pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))}
            if decoded:
                data, at = coder.decode(ids, first)
                out["bytes"] = byte_strings(at, data).cast(pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, ids array<int>" + (", bytes binary" if decoded else "")
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")) \
        .mapInArrow(run, schema).withColumnRenamed("id", id)


def bpe_digests(docs: DataFrame, ranks: dict[bytes, int], text: str = "text",
                id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per row: ``n_tokens``, and the SHA-256 of its ids (little-endian, unsigned, 32 bits)
    and of the bytes decoded from them, hashed where they are made; with ``with_ids`` also
    the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(TwoTier(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for piece in pieces(batches, "text"):
            ids, first = coder.encode_column(piece.column("text"))
            data, at = coder.decode(ids, first)
            data = np.ascontiguousarray(data)
            rows = range(piece.num_rows)
            out = {
                "id": piece.column("id"),
                "n_tokens": pa.array(np.diff(first), pa.int64()),
                "ids_sha256": [hashlib.sha256(ids[first[i]:first[i + 1]]).hexdigest() for i in rows],
                "decoded_sha256": [hashlib.sha256(data[at[i]:at[i + 1]]).hexdigest() for i in rows]}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema) \
        .withColumnRenamed("id", id)
