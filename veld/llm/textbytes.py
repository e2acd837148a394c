"""Arrow string columns as flat byte buffers, and words in them, without Python strings.

Text stays in its UTF-8 bytes: every word class used here is a set of ASCII bytes plus all
bytes of multi-byte characters, so a 256-entry table decides each byte and runs of bytes
are words.  ``pieces`` keeps the memory of a task bounded however wide a batch is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task.
PIECE_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: The white space bytes that separate words, [\x20\x09-\x0D].
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE

#: Fixed values: [^\x00-\x2F\x3A-\x60\x7B-\x7F], on lower-cased text.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, one more than rows, from 0) and bytes of a string column; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    kind = np.int64 if large else np.int32
    if len(column) == 0 or off is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def pieces(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Sub-batches of at most ``limit`` text bytes each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


class Words:
    """The words of a piece: byte spans, and the first word of each row.

    ``kinds`` has a kind for each byte, false or 0 outside words; a word is a run of one kind."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, kinds: np.ndarray):
        self.data = data
        kind = kinds[data]
        inside = kind != 0
        row_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        change = kind[1:] != kind[:-1]
        fresh = inside.copy()
        fresh[1:] &= change
        fresh[row_starts] = inside[row_starts]
        last = inside.copy()
        last[:-1] &= change
        before = row_starts[row_starts > 0] - 1
        last[before] = inside[before]
        self.inside = inside
        self.starts = np.flatnonzero(fresh)
        self.ends = np.flatnonzero(last) + 1
        #: word index at which each row begins; one more entry than rows
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def strings(self) -> pa.Array:
        """The words as an Arrow array of bytes."""
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        return byte_strings(offsets, self.data[self.inside])

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def byte_strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data))])


def encode(strings: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Index of each string in the distinct strings, and those."""
    coded = pc.dictionary_encode(strings)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hash_strings(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte string: FNV-1a over 8-byte lanes, then scrambled."""
    offsets, data = buffers(strings)
    n = len(strings)
    lengths = np.diff(offsets)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    keep = (np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1)
    h = np.full(n, (0xCBF29CE484222325 + seed * 0x9E3779B97F4A7C15) & (2**64 - 1), np.uint64) ^ lengths.astype(np.uint64)
    active = np.flatnonzero(lengths > 0)
    at = 0
    with np.errstate(over="ignore"):
        while len(active):
            left = lengths[active] - at
            lane = lanes[offsets[active] + at]
            short = left < 8
            lane[short] &= keep[left[short]]
            h[active] = mix64((h[active] ^ lane) * np.uint64(0x100000001B3))
            at += 8
            active = active[left > 8]
    return mix64(h)
