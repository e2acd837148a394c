"""Alignment of two tokenizations of the same texts by lockstep vectorised merging.

Both tokenizations cut the same bytes.  One NumPy state holds a pointer into the A tokens and
one into the B tokens of every document of a piece at once.  A step links the two tokens of each
pair of pointers, marks a cut where both end, advances the pointer of the token that ends first
(both at a cut), and drops finished documents from the state.  So a piece takes as many steps
as its longest lane has links: a document of more than ``LANE`` tokens enters as several lanes, cut
where both tokenizations have an end, and is no longer than others.

How often an id pair is linked corpus-wide is a Spark aggregate.  Workers number the distinct
pairs of ``GROUP_BYTES`` of text; the pairs' counts come back to their group, where each document's
own pairs (packed, sorted numbers) wait in a table, and only there are they summed.  Links of single
documents are never shuffled one by one, and no task has more than a group.

Defined results.  Null and empty texts, and those that a tokenizer does not give back byte by
byte, have no tokens: zeros and an empty hash.  Rows are independent but for the counts; repeated
rows count each time, null ids are kept.  An empty table gives no rows.  Other columns are never
looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import spread_ids
from .orc_tokens import LibraryEncoder
from .store import written
from .textbytes import buffers, byte_strings, encode, pieces

#: Text aligned at once, text whose pairs share one numbering, and pairs in one row.
PIECE_BYTES = 2 << 20
GROUP_BYTES = 64 << 20
CHUNK = 1 << 13
#: Tokens of the longest lane.
LANE = 1024


class ByteLevelEncoder(LibraryEncoder):
    """A byte-level tokenizer file; strings of special tokens in a text are plain text."""

    REMEMBERED = 150_000

    def __init__(self, path: str):
        super().__init__(path)
        self.added = []

    def texts(self, texts: list[str]) -> list[list[int]]:
        self.load()
        return super().texts(texts)

    def load(self):
        if self.tokenizer is None:
            super().texts([])
            self.tokenizer.encode_special_tokens = True
        return self.tokenizer

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: printable Latin-1 characters stand for themselves, the other byte
        values in order for the characters from U+0100 on."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        out: dict[int, bytes] = {}
        for entry, i in self.load().get_vocab(with_added_tokens=True).items():
            out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        return [out.get(i, b"") for i in range(max(out) + 1)]


class PieceEncoder:
    """A sentencepiece model.  Where no piece goes on with a space after another character, a merge
    never crosses the start of a run of spaces: texts are cut there and distinct parts encoded once."""

    #: Parts that a worker remembers; a full memory is emptied.
    REMEMBERED = 150_000

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = file.read()
        self.processor, self.memory = None, {}

    def __getstate__(self):
        return self.__dict__ | {"processor": None, "memory": {}}

    def load(self):
        if self.processor is None:
            import sentencepiece
            self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=self.model)
            entries = [p.id_to_piece(i) for i in range(p.get_piece_size())]
            probe = "a  b c"
            self.by_part = not any("▁" in e.lstrip("▁") for e in entries) and \
                "".join(p.encode(probe, out_type=str)) == "▁" + probe.replace(" ", "▁")
        return self.processor

    def token_bytes(self) -> list[bytes]:
        p = self.load()
        return [bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i) else
                p.id_to_piece(i).replace("▁", " ").encode() for i in range(p.get_piece_size())]

    def _each(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of parts that begin with a space, which the model adds, but not to an empty text."""
        p = self.load()
        lone = p.piece_to_id("▁")
        return [ids or [lone] for ids in p.encode([w[1:].decode() for w in parts], num_threads=1)]

    def encode_column(self, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin.  The texts come with
        the space before them that the model adds itself."""
        self.load()
        offsets, data = buffers(spaced)
        blank = data == 0x20
        starts = blank.copy()
        starts[1:] &= ~blank[:-1]
        starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        at = np.flatnonzero(starts) if self.by_part else offsets[:-1][offsets[:-1] < offsets[1:]]
        index, distinct = encode(byte_strings(np.append(at, len(data)), data))
        words = distinct.to_pylist()
        if len(self.memory) + len(words) > self.REMEMBERED:
            self.memory.clear()
        new = [w for w in words if w not in self.memory]
        self.memory.update(zip(new, self._each(new)))
        lists = [self.memory[w] for w in words]
        counts = np.append(0, np.cumsum([len(x) for x in lists]))
        ids = np.fromiter((i for x in lists for i in x), np.int64, counts[-1])
        return spread_ids(ids, counts, index, np.searchsorted(at, offsets))


class Tokens:
    """The tokens of the documents of a piece, one after the other, with the bytes where they end."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, strings: pa.Array, widths: np.ndarray):
        self.ids, self.first, self.strings, self.widths = ids.astype(np.int64), first, strings, widths

    def bytes_per_text(self) -> np.ndarray:
        ends = np.append(0, np.cumsum(self.widths[self.ids]))
        return np.diff(ends[self.first])

    def keep(self, texts: np.ndarray) -> Tokens:
        counts = np.diff(self.first)
        return Tokens(self.ids[np.repeat(texts, counts)], np.append(0, np.cumsum(counts[texts])), self.strings, self.widths)

    def joined(self) -> np.ndarray:
        return buffers(self.strings.take(pa.array(self.ids)))[1]

    def ends(self) -> np.ndarray:
        return np.cumsum(self.widths[self.ids])


def same_bytes(tokens: Tokens, spaced: pa.Array) -> np.ndarray:
    """Whether each text's tokens join to its bytes."""
    offsets, data = buffers(spaced)
    sizes = np.diff(offsets)
    out = tokens.bytes_per_text() == sizes
    match = tokens.keep(out).joined() == data[np.repeat(out, sizes)]
    bounds = np.append(0, np.cumsum(sizes[out]))
    wrong = np.append(0, np.cumsum(~match))[bounds]
    out[out] = np.diff(wrong) == 0
    return out


def lanes(a: Tokens, b: Tokens, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First A token, first B token and end of the A tokens of each lane."""
    starts_a, starts_b = [a.first[:-1]], [b.first[:-1]]
    for k in np.flatnonzero(np.diff(a.first) > LANE):
        mine, theirs = a_ends[a.first[k]:a.first[k + 1]], b_ends[b.first[k]:b.first[k + 1]]
        at = np.searchsorted(theirs, mine)
        common = np.flatnonzero(theirs[np.minimum(at, len(theirs) - 1)] == mine)[:-1]
        marks = np.searchsorted(common, np.arange(LANE, len(mine), LANE))
        chosen = np.unique(common[marks[marks < len(common)]])
        starts_a.append(a.first[k] + chosen + 1)
        starts_b.append(b.first[k] + at[chosen] + 1)
    i, j = np.sort(np.concatenate(starts_a)), np.sort(np.concatenate(starts_b))
    return i, j, np.append(i[1:], len(a.ids))


def lockstep(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A and B token of every link, and whether each A and each B token ends a group."""
    a_ends, b_ends = a.ends(), b.ends()
    i, j, stop = lanes(a, b, a_ends, b_ends)
    links_a, links_b = (np.empty(len(a.ids) + len(b.ids), np.int32) for _ in range(2))
    cut_a, cut_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    n = 0
    while len(i):
        links_a[n:n + len(i)], links_b[n:n + len(i)] = i, j
        n += len(i)
        ahead = a_ends[i] - b_ends[j]
        cut = ahead == 0
        cut_a[i[cut]] = True
        cut_b[j[cut]] = True
        i = i + (ahead <= 0)
        j = j + (ahead >= 0)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return links_a[:n], links_b[:n], cut_a, cut_b


def group_hashes(a: Tokens, b: Tokens, cut_a: np.ndarray, cut_b: np.ndarray, words: pa.Array) -> list[str]:
    """The hash of each text's ``a1,a2|b1;a3|b2,b3``.  ``words`` has, for all A ids, the id with a comma and
    with a bar, then for all B ids the id with a comma, with a semicolon and bare."""
    size_a, size_b = len(a.widths), len(b.widths)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    a_through = np.flatnonzero(cut_a) + 1                       # A tokens up to the end of each group
    b_before = np.append(0, np.flatnonzero(cut_b) + 1)          # B tokens before each group
    out = np.empty(len(a.ids) + len(b.ids), np.int64)
    out[np.arange(len(a.ids)) + b_before[group_a]] = a.ids + np.where(cut_a, size_a, 0)
    last = np.zeros(len(b.ids), bool)
    last[b.first[1:] - 1] = True
    out[np.arange(len(b.ids)) + a_through[group_b]] = b.ids + 2 * size_a + np.where(last, 2 * size_b, np.where(cut_b, size_b, 0))
    offsets, data = buffers(words.take(pa.array(out)))
    at = offsets[a.first + b.first]
    data = np.ascontiguousarray(data)
    return [hashlib.sha256(data[s:e]).hexdigest() for s, e in zip(at[:-1], at[1:])]


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their low bytes first, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Aligner:
    """Sent to the tasks once, as a broadcast: two tokenizer files, whose size is fixed."""

    def __init__(self, a: ByteLevelEncoder, b: PieceEncoder):
        self.a, self.b, self.tables = a, b, None

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def _load(self):
        if self.tables is None:
            sides = []
            for coder in (self.a, self.b):
                strings = pa.array(coder.token_bytes(), pa.large_binary())
                sides.append((strings, np.diff(buffers(strings)[0])))
            names = [str(i) + end for (strings, _), ends in zip(sides, (",|", (",", ";", ""))) for end in ends
                     for i in range(len(strings))]
            self.tables = sides, pa.array(names, pa.large_binary())
        return self.tables

    def align(self, texts: pa.Array) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: numbers of tokens, groups and links and the hash; per link: its text, A id and B id."""
        sides, words = self._load()
        texts = pc.fill_null(texts, "")
        fits = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(" ", texts.filter(pa.array(fits)), "")
        a, b = (Tokens(*coder.encode_column(spaced), *side) for coder, side in zip((self.a, self.b), sides))
        good = same_bytes(a, spaced) & same_bytes(b, spaced)
        fits[fits] = good
        a, b = a.keep(good), b.keep(good)
        links_a, links_b, cut_a, cut_b = lockstep(a, b)
        n_a, n_b = np.diff(a.first), np.diff(b.first)
        n_groups = np.diff(np.append(0, np.cumsum(cut_a))[a.first])
        facts = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups}
        spread = {}
        for name, values in facts.items():
            spread[name] = np.zeros(len(texts), np.int64)
            spread[name][fits] = values
        spread["groups_sha256"] = np.full(len(texts), "", object)
        spread["groups_sha256"][fits] = group_hashes(a, b, cut_a, cut_b, words) if len(n_a) else []
        text_of = np.repeat(np.flatnonzero(fits), n_a)
        return spread, text_of[links_a], a.ids[links_a], b.ids[links_b]


class PairNumbers:
    """Numbers of the distinct pairs of a group, in order of their first piece, and their counts."""

    def __init__(self):
        self.keys, self.counts, self.bytes = pa.array([], pa.int64()), np.zeros(0, np.int64), 0

    def number(self, keys: np.ndarray) -> np.ndarray:
        index, distinct = encode(pa.array(keys))
        at = pc.index_in(distinct, value_set=self.keys)
        new = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[new] = len(self.keys) + np.arange(new.sum())
        self.keys = pa.concat_arrays([self.keys, distinct.filter(pa.array(new))])
        numbers = at[index]
        counts = np.bincount(numbers, minlength=len(self.keys))
        counts[:len(self.counts)] += self.counts
        self.counts = counts
        return numbers


DOCS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _pair_rows(group: int, pairs: PairNumbers, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    keys = pairs.keys.to_numpy()
    for start in range(0, len(keys), CHUNK):
        yield pa.RecordBatch.from_pylist([{"group": group, "start": start, "keys": keys[start:start + CHUNK],
                                           "counts": pairs.counts[start:start + CHUNK]}], schema=schema)


def aligned_pieces(docs: DataFrame, aligner: Aligner, text: str, id: str) -> DataFrame:
    """Rows of two kinds: the documents of a piece with their pairs' numbers, and pairs of a group
    with their counts in it."""
    shared = docs.sparkSession.sparkContext.broadcast(aligner)
    kind = docs.schema[id].dataType.simpleString()
    schema = (f"group bigint, start bigint, keys array<bigint>, counts array<bigint>, ids array<{kind}>, n_a array<bigint>, "
              "n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
              "sizes binary, steps binary, times binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, arrow = shared.value, None
        group, pairs = TaskContext.get().partitionId() << 24, PairNumbers()
        for piece in pieces(batches, "text", PIECE_BYTES):
            if arrow is None:
                arrow = pa.schema([("group", pa.int64()), ("start", pa.int64()), ("keys", pa.list_(pa.int64())),
                                   ("counts", pa.list_(pa.int64())), ("ids", pa.list_(piece.schema.field("id").type)),
                                   *[(c, pa.list_(pa.int64())) for c in DOCS[:-1]], ("groups_sha256", pa.list_(pa.string())),
                                   ("sizes", pa.binary()), ("steps", pa.binary()), ("times", pa.binary())])
            facts, row, a, b = coder.align(piece.column("text"))
            numbers = pairs.number(a << 32 | b)
            pairs.bytes += piece.column("text").nbytes
            # each document's distinct pairs in ascending order: distances and times
            order = np.sort(row << 32 | numbers)
            fresh = np.append(True, order[1:] != order[:-1])[:len(order)]
            at = np.flatnonzero(fresh)
            held, times = order[at], np.diff(np.append(at, len(order)))
            sizes = np.bincount(held >> 32, minlength=piece.num_rows)
            number = held & 0xFFFFFFFF
            steps = np.diff(number, prepend=0)
            heads = (np.cumsum(sizes) - sizes)[sizes > 0]
            steps[heads] = number[heads]
            yield pa.RecordBatch.from_pylist([{
                "group": group, "ids": piece.column("id").to_pylist(), **{c: facts[c] for c in DOCS},
                "sizes": _pack(sizes), "steps": _pack(steps), "times": _pack(times)}], schema=arrow)
            if pairs.bytes >= GROUP_BYTES:
                yield from _pair_rows(group, pairs, arrow)
                group, pairs = group + 1, PairNumbers()
        if len(pairs.keys):
            yield from _pair_rows(group, pairs, arrow)

    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def align_documents(docs: DataFrame, aligner: Aligner, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    table = written(aligned_pieces(docs, aligner, text, id), "aligned")
    pairs = table.filter("keys IS NOT NULL").select("group", "start", F.posexplode(F.arrays_zip("keys", "counts")).alias("at", "pair")) \
        .select("group", (F.col("start") + F.col("at")).alias("number"), F.col("pair.keys").alias("key"), F.col("pair.counts").alias("n"))
    counts = pair_counts(pairs)
    # one row for each pair of a group: the join's largest key is the number of groups
    back = pairs.select("group", "number", "key").join(counts.hint("merge"), "key").groupBy(
        "group", F.floor(F.col("number") / CHUNK).alias("start")).agg(
            F.collect_list("number").alias("number"), F.collect_list("n").alias("n"), F.collect_list("best").alias("best"))
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    held = table.filter("ids IS NOT NULL").drop("start", "keys", "counts")
    return back.unionByName(held, allowMissingColumns=True).repartition("group") \
        .sortWithinPartitions("group", F.col("number").isNull()).mapInArrow(_document_sums, schema).withColumnRenamed("id", id)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``key``, ``n`` (its links corpus-wide) and ``best`` (the most of its B id); a B id has at most as
    many pairs as A has ids."""
    counts = pairs.groupBy("key").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counts.select("key", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def _document_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a group come first, then its documents."""
    group, filled = None, False
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            get = lambda c: row.column(c)  # noqa: B023, E731
            if get("group")[0].as_py() != group:
                group, filled, parts = get("group")[0].as_py(), False, []
            if get("number").null_count == 0:
                parts.append([get(c).flatten().to_numpy(zero_copy_only=False) for c in ("number", "n", "best")])
                continue
            if not filled:
                number, n, best = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
                count, top = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
                count[number], top[number] = n, best
                filled, parts = True, []
            sizes, steps, times = (_unpack(get(c)[0].as_py()) for c in ("sizes", "steps", "times"))
            heads = np.cumsum(sizes) - sizes
            total = np.cumsum(steps)
            base = np.append(0, total)[heads]
            number = total - np.repeat(base, sizes)
            sums = [np.append(0, np.cumsum(times * values[number])) for values in (top, count)]
            n_best, count_sum = (np.diff(s[np.append(heads, len(steps))]) for s in sums)
            yield pa.RecordBatch.from_pydict({
                "id": get("ids").flatten(), **{c: get(c).flatten() for c in DOCS[:-1]},
                "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": get("groups_sha256").flatten()})
