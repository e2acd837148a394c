"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` writes the index of a corpus: rows are segments (the documents of about
``SEGMENT_BYTES`` of text that one task reads together), and each segment holds its distinct
terms, every posting (the positions of a term, ascending) and the word ranges of its
documents.  Segments are independent, so a term that is in every document has a list per
segment, and no list grows with the corpus.  The index is a Parquet table in the shared
folder; a lost task rewrites its own segments only.

A phrase is looked up from its rarest term in the segment: that term's positions, less its
offset in the phrase, are the candidates, and each further list, from short to long, keeps
those it also holds at its own offset.  A phrase with an absent term ends at once.  Terms are
compared as bytes, so matches are exact.  ``proximity`` finds all terms of a phrase, in any
order, within a span of words.

Phrases come from a test set.  It is sent to the tasks in blocks of ``BLOCK_WORDS`` words, as
numbers, with one pass over the index for each block, so neither the set nor one of its items
has a greatest size; what the passes find is merged by document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import shared_path
from .textbytes import ALNUM, LOWER, PIECE_BYTES, Words, buffers, encode, pieces

SEGMENT_BYTES = PIECE_BYTES
#: Segments in a file of the index; a reader holds a file's segments at a time.
SEGMENTS_PER_FILE = 16
#: Words of test texts in one pass over the index; a longer item is cut, its cuts overlapping.
BLOCK_WORDS = 1 << 20

_SPLIT = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def build_index(docs: DataFrame, text: str = "text", id: str = "doc_id",
                is_word: np.ndarray = ALNUM) -> DataFrame:
    """The positional index of ``docs``, written and read back.

    Columns: ``segment``; ``doc_ids`` and ``n_words`` by document; ``terms``; ``first`` (where
    each term's postings begin, unsigned 64-bit) and ``positions`` (unsigned 32-bit, in words
    from the segment's start), both binary.  Null and empty texts are documents of no words;
    null and repeated ids are kept as they are; other columns are ignored."""
    kind = docs.schema[id].dataType.simpleString()

    def one_list(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for piece in pieces(batches, "text", SEGMENT_BYTES):
            offsets, data = buffers(piece.column("text"))
            words = Words(offsets, LOWER[data], is_word)
            index, terms = encode(words.strings())
            order = np.argsort(index, kind="stable")
            first = np.append(0, np.cumsum(np.bincount(index, minlength=len(terms)))).astype("<u8")
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([segment], pa.int64()),
                "doc_ids": one_list(piece.column("id")),
                "n_words": one_list(pa.array(words.counts, pa.int64())),
                "terms": one_list(terms.cast(pa.binary())),
                "first": pa.array([first.tobytes()], pa.binary()),
                "positions": pa.array([order.astype("<u4").tobytes()], pa.binary())})
            segment += 1

    path = shared_path(docs.sparkSession, "postings")
    schema = (f"segment long, doc_ids array<{kind}>, n_words array<long>, terms array<binary>, "
              "first binary, positions binary")
    (docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)
        .write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).option("compression", "zstd").parquet(path))
    return docs.sparkSession.read.parquet(path)


def index_documents(index: DataFrame, id: str = "doc_id") -> DataFrame:
    """``segment``, ``doc_no``, the id and ``n_words`` of every indexed document."""
    return index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("doc_no", "d")) \
        .select("segment", "doc_no", F.col("d.doc_ids").alias(id), F.col("d.n_words").alias("n_words"))


class Segment:
    """One segment in a task."""

    def __init__(self, n_words, terms, first: bytes, positions: bytes):
        self.first_word = np.append(0, np.cumsum(n_words)).astype(np.int64)
        self.terms, self.first = terms, np.frombuffer(first, "<u8").astype(np.int64)
        self.positions = np.frombuffer(positions, "<u4")

    def numbers(self, terms: pa.Array) -> np.ndarray:
        """The segment's number of each term, or -1."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy(zero_copy_only=False)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.first[term]:self.first[term + 1]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_word, positions, "right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Start positions of the phrase within one document, ascending."""
        sizes = self.first[terms + 1] - self.first[terms]
        starts = None
        for k in np.argsort(sizes, kind="stable").tolist():
            at = self.postings(terms[k])
            if starts is None:
                starts = at.astype(np.int64) - k
                starts = starts[starts >= 0]
                inside = self.document(starts) == self.document(starts + len(terms) - 1)
                starts = starts[inside & (starts + len(terms) <= self.first_word[-1])]
            else:
                found = np.searchsorted(at, starts + k)
                found[found == len(at)] = 0
                starts = starts[at[found] == starts + k]
            if not len(starts):
                break
        return starts

    def proximity(self, terms: np.ndarray, span: int) -> list[tuple[int, int]]:
        """Shortest stretches (first and last position) of one document, at most ``span`` words
        long, that hold every distinct term: found around each posting of the rarest one."""
        terms = np.unique(terms)
        sizes = self.first[terms + 1] - self.first[terms]
        lists = [self.postings(t).astype(np.int64) for t in terms[np.argsort(sizes, kind="stable")]]
        out = set()
        for p in lists[0].tolist():
            doc = int(self.document(np.array([p]))[0])
            low, high = max(p - span + 1, self.first_word[doc]), min(p + span, self.first_word[doc + 1])
            near = [x[np.searchsorted(x, low):np.searchsorted(x, high)] for x in lists]
            if any(not len(x) for x in near):
                continue
            events = sorted((int(q), k) for k, x in enumerate(near) for q in x)
            last: dict[int, int] = {}
            best = None
            for q, k in events:
                last[k] = q
                if len(last) == len(near):
                    begin = min(last.values())
                    if q - begin < span and (best is None or q - begin < best[1] - best[0]):
                        best = (begin, q)
            if best:
                out.add(best)
        return sorted(out)


def split_words(text: str | None) -> list[bytes]:
    return [w for w in _SPLIT.split((text or "").encode().translate(bytes(LOWER))) if w]


class TestSet:
    """A block of phrases as they are sent to the tasks: the distinct runs of ``width`` words
    (an item of fewer, but not none, is one run) by their length, as numbers of distinct terms,
    and the items of each."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        terms: dict[bytes, int] = {}
        self.names: list[str | None] = []
        by_size: dict[int, list] = {}
        for name, words in items:
            if words:
                numbers = np.array([terms.setdefault(w, len(terms)) for w in words], np.int32)
                runs = np.lib.stride_tricks.sliding_window_view(numbers, min(width, len(numbers)))
                by_size.setdefault(runs.shape[1], []).append((runs, len(self.names)))
                self.names.append(name)
        self.terms = pa.array(list(terms), pa.binary())
        self.groups = []
        for group in by_size.values():
            phrases, phrase = np.unique(np.concatenate([runs for runs, _ in group]), axis=0, return_inverse=True)
            item = np.repeat([k for _, k in group], [len(runs) for runs, _ in group])
            pairs = np.unique(phrase.ravel() * len(self.names) + item)
            phrase, item = pairs // len(self.names), pairs % len(self.names)
            self.groups.append((phrases, item, np.searchsorted(phrase, np.arange(len(phrases) + 1))))


def _blocks(items: DataFrame, text: str, item: str, width: int) -> Iterator[TestSet]:
    """The test set a block at a time; the driver never holds more."""
    block, size = [], 0
    for row in items.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        words = split_words(row.t)
        for k in range(0, max(1, len(words) - width + 1), BLOCK_WORDS):
            cut = words[k:k + BLOCK_WORDS + width - 1]
            block.append((row.i, cut))
            size += len(cut)
            if size >= BLOCK_WORDS:
                yield TestSet(block, width)
                block, size = [], 0
    if size:
        yield TestSet(block, width)


def find_phrases(index: DataFrame, items: DataFrame, width: int = 10, text: str = "text",
                 item: str = "item_id", span: int | None = None) -> DataFrame:
    """Documents with a match: ``segment``, ``doc_no``, ``items`` (sorted, distinct) and
    ``words`` (the sorted places, in the document, of all words inside a match).

    Phrases are the windows of ``width`` words of each item.  With ``span``, a match is a
    stretch of up to that many words that holds all the window's terms in any order.
    Items without words have no phrase; equal phrases of several items belong to each; a null
    item id marks words but is not listed.  No items, or no documents, give no rows."""
    sc = index.sparkSession.sparkContext
    schema = "segment long, doc_no int, items array<string>, words array<int>"
    found = None
    for block in _blocks(items, text, item, width):
        shared = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from _search(batch, k, shared.value, span)

        part = index.select("segment", "n_words", "terms", "first", "positions").mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    if found is None:
        return index.sparkSession.createDataFrame([], schema)
    merge = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)  # noqa: E731  one list from each pass
    return found.groupBy("segment", "doc_no").agg(merge("items"), merge("words"))


def _search(batch: pa.RecordBatch, k: int, tests: TestSet, span: int | None) -> Iterator[pa.RecordBatch]:
    segment = Segment(batch.column("n_words")[k].values.to_numpy(zero_copy_only=False),
                      batch.column("terms")[k].values, batch.column("first")[k].as_py(),
                      batch.column("positions")[k].as_py())
    numbers = segment.numbers(tests.terms.cast(segment.terms.type))
    who: dict[int, set] = {}
    begins, ends = [], []
    for phrases, items, first in tests.groups:
        inside = numbers[phrases]
        for i in np.flatnonzero((inside >= 0).all(axis=1)).tolist():
            if span is None:
                begin = segment.phrase(inside[i])
                end = begin + phrases.shape[1]
            else:
                begin, end = np.array(segment.proximity(inside[i], span), np.int64).reshape(-1, 2).T + [[0], [1]]
            if len(begin):
                begins.append(begin)
                ends.append(end)
                names = {tests.names[k] for k in items[first[i]:first[i + 1]].tolist()} - {None}
                for doc in np.unique(segment.document(begin)).tolist():
                    who.setdefault(doc, set()).update(names)
    if who:
        total = int(segment.first_word[-1])
        open_at = np.bincount(np.concatenate(begins), minlength=total + 1) - np.bincount(np.concatenate(ends), minlength=total + 1)
        hit = np.flatnonzero(np.cumsum(open_at) > 0)
        doc = segment.document(hit)
        docs = np.unique(doc)
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array(np.full(len(docs), batch.column("segment")[k].as_py()), pa.int64()),
            "doc_no": pa.array(docs, pa.int32()),
            "items": pa.array([sorted(who[d]) for d in docs.tolist()], pa.list_(pa.string())),
            "words": pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(doc, docs), len(doc)), pa.int32()),
                                              pa.array(hit - segment.first_word[doc], pa.int32()))})


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, text: str = "text",
                  id: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: the id, ``n_words``, ``n_hit`` (words inside an exact occurrence of a
    window of an item), ``items`` and ``contaminated``.  Every row of ``docs`` gives one row."""
    index = build_index(docs, text, id)
    found = find_phrases(index, items, width, item_text, item)
    return index_documents(index, id).join(found.hint("merge"), ["segment", "doc_no"], "left").select(
        id, "n_words", F.coalesce(F.size("words"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("words").isNotNull().alias("contaminated"))


def items_digest(items: str = "items"):
    """SHA-256 of the comma-joined item ids, in lowercase hex."""
    return F.sha2(F.concat_ws(",", items), 256)


NO_ITEMS_SHA256 = hashlib.sha256(b"").hexdigest()
