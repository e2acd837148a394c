"""Language-model scoring by a hashed maximum-entropy model.

    P(token | history) = P(class | history) * P(token | class)

The first factor is a log-linear model over ``CLASSES`` classes.  Its features are the word
before, the two words before, the word before last (a skip feature) and the classes of the
three words before; each is hashed to one of ``BUCKETS`` rows of weights, and a bias holds
the classes' shares.  The second factor is a softmax over a class's words whose one feature
is the word, so its weights are known from counts (plus a half): unigram counts, without the
history.  The words of a class that were seen once set the share of unseen words in it, and
an unseen word gets that share over the number of unseen words, estimated from the words seen
once and twice (Chao's estimate, and no fewer than were seen once, so that an unseen word is
always less likely than one seen once).  Classes are the text's end, the
``HEAD - 1`` most frequent words, and ``TAIL`` groups of the others by their last two bytes,
so an unseen word has a class too.

Training: a hash of id and text puts each training document in one of ``ROUNDS`` rounds.  In a
round all tasks hold the same weights and add up the two halves of the gradient (tokens found and
tokens expected, by row and class); Spark sums them, and one step is taken from the sums, scaled
by the halves themselves.  So the weights, but for rounding, depend on the documents alone and
not on the number of tasks, cores or partitions, nor on a task that is run again.

Scoring needs the count of each token of each document.  Documents are packed into blocks of
``BLOCK_BYTES`` of text, tokens are numbered inside a block, and only a block's distinct words
are counted, joined with the corpus counts and handed back; the block is then scored with
numpy at once.  A word that is in every document is one row per block in those joins.

The weights (``BUCKETS`` x ``CLASSES`` floats) are the only thing sent to the driver and to
the tasks; their size is fixed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import shared_path
from .textbytes import LOWER, NOT_SPACE, PIECE_BYTES, Words, buffers, hash_strings, mix64, pieces

HEAD = TAIL = 32
CLASSES = HEAD + TAIL
BUCKETS = 1 << 15
FEATURES = 4
ROUNDS = 4
BATCH = 32768
#: The first step's rate; the last has half of it, so that the four features of a history that
#: always come together do not overshoot.
RATE = 1.0
#: Tokens of the classes' shares that both halves of a row's gradient are smoothed by.
SMOOTH = 64
BLOCK_BYTES = 16 << 20
#: Tokens of the documents that are scored together.
RUN_TOKENS = 1 << 18
#: Input partitions that one training task goes through, so that few sets of weights are summed.
PARTITIONS_PER_TASK = 8

_SUFFIX_CLASS = np.array([HEAD + zlib.crc32(bytes([k >> 8, k & 255]).lstrip(b"\0")) % TAIL for k in range(1 << 16)])


def held_out(id: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """Whether crc32 of the id's text leaves ``fold``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % folds == fold


class Stream:
    """The tokens of some rows, each row's end included.  Words are looked for in ``part`` bytes at a
    time, so that a block's memory is that of its word numbers."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, part: int = PIECE_BYTES):
        coded, counts, at = [], [], 0
        while at < len(offsets) - 1:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + part, "right")) - 1)
            words = Words(offsets[at:end + 1] - offsets[at], LOWER[data[offsets[at]:offsets[end]]], NOT_SPACE)
            coded.append(pc.dictionary_encode(words.strings()))
            counts.append(words.counts)
            del words
            at = end
        if len(coded) > 1:          # the distinct words of all parts, in the order they first come
            coded = pa.chunked_array(coded).unify_dictionaries().chunks
        self.index = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in coded] or [np.zeros(0, np.int32)])
        self.vocabulary = coded[0].dictionary if coded else pa.array([], pa.large_binary())
        self.counts = np.concatenate(counts or [np.zeros(0, np.int64)])


def word_classes(vocabulary: pa.Array, head: pa.Array) -> np.ndarray:
    offsets, data = buffers(vocabulary)
    length = np.diff(offsets)
    last = data[offsets[1:] - 1].astype(np.int64)
    before = np.where(length > 1, data[np.maximum(offsets[1:] - 2, 0)], 0).astype(np.int64)
    out = _SUFFIX_CLASS[before << 8 | last]
    at = pc.fill_null(pc.index_in(vocabulary, value_set=head.cast(vocabulary.type)), -1).to_numpy(zero_copy_only=False)
    return np.where(at >= 0, 1 + at, out)


def features(index: np.ndarray, counts: np.ndarray, of_class: np.ndarray, hashes: np.ndarray):
    """Class and feature rows (``FEATURES`` x tokens) of every token, ends included."""
    n = counts + 1
    first = np.append(0, np.cumsum(n))
    total = int(first[-1])
    word = np.ones(total, bool)
    word[first[1:] - 1] = False
    klass = np.zeros(total, np.int64)
    klass[word] = of_class[index]
    h = np.zeros(total, np.uint64)
    h[word] = hashes[index]
    place = np.arange(total) - np.repeat(first[:-1], n)

    def back(x, k):
        y = np.zeros_like(x)
        y[k:] = x[:total - k] if k <= total else 0
        y[place < k] = 0
        return y

    w1, w2 = back(h, 1), back(h, 2)
    c = (klass + 1).astype(np.uint64)
    rows = np.empty((FEATURES, total), np.uint16)
    with np.errstate(over="ignore"):      # one feature at a time: a block has millions of tokens
        for row, seeds in zip(rows, (
                lambda: w1 + np.uint64(1), lambda: w1 * np.uint64(3) + w2 * np.uint64(5) + np.uint64(2), lambda: w2 + np.uint64(3),
                lambda: (np.uint64(1) << np.uint64(40)) + back(c, 1) + back(c, 2) * np.uint64(256) + back(c, 3) * np.uint64(65536))):
            row[:] = mix64(seeds()) % np.uint64(BUCKETS)
    return klass, rows, first


def _logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = np.take(weights, rows[0], axis=0)
    for r in rows[1:]:
        z += np.take(weights, r, axis=0)
    z += bias
    return np.minimum(z, 80, out=z)


_ONES = np.ones(CLASSES, np.float32)


def gradient_sums(weights: np.ndarray, bias: np.ndarray, klass: np.ndarray, rows: np.ndarray,
                  found: np.ndarray, expected: np.ndarray) -> None:
    """Adds, for every row of weights, its tokens by class to ``found`` and the probabilities that the
    model gives them to ``expected``, in place.  Their difference is the gradient."""
    for s in range(0, len(klass), BATCH):
        x, y = rows[:, s:s + BATCH], klass[s:s + BATCH]
        p = _logits(weights, bias, x)
        np.exp(p, out=p)
        p *= (1 / (p @ _ONES))[:, None]
        for row in x:
            np.add.at(found, row.astype(np.int64) * CLASSES + y, 1)
        flat = np.ascontiguousarray(x).ravel()
        order = np.argsort(flat, kind="stable")
        sorted_rows = flat[order]
        start = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
        size = np.diff(np.append(start, len(flat)))
        order %= len(y)                 # the token of each place
        total = np.take(p, order[start], axis=0)
        for k in range(1, 8):
            more = np.flatnonzero(size > k)
            total[more] += np.take(p, order[start[more] + k], axis=0)
        for k in np.flatnonzero(size > 8):
            total[k] += np.take(p, order[start[k] + 8:start[k] + size[k]], axis=0).sum(axis=0)
        expected[sorted_rows[start]] += total


def gradient_step(weights: np.ndarray, share: np.ndarray, found: np.ndarray, expected: np.ndarray, rate: float) -> np.ndarray:
    """The weights after one step along the gradient, each scaled by its own two halves and by
    ``SMOOTH`` tokens of the classes' shares, so no weight moves by more than ``rate``."""
    return (weights + rate * (found - expected) / (found + expected + 2 * SMOOTH * share)).astype(np.float32)


class Model:
    """Weights and bias of the classes, the head words, and what the counts say.

    ``unseen`` is the mass of all unseen words of each class, ``unseen_words`` their number."""

    def __init__(self, head: list[bytes], class_mass: np.ndarray, unseen: np.ndarray, tokens: int,
                 distinct: int, ends: int, unseen_words: np.ndarray | None = None):
        self.head = pa.array(head, pa.binary())
        self.mass = class_mass + unseen
        self.unseen_words = np.maximum(unseen, 1) if unseen_words is None else unseen_words
        self.unseen, self.tokens, self.distinct, self.ends = unseen, tokens, distinct, ends
        self.bias = np.log(self.mass / self.mass.sum()).astype(np.float32)
        self.weights = np.zeros((BUCKETS, CLASSES), np.float32)

    def word_log10(self, c: np.ndarray, of_class: np.ndarray) -> np.ndarray:
        """The words' share in their classes; ``c`` is 0 for unseen words."""
        one_unseen = (self.unseen / self.unseen_words)[of_class]
        return np.log10(np.where(c > 0, c + 0.5, one_unseen)) - np.log10(self.mass)[of_class]

    def class_log10(self, klass: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(klass))
        for s in range(0, len(klass), BATCH):
            z = _logits(self.weights, self.bias, rows[:, s:s + BATCH])
            own = z[np.arange(len(z)), klass[s:s + BATCH]].astype(np.float64)
            np.exp(z, out=z)
            out[s:s + BATCH] = own - np.log((z @ _ONES).astype(np.float64))
        return out / np.log(10)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: a block's distinct words (``n`` is the word's number, ``count`` how often
    it is in the block's training documents); of kind 1: its documents (tokens as numbers)."""
    block = TaskContext.get().partitionId() << 32
    for piece in pieces(batches, "text", BLOCK_BYTES):
        stream = Stream(*buffers(piece.column("text")))
        held = piece.column("held_out").to_numpy(zero_copy_only=False)
        training = np.repeat(~held, stream.counts)
        n_words = len(stream.vocabulary)
        count = np.bincount(stream.index[training], minlength=n_words)
        nothing = pa.nulls(n_words, pa.binary())
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(np.zeros(n_words, np.int32)), "block": pa.array(np.full(n_words, block)),
            "n": pa.array(np.arange(n_words, dtype=np.int32)), "word": stream.vocabulary.cast(pa.binary()),
            "count": pa.array(count, pa.int64()), "id": pa.nulls(n_words, piece.column("id").type),
            "held_out": pa.nulls(n_words, pa.bool_()), "tokens": nothing})
        rows = piece.num_rows
        at = np.append(0, np.cumsum(stream.counts)) * 4
        numbers = stream.index.astype("<u4").view(np.uint8)
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(np.ones(rows, np.int32)), "block": pa.array(np.full(rows, block)),
            "n": pa.array(np.arange(rows, dtype=np.int32)), "word": pa.nulls(rows, pa.binary()),
            "count": pa.array(stream.counts, pa.int64()), "id": piece.column("id"),
            "held_out": piece.column("held_out"),
            "tokens": pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(at), pa.py_buffer(numbers)]).cast(pa.binary())})
        block += 1
        del stream, training, count, nothing, at, numbers
        pa.default_memory_pool().release_unused()       # a worker waits for its next task with this memory


def _counts(words: DataFrame) -> DataFrame:
    """The count of every training word."""
    path = shared_path(words.sparkSession, "word-counts")
    words.groupBy("word").agg(F.sum("count").alias("c")).filter("c > 0").write.parquet(path)
    return words.sparkSession.read.parquet(path)


def _summary(counts: DataFrame, ends: int) -> Model:
    """Totals, head words and class shares: a few rows whatever the corpus."""
    top = counts.orderBy(F.desc("c"), "word").limit(HEAD - 1).collect()
    head = [bytes(r.word) for r in top]
    suffix = F.expr("substring(word, -2, 2)")
    tail_class = HEAD + F.pmod(F.crc32(suffix), F.lit(TAIL)).cast("int")
    rows = counts.groupBy(tail_class.alias("k")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice"))
    mass, once, twice = np.zeros(CLASSES), np.zeros(CLASSES), np.zeros(CLASSES)
    tokens, distinct = ends, int(ends > 0)
    for r in rows.collect():
        mass[r.k] = r.c + 0.5 * r.v
        once[r.k], twice[r.k] = r.once, r.twice
        tokens, distinct = tokens + r.c, distinct + r.v
    for k, r in enumerate(top):
        own = HEAD + zlib.crc32(bytes(r.word)[-2:]) % TAIL
        mass[1 + k] = r.c + 0.5
        mass[own] -= r.c + 0.5
        once[own] -= r.c == 1
        twice[own] -= r.c == 2
    mass[0] = ends + 0.5
    mass = np.maximum(mass, 1e-6)       # classes without words
    unseen = np.where(np.arange(CLASSES) < HEAD, 0, np.maximum(0.5, once))
    unseen_words = np.maximum(np.maximum(once, 1), once * (once - 1) / (2 * (twice + 1)))
    return Model(head, mass, unseen, tokens, distinct, ends, unseen_words)


def _round(docs: DataFrame, model: Model, rate: float) -> np.ndarray:
    """The weights after one step along the gradient of all ``docs`` (column text), which tasks add
    up at the same weights: how the rows are divided among tasks makes no difference."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        found, expected = np.zeros(BUCKETS * CLASSES, np.int32), np.zeros((BUCKETS, CLASSES))
        for piece in pieces(batches, "text"):
            stream = Stream(*buffers(piece.column("text")))
            klass, rows, _ = features(stream.index, stream.counts, word_classes(stream.vocabulary, m.head),
                                      hash_strings(stream.vocabulary))
            gradient_sums(m.weights, m.bias, klass, rows, found, expected)
        found = found.reshape(BUCKETS, CLASSES)
        hit = np.flatnonzero(found.any(axis=1))
        yield pa.RecordBatch.from_pydict({"row": pa.array(hit, pa.int32())} | {f"f{k}": pa.array(found[hit, k]) for k in range(CLASSES)}
                                         | {f"e{k}": pa.array(expected[hit, k].astype(np.float32)) for k in range(CLASSES)})

    halves = [[f"{half}{k}" for k in range(CLASSES)] for half in "fe"]
    schema = "row int, " + ", ".join([f"{c} int" for c in halves[0]] + [f"{c} float" for c in halves[1]])
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.rdd.getNumPartitions() // PARTITIONS_PER_TASK))
    summed = docs.select("text").coalesce(tasks).mapInArrow(run, schema).groupBy("row").agg(
        *[F.sum(c).cast("double").alias(c) for half in halves for c in half]).toArrow()
    weights = model.weights.copy()
    if summed.num_rows:
        row = summed.column("row").to_numpy()
        found, expected = (np.stack([summed.column(c).to_numpy() for c in half], axis=1) for half in halves)
        weights[row] = gradient_step(weights[row], model.mass / model.mass.sum(), found, expected, rate)
    return weights


def _score(model):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        m = model.value
        docs = docs.sort_by("n")
        words = words.sort_by("n")
        vocabulary = words.column("word").combine_chunks()
        if isinstance(vocabulary, pa.ChunkedArray):
            vocabulary = pa.concat_arrays(vocabulary.chunks) if vocabulary.num_chunks else pa.array([], pa.binary())
        c = words.column("c").to_numpy().astype(np.float64)
        counts = docs.column("count").to_numpy()
        index = np.frombuffer(b"".join(docs.column("tokens").to_pylist()), "<u4")
        of_class, hashes = word_classes(vocabulary, m.head), hash_strings(vocabulary)
        one_base = np.log10(c + 0.5)
        with np.errstate(divide="ignore"):
            one_inside = m.word_log10(c, of_class)
        end_base = np.log10(m.ends + 0.5)
        base, score, n_known = np.zeros(len(counts)), np.zeros(len(counts)), np.zeros(len(counts), np.int64)
        to = np.cumsum(counts)
        # a run of documents at a time, so that memory per token is that of a run
        starts = np.flatnonzero(np.diff((to + np.arange(len(to))) // RUN_TOKENS, prepend=-1))
        for i, j in zip(starts, np.append(starts[1:], len(counts))):
            words_of = index[to[i] - counts[i]:to[j - 1]].astype(np.int64)
            klass, rows, first = features(words_of, counts[i:j], of_class, hashes)
            word = np.ones(len(klass), bool)
            word[first[1:] - 1] = False
            value = np.full(len(klass), end_base)
            value[word] = one_base[words_of]
            base[i:j] = np.add.reduceat(value, first[:-1])
            known = np.full(len(klass), m.ends > 0)
            known[word] = (c > 0)[words_of]
            n_known[i:j] = np.add.reduceat(known.astype(np.int64), first[:-1])
            value[:] = end_base - np.log10(m.mass[0])
            value[word] = one_inside[words_of]
            value += m.class_log10(klass, rows)
            score[i:j] = np.add.reduceat(value, first[:-1])
        n = counts + 1
        return pa.table({"id": docs.column("id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(n, pa.int64()),
                         "n_known": pa.array(n_known),
                         "train_tokens": pa.array(np.full(len(n), m.tokens), pa.int64()),
                         "base_score": pa.array(base - n * np.log10(m.tokens + 0.5 * (m.distinct + 1))),
                         "score": pa.array(score)})
    return run


def score_documents(docs: DataFrame, text: str = "text", id: str = "doc_id",
                    holdout: Column | None = None) -> DataFrame:
    """Train on the rows outside ``holdout`` and score all rows.

    Per row: the id, ``held_out``, ``n_tokens`` (words and the end), ``n_known`` (tokens seen in
    training), ``train_tokens``, ``base_score`` (log10 probability by counts alone, plus a
    half) and ``score`` (by the model).  Null and empty texts are an end only.  Without
    training rows every token is unknown.  Null and repeated ids are kept; other columns are
    ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (held_out(id) if holdout is None else holdout).alias("held_out"))
    kind = docs.schema[id].dataType.simpleString()
    path = shared_path(spark, "token-blocks")
    (rows.select("id", "text", "held_out")
        .mapInArrow(_pack, f"kind int, block long, n int, word binary, count long, id {kind}, held_out boolean, tokens binary")
        .write.partitionBy("kind").option("compression", "zstd").parquet(path))
    schema = f"block long, n int, word binary, count long, id {kind}, held_out boolean, tokens binary, kind int"
    words = spark.read.schema(schema).parquet(path).filter("kind = 0").select("block", "n", "word", "count")
    blocks = spark.read.schema(schema).parquet(path).filter("kind = 1").select("block", "n", "id", "held_out", "count", "tokens")
    counts = _counts(words)
    ends = blocks.filter("not held_out").count()
    model = _summary(counts, ends)
    for r in range(ROUNDS):
        share = rows.filter(~F.col("held_out") & (F.pmod(F.xxhash64("id", "text"), F.lit(ROUNDS)) == r)).select("text")
        model.weights = _round(share, model, RATE / (1 + r / (ROUNDS - 1)))
    shared = spark.sparkContext.broadcast(model)
    counted = words.join(counts, "word", "left").select("block", "n", "word", F.coalesce("c", F.lit(0)).alias("c"))
    out = (f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")
    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_score(shared), out) \
        .withColumnRenamed("id", id)
