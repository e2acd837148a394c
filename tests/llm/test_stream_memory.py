"""The words of a block in parts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from veld.llm import maxent
from veld.llm.textbytes import buffers


@pytest.mark.parametrize("part", [1, 7, 40, 1 << 20])
def test_parts_give_the_words_of_the_whole(part):
    texts = ["One two  one", None, "", "three é\ttwo " * 9, "end", " "]
    stream = maxent.Stream(*buffers(pa.array(texts)), part=part)
    words = [(t or "").lower().split() for t in texts]
    assert [stream.vocabulary[int(i)].as_py().decode() for i in stream.index] == sum(words, [])
    assert stream.counts.tolist() == list(map(len, words))
    assert [v.decode() for v in stream.vocabulary.to_pylist()] == list(dict.fromkeys(sum(words, [])))


def test_no_rows():
    stream = maxent.Stream(*buffers(pa.array([], pa.string())))
    assert len(stream.index) == len(stream.vocabulary) == len(stream.counts) == 0


def test_memory_of_a_block():
    """Beyond its text, a block takes its word numbers and the work of a part."""
    rng = np.random.default_rng(1)
    words = np.array([f"w{k:05d}" for k in range(5000)])
    offsets, data = buffers(pa.array([" ".join(words[rng.integers(0, 5000, 3000)]) for _ in range(1200)]))
    tracemalloc.start()
    try:
        stream = maxent.Stream(offsets, data)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(stream.index) == 1200 * 3000 and peak < 4 * len(data)
