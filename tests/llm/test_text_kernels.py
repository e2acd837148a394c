"""Byte kernels against plain Python: words, pre-tokens, hashes, BPE."""

import random
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
import xxhash
from tokenizers import Tokenizer

from veld.llm import bpe, orc_tokens, simhash
from veld.llm.pretokens import pretokens
from veld.llm.textbytes import ALNUM, LOWER, NOT_SPACE, Words, buffers, encode, hash_strings, pieces
from veld.llm.xxh64 import xxh64

PARTS = ["a", "S", "t", "'", "ll", "re", "ve", "'s", "'t", "'m", "'d", "'ll", " ", "  ", "\n", "\t", "é", "ß", "1", "٣", "!",
         "…", "\u00a0", "漢", "😀", "\u0085", "\x1c", "ing", "the ", "''"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", None, "'", " ", "x" * 5000]


def test_words_match_regex():
    col = pa.array(texts(2000))
    offsets, data = buffers(col)
    low = {i: i + 32 for i in range(65, 91)}
    for kinds, pattern in ((NOT_SPACE, "[^\x20\x09-\x0D]+"), (ALNUM, "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words(offsets, LOWER[data], kinds)
        got = words.strings().to_pylist()
        for i, t in enumerate(col.to_pylist()):
            want = [w.encode() for w in re.findall(pattern, (t or "").translate(low))]
            assert got[words.first[i]:words.first[i + 1]] == want


def test_pretokens_match_the_pattern():
    col = texts(5000)
    strings, first = pretokens(pa.array(col))
    got, pattern = strings.to_pylist(), regex.compile(P.PATTERN)
    for i, t in enumerate(col):
        assert got[first[i]:first[i + 1]] == [w.encode() for w in pattern.findall(t or "")]


def test_xxh64_and_string_hash():
    rng = random.Random(0)
    data = np.frombuffer(rng.randbytes(9000), np.uint8)
    start = np.array([rng.randint(0, 8000) for _ in range(1500)])
    end = start + np.array([rng.randint(0, 150) for _ in range(1500)])
    got = xxh64(data, start, end, 42)
    assert all(int(h) == xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for h, a, b in zip(got, start, end))
    words = pa.array([b"", b"a", b"a\0", b"abcdefgh", b"abcdefghi", b"a"], pa.large_binary())
    h = hash_strings(words)
    assert h[1] == h[5] and len(set(h.tolist())) == 5


def test_pieces_bound_memory_and_keep_rows():
    batch = pa.record_batch({"text": pa.array(["x" * n for n in (5, 50, 1, 1, 1, 0, 200)])})
    cut = list(pieces(iter([batch]), "text", 10))
    assert sum(p.num_rows for p in cut) == 7 and [p.num_rows for p in cut][:2] == [1, 1]
    assert not list(pieces(iter([batch.slice(0, 0)]), "text"))


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))


def test_perfect_hash_is_minimal(ranks):
    strings = pa.array(list(ranks)[:5000], pa.large_binary())
    perfect = bpe.PerfectHash(strings)
    assert sorted(perfect.slot_of.tolist()) == list(range(5000))
    assert (perfect.lookup(strings) == perfect.slot_of).all()


def test_bpe_equals_tiktoken_and_round_trips(ranks):
    coder = bpe.TwoTier(ranks)
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    col = texts(1500, 3) + ["ab" * 3000]
    ids, first = coder.encode_column(pa.array(col))
    data, at = coder.decode(ids, first)
    for i, t in enumerate(col):
        assert ids[first[i]:first[i + 1]].tolist() == plain.encode_ordinary(t or "")
        assert data[at[i]:at[i + 1]].tobytes() == (t or "").encode()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_library_encoder_equals_whole_texts(name):
    coder, plain = orc_tokens.LibraryEncoder(P.path(name)), Tokenizer.from_file(P.path(name))
    coder.REMEMBERED = 200
    for seed in range(4):
        col = texts(150, seed) + (["a<|endoftext|>b"] if seed == 3 else [])
        ids, first = coder.encode_column(pa.array(col))
        for i, t in enumerate(col):
            assert ids[first[i]:first[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_golay_keys_meet_at_one_error():
    own, near, first = simhash.segment_keys()
    rng = np.random.default_rng(1)
    for x in rng.integers(0, 1 << 16, 300):
        for b in range(16):
            assert own[x ^ (1 << b)] in near[first[x]:first[x + 1]]
    index, distinct = encode(pa.array([b"a", b"b", b"a"], pa.large_binary()))
    assert index.tolist() == [0, 1, 0] and len(distinct) == 2
