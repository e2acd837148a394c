"""Alignment of two tokenizations against a pointer walk over each text."""

import collections
import hashlib

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from veld.llm import token_alignment as T

ROWS = [(1, None), (2, ""), (3, " "), (4, "  two  spaces \n\t x"), (5, "<s> <|endoftext|> </s> <0x0A> <unk>"), (6, "a▁b"),
        (7, "é́ ﬁ 日本語 🙂🙂"), (None, "no id"), (8, "x" * 9000), (8, "x" * 9000), (9, "ab cd " * 9000), (10, " 　 end \x00 \r\n"),
        (11, "1234567 89.0"), (12, "the cat the dog. The end"), (12, "the cat the dog. The end"), (13, "▁ "), (14, "trailing  ")]


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner(T.ByteLevelEncoder(P.path("byte_bpe_50k.json")), T.PieceEncoder(P.path("piece_bpe_32k.model")))


def walk(rows, aligner):
    a_model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a_bytes, b_bytes = aligner.a.token_bytes(), aligner.b.token_bytes()
    counts, found = collections.Counter(), []
    for i, t in rows:
        a = a_model.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_model.encode(t) if t else []
        whole = (" " + (t or "")).encode()
        links, groups = [], []
        if t and b"".join(a_bytes[x] for x in a) == whole == b"".join(b_bytes[x] for x in b):
            j = k = at_a = at_b = 0
            group = ([], [])
            while j < len(a):
                links.append((a[j], b[k]))
                end_a, end_b = at_a + len(a_bytes[a[j]]), at_b + len(b_bytes[b[k]])
                if end_a <= end_b:
                    group[0].append(a[j])
                    j, at_a = j + 1, end_a
                if end_b <= end_a:
                    group[1].append(b[k])
                    k, at_b = k + 1, end_b
                if end_a == end_b:
                    groups.append(group)
                    group = ([], [])
        else:
            a = b = []
        counts.update(links)
        found.append((i, a, b, groups, links))
    top = collections.Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for i, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece, group, lane, chunk", [(6 << 20, 64 << 20, 2048, 8192), (200, 300, 16, 8)])
def test_alignment(spark, aligner, monkeypatch, piece, group, lane, chunk):
    """Small pieces, groups, lanes and chunks give what large ones give."""
    for name, value in (("PIECE_BYTES", piece), ("GROUP_BYTES", group), ("LANE", lane), ("CHUNK", chunk)):
        monkeypatch.setattr(T, name, value)
    docs = spark.createDataFrame([(i, t, "x", "y", 3) for i, t in ROWS], "doc_id long, text string, id string, group string, number int")
    got = sorted(map(tuple, T.align_documents(docs.repartition(3), aligner).collect()), key=repr)
    assert got == walk(ROWS, aligner)
    assert T.align_documents(docs.limit(0), aligner).collect() == []


def test_long_documents_enter_as_lanes(aligner, monkeypatch):
    """No lane is much longer than LANE, and the links are those of the document in one lane."""
    import numpy as np
    import pyarrow as pa
    texts = pa.array(["some words and " * 500, "short", None])
    whole = aligner.align(texts)
    monkeypatch.setattr(T, "LANE", 50)
    cut = aligner.align(texts)
    assert {k: list(v) for k, v in whole[0].items()} == {k: list(v) for k, v in cut[0].items()}
    pairs = lambda r: np.sort(r[1] << 50 | r[2] << 25 | r[3]).tolist()
    assert pairs(whole) == pairs(cut)


def test_packed_numbers():
    import numpy as np
    for values in ([], [0], [5, 2**32 - 1, 7]):
        assert T._unpack(T._pack(np.array(values, np.int64))).tolist() == values
