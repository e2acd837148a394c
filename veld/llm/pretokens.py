"""The pre-tokens of byte-level BPE, found for a whole piece of texts at once.

The public pattern is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every alternative but the contractions is a run of one character class (letter, number,
white space, other), so cuts lie at the ends of runs, with three exceptions: a space before
a run joins it; the white space before that space (or before a last character that is no
space) is a token of its own; a lone apostrophe not joined to a space takes a following
contraction.  ``tests/llm`` compares the cuts with the pattern itself.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from .textbytes import buffers, byte_strings

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000 + 1, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[np.fromiter(map(ord, regex.findall(pattern, points)), np.int64)] = kind
    return out


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position and code point of each character."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.int32)
    wide = np.flatnonzero(point >= 0x80)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        p, b0 = lead[wide], point[wide]
        b1, b2, b3 = (padded[p + k].astype(np.int32) & 0x3F for k in (1, 2, 3))
        value = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | b1,
                         np.where(b0 < 0xF0, (b0 & 0x0F) << 12 | b1 << 6 | b2,
                                  (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
        point[wide] = np.minimum(value, 0x110000)
    return lead, point


def cuts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Byte positions at which pre-tokens begin, ascending."""
    if not len(data):
        return np.zeros(0, np.int64)
    lead, point = _points(data)
    n = len(lead)
    kind = _classes()[point]
    row_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    row_first = np.zeros(n + 1, bool)
    row_first[np.searchsorted(lead, row_starts)] = True
    row_first[n] = True

    begins = row_first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(begins[:n])
    ends = np.append(runs[1:], n)
    token = np.zeros(n + 1, bool)
    token[runs] = True

    # white space with a run of the same text behind it
    blank = np.flatnonzero((kind[runs] == SPACE) & ~row_first[ends])
    end = ends[blank]
    joined = point[end - 1] == 0x20
    token[end - 1] = True            # the last character: joins the next run, or stands alone
    token[end[joined]] = False

    # a lone apostrophe at the start of a token, then letters of the same text
    lone = runs[(point[runs] == 0x27) & (ends - runs == 1)]
    lone = lone[(lone + 1 < n) & token[lone]]
    lone = lone[~row_first[lone + 1] & (kind[np.minimum(lone + 1, n - 1)] == LETTER)]
    if len(lone):
        a = point[lone + 1]
        has_two = lone + 2 < n
        b = np.where(has_two & ~row_first[np.minimum(lone + 2, n)], point[np.minimum(lone + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | \
              ((a == ord("l")) & (b == ord("l")))
        token[lone[one | two] + 1] = False
        token[lone[one] + 2] = True
        token[lone[two] + 3] = True
    return lead[np.flatnonzero(token[:n])]


def pretokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of a text column in order, and the index of each row's first one
    (one more entry than rows)."""
    offsets, data = buffers(column)
    at = cuts(offsets, data)
    strings = byte_strings(np.append(at, len(data)), data)
    return strings, np.searchsorted(at, offsets)
