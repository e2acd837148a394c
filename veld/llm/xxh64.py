"""XXH64 of many byte ranges of one buffer at once (the public algorithm, in numpy)."""

from __future__ import annotations

import numpy as np

# The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc, lane):
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """The unsigned 64-bit hash of ``data[starts[i]:ends[i]]`` for every i."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes8 = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lanes4 = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    at, length = starts.astype(np.int64), (ends - starts).astype(np.int64)
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        h = np.full(len(at), s + _P5, np.uint64)
        long = np.flatnonzero(length >= 32)
        if len(long):
            acc = [np.full(len(long), v, np.uint64) for v in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            left, p = length[long].copy(), at[long].copy()
            go = np.arange(len(long))
            while len(go):
                for k in range(4):
                    acc[k][go] = _round(acc[k][go], lanes8[p[go] + 8 * k])
                p[go] += 32
                left[go] -= 32
                go = go[left[go] >= 32]
            v = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                v = (v ^ _round(np.uint64(0), a)) * _P1 + _P4
            h[long] = v
            at[long] = p
        h += length.astype(np.uint64)
        left = ends - at
        for _ in range(3):
            go = np.flatnonzero(left >= 8)
            if not len(go):
                break
            h[go] = _rotl(h[go] ^ _round(np.uint64(0), lanes8[at[go]]), 27) * _P1 + _P4
            at[go] += 8
            left[go] -= 8
        go = np.flatnonzero(left >= 4)
        h[go] = _rotl(h[go] ^ (lanes4[at[go]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[go] += 4
        left[go] -= 4
        for _ in range(3):
            go = np.flatnonzero(left > 0)
            if not len(go):
                break
            h[go] = _rotl(h[go] ^ (padded[at[go]].astype(np.uint64) * _P5), 11) * _P1
            at[go] += 1
            left[go] -= 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))
