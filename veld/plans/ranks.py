"""Exact order statistics of the rows outside each held-out fold, all folds from the same scans.

The training rows of fold ``i`` are all rows less those of the fold, so counts by fold answer for every
fold at once.  Doubles are read as whole numbers of the same order.  A scan counts each open cell's
values by part and fold, and a running sum says which parts hold wanted ranks; a part of one value ends
the search for its ranks, the others are the cells of the next scan.  Where the open cells hold few
rows, the parts are the values themselves.  A task holds ``MAX_PARTS`` counts, the driver
``MAX_PARTS`` rows or ``BY_VALUE`` values, whatever the number of rows.  NaN and NULL are missing, both zeros one value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts of all open cells together.
MAX_PARTS = 1 << 15
#: Rows of the open cells that are counted by value.
BY_VALUE = 100_000
SIGN = np.int64(-2 ** 63)
FOUND = "column int, part int, digit long, lo long, hi long, counts array<long>"


def ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, -(bits ^ SIGN), bits)


def double_of(key: int) -> float:
    bits = np.int64(key) if key >= 0 else np.int64(-key) ^ SIGN
    return float(bits.view(np.float64))


@dataclass
class Cell:
    """Values from ``lo`` to ``hi``; ``before``: the rows below, by holdout; ``wanted``: (holdout's place, rank)."""
    lo: int
    hi: int
    before: np.ndarray
    n: int
    wanted: list = field(default_factory=list)

    def split(self, parts: int) -> list[tuple[int, int]]:
        step = -(-(self.hi - self.lo + 1) // parts)
        return [(a, min(a + step - 1, self.hi)) for a in range(self.lo, self.hi + 1, step)]


def _counted(df: DataFrame, columns: Sequence[str], fold: str, known: list, edges: list, by_value: bool) -> list:
    """One scan: ``(column, part, digit, lo, hi, counts by fold)`` of the parts with rows."""
    k = len(known) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [(np.full(len(s), np.iinfo(np.int64).max), np.full(len(s), np.iinfo(np.int64).min), np.zeros((len(s), k), np.int64)) for s, _ in edges]
        single: list = [[] for _ in edges]
        for batch in batches:
            of = batch.column(len(edges)).to_numpy(zero_copy_only=False)
            group = np.full(len(of), len(known))
            for i, f in enumerate(known):
                group[of == f] = i
            for j, (starts, ends) in enumerate(edges):
                x = batch.column(j).to_numpy(zero_copy_only=False).astype(float)
                there = ~np.isnan(x)
                if not len(starts) or not there.any():
                    continue
                key, at = np.unique(ordered(x[there]), return_inverse=True)
                counts = np.bincount(at * k + group[there], minlength=len(key) * k).reshape(-1, k)
                part = np.searchsorted(starts, key, "right") - 1
                on = (part >= 0) & (key <= ends[part])
                key, counts, part = key[on], counts[on], part[on]
                if by_value:
                    single[j].append((key, counts, part))
                elif len(key):
                    first = np.flatnonzero(np.diff(part, prepend=-1))
                    lo, hi, total = sums[j]
                    p = part[first]
                    lo[p], hi[p] = np.minimum(lo[p], key[first]), np.maximum(hi[p], key[np.append(first[1:], len(key)) - 1])
                    total[p] += np.add.reduceat(counts, first, axis=0)
        for j, (lo, hi, total) in enumerate(sums):
            if by_value:
                if not single[j]:
                    continue
                keys, counts, parts = (np.concatenate(a) for a in zip(*single[j]))
                lo, first, at = np.unique(keys, return_index=True, return_inverse=True)
                hi, part, digit, total = lo, parts[first], lo, np.zeros((len(lo), k), np.int64)
                np.add.at(total, at, counts)
            else:
                part = np.flatnonzero(total.any(axis=1))
                lo, hi, total, digit = lo[part], hi[part], total[part], np.zeros(len(part), np.int64)
            yield pa.RecordBatch.from_pydict({
                "column": pa.array(np.full(len(part), j), pa.int32()), "part": pa.array(part, pa.int32()), "digit": pa.array(digit, pa.int64()),
                "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()), "counts": pa.array(list(total), pa.list_(pa.int64()))})

    return df.select(*columns, fold).mapInArrow(run, FOUND).groupBy("column", "part", "digit").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array(*[F.sum(F.col("counts")[i]) for i in range(k)]).alias("counts")).collect()


def order_values(df: DataFrame, columns: Sequence[str], fold: str, holdouts: Sequence[int | None], probs: Sequence[float]) -> tuple[dict, dict]:
    """``{(column, holdout): n}`` and ``{(column, holdout, rank): value}`` for the ranks next to each probability.
    The rows of ``holdout`` are those of the other folds; None: all."""
    known, columns = sorted({h for h in holdouts if h is not None}), list(columns)
    counts: dict = {}
    values: dict = {}
    if not columns:
        return counts, values
    xs = [F.when(~F.isnan(c), F.col(c)) for c in columns]
    ends = df.groupBy(F.col(fold).alias("k")).agg(*[f(x).alias(f"{n}{j}") for j, x in enumerate(xs) for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).collect()
    cells: dict[int, list[Cell]] = {}
    for j, c in enumerate(columns):
        there = [r for r in ends if r[f"n{j}"]]
        for h in holdouts:
            counts[c, h] = sum(r[f"n{j}"] for r in there if h is None or r["k"] != h)
        if there:
            lo, hi = (int(ordered(np.array([f(r[f"{n}{j}"] for r in there)]))[0]) for n, f in (("lo", min), ("hi", max)))
            wanted = sorted({(i, min(int((counts[c, h] - 1) * p) + up, counts[c, h] - 1)) for i, h in enumerate(holdouts) if counts[c, h]
                             for p in probs for up in (0, 1)})
            cells[j] = [Cell(lo, hi, np.zeros(len(holdouts), np.int64), sum(r[f"n{j}"] for r in there), wanted)]
    while any(cells.values()):
        opened = [c for own in cells.values() for c in own]
        by_value = sum(c.n for c in opened) <= BY_VALUE
        split = {j: [c.split(1 if by_value else max(2, MAX_PARTS // len(opened))) for c in own] for j, own in cells.items()}
        edges = [tuple(np.array([e[s] for parts in split.get(j, []) for e in parts], np.int64) for s in (0, 1)) for j in range(len(columns))]
        owner = {j: np.repeat(np.arange(len(parts)), [len(p) for p in parts]) for j, parts in split.items()}
        found: dict = {}
        for r in sorted(_counted(df, columns, fold, known, edges, by_value), key=lambda r: (r["part"], r["digit"])):
            found.setdefault((r["column"], int(owner[r["column"]][r["part"]])), []).append(r)
        following: dict[int, list[Cell]] = {}
        for (j, number), rows in found.items():
            cell, by_fold = cells[j][number], np.array([r["counts"] for r in rows])
            total = by_fold.sum(axis=1)
            outside = np.stack([total - (by_fold[:, known.index(h)] if h is not None else 0) for h in holdouts], axis=1)
            upto = cell.before + np.cumsum(outside, axis=0)
            new: dict[int, Cell] = {}
            for i, rank in cell.wanted:
                at = int(np.searchsorted(upto[:, i], rank, "right"))
                r = rows[at]
                if r["lo"] == r["hi"]:
                    values[columns[j], holdouts[i], rank] = double_of(r["lo"])
                else:
                    new.setdefault(at, Cell(r["lo"], r["hi"], upto[at] - outside[at], int(total[at]))).wanted.append((i, rank))
            following.setdefault(j, []).extend(new[at] for at in sorted(new))
        cells = {j: sorted(own, key=lambda c: c.lo) for j, own in following.items()}
    return counts, values


def between(n: int, value_of, probs: Sequence[float]) -> list[float | None]:
    """The quantiles, linear between ranks; ``value_of`` a rank gives its value."""
    out: list[float | None] = []
    for p in probs:
        h = (n - 1) * p
        lo = int(h)
        if n:
            below, above = value_of(lo), value_of(min(lo + 1, n - 1))
        out.append(None if not n else below * (1.0 - (h - lo)) + above * (h - lo) if h > lo else below)
    return out
