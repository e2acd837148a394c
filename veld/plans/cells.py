"""Binned rows as cells of the grid of their bins.

Rows with the same bins go the same way through every tree, so a tree needs of them only sums.
Where the grid of all bins is small (``MAX_GRID``, whatever the number of rows), a fit adds the rows up
by cell in one scan and grows its trees on the cells; a larger grid is left to the scans by level.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Cells of the largest grid: three features of 64 bins.
MAX_GRID = 1 << 18
#: Rows of a run are at least these, and as many as the grid has cells.
RUN_ROWS = 1 << 16


def grid_of(cuts: Sequence[np.ndarray]) -> tuple | None:
    """The number of bins of each feature, or None where their grid is too large."""
    sizes = tuple(len(c) + 1 for c in cuts)
    return sizes if math.prod(sizes) <= MAX_GRID else None


def cell_of(bins: np.ndarray, sizes: tuple) -> np.ndarray:
    return np.ravel_multi_index(tuple(bins.T), sizes)


def bins_of(sizes: tuple, cells: np.ndarray | None = None) -> np.ndarray:
    """The bins of these cells, or of all."""
    return np.stack(np.unravel_index(np.arange(math.prod(sizes)) if cells is None else cells, sizes), axis=1)


def distinct(bins: np.ndarray, sizes: tuple | None) -> tuple[np.ndarray, np.ndarray | slice]:
    """Rows of bins without repeats, and each row's place among them."""
    if sizes is None or not len(bins):
        return bins, slice(None)
    cells, back = np.unique(cell_of(bins, sizes), return_inverse=True)
    return bins_of(sizes, cells), back


def lookup(sizes: tuple | None, values_of: Callable) -> Callable:
    """``values_of`` rows of bins, for each cell of a small grid only once."""
    if sizes is None:
        return values_of
    known, values = np.zeros(math.prod(sizes), bool), np.zeros(math.prod(sizes))

    def look(bins: np.ndarray) -> np.ndarray:
        cell = cell_of(bins, sizes)
        new = np.unique(cell[~known[cell]])
        if len(new):
            values[new], known[new] = values_of(bins_of(sizes, new)), True
        return values[cell]

    return look


def runs(batches: Iterator[pa.RecordBatch], sizes: tuple, bins: Callable) -> Iterator[tuple]:
    """``(cell, y, fold, key)`` of many rows at a time, so that sums by cell cost little next to them."""
    least, parts, n = max(RUN_ROWS, math.prod(sizes)), [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append((cell_of(bins(batch, "bins"), sizes), *(batch.column(c).to_numpy() for c in ("y", "fold", "key"))))
            n += batch.num_rows
        if n >= least:
            yield tuple(map(np.concatenate, zip(*parts)))
            parts, n = [], 0
    if parts:
        yield tuple(map(np.concatenate, zip(*parts)))


def columns_of(batches: Iterator[pa.RecordBatch], names: Sequence[str], least: int = 1 << 18) -> Iterator[tuple]:
    """These columns, ``least`` rows or more at a time."""
    parts, n = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(tuple(batch.column(c).to_numpy() for c in names))
            n += batch.num_rows
        if n >= least:
            yield tuple(map(np.concatenate, zip(*parts)))
            parts, n = [], 0
    if parts:
        yield tuple(map(np.concatenate, zip(*parts)))


def summed(batches: Iterator[pa.RecordBatch], group: str, number: str) -> Iterator[tuple[int, dict]]:
    """From rows sorted by (group, number): each group with the added ``sums`` of its numbers."""
    now, sums = None, {}
    for batch in batches:
        for g, k, part in zip(*(batch.column(c).to_pylist() for c in (group, number, "sums"))):
            if g != now:
                if now is not None:
                    yield now, sums
                now, sums = g, {}
            sums[k] = sums.get(k, 0.0) + np.frombuffer(part)
    if now is not None:
        yield now, sums
