"""Bagged regression trees with an out-of-bag score (L5), all trees grown together.

A level of every tree is one Spark job (more only where the open nodes' histograms would pass
``MAX_CELLS``), so a forest takes as many jobs as it has levels, not levels times trees.  How often
a tree draws a row is a Poisson(1) count hashed from (seed, tree, row key): the bootstrap of
distributed bagging.  It can be computed again at any time, so "not drawn" is known after the
growth, and the out-of-bag prediction of each row is the mean of the trees that never drew it.
Where the grid of all bins is small (``veld.plans.cells``), one scan adds up each tree's drawn rows by
cell instead, and a task for each tree grows it on the sums.

Features are binned at quantiles, as in ``veld.plans.boost``.  A node is split where the weighted sum
of squares falls most, over ``max_features`` features hashed from (seed, tree, node); of equal
gains the first feature and lowest cut.  ``min_samples_split`` and ``min_samples_leaf`` count drawn
rows.  Nodes are numbered as they come, so depth has no limit but ``max_depth`` (None: none).

A missing feature or label raises.  Rows that every tree drew have no out-of-bag prediction and
count in no score.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veld.plans import cells
from veld.plans.boost import MAX_BINS, binned_rows, hash_rows, matrix

#: Histogram cells (weight and sum) that a task holds at once.
MAX_CELLS = 4_000_000
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


@dataclass
class GrownTree:
    """Nodes as they came: split feature (-1 in a leaf), cut bin, left child (right is next), value."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    open: list = field(default_factory=lambda: [0])
    depth: int = 0
    gain: list = field(default_factory=lambda: [0.0])       # fall of the sum of squares at a split

    def arrays(self) -> tuple:
        return tuple(np.array(a) for a in (self.feature, self.cut, self.left, self.value))


def node_of(tree: tuple, bins: np.ndarray, depth: int) -> np.ndarray:
    feature, cut, left, _ = tree
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = feature[node]
        node = np.where(f >= 0, left[node] + (bins[rows, f] > cut[node]), node)
    return node


def times_drawn(key: np.ndarray, seed: int, tree: int, bootstrap: bool = True) -> np.ndarray:
    """How often a tree has each row: a Poisson(1) count of the row's hash."""
    if not bootstrap:
        return np.ones(len(key), np.int64)
    share = hash_rows(key, f"{seed}:{tree}:bag").astype(np.float64) / 2.0 ** 64
    return np.searchsorted(POISSON, share, "right")


@dataclass
class Forest:
    features: list
    cuts: list
    trees: list
    seed: int
    bootstrap: bool = True

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the mean of all trees, scored in Arrow batches."""
        from pyspark.sql.types import DoubleType, StructField, StructType
        names = [c for c in df.columns if c != out]
        trees = [(t.arrays(), t.depth) for t in self.trees]
        cuts, sizes = self.cuts, cells.grid_of(self.cuts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
                bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
                one, back = cells.distinct(bins, sizes)
                total = sum((t[3][node_of(t, one, depth)] for t, depth in trees), np.zeros(len(one)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array((total / len(trees))[back])], [*names, out])

        xs = F.array(*[F.col(c).cast("double") for c in self.features]).alias("__x")
        return df.select(*names, xs).mapInArrow(run, StructType([*[df.schema[c] for c in names], StructField(out, DoubleType())]))

    def out_of_bag(self, state: DataFrame) -> DataFrame:
        """``(n, oob_r2, oob_rmse)`` over the binned rows the forest was grown on, in one aggregate."""
        trees = [(t.arrays(), t.depth) for t in self.trees]
        seed, bootstrap, sizes = self.seed, self.bootstrap, cells.grid_of(self.cuts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, y, key = matrix(batch, "bins").astype(np.int64), batch.column("y").to_numpy(), batch.column("key").to_numpy()
                total, votes = np.zeros(len(y)), np.zeros(len(y))
                one, back = cells.distinct(bins, sizes)
                for m, (t, depth) in enumerate(trees):
                    out = times_drawn(key, seed, m, bootstrap) == 0
                    total[out] += t[3][node_of(t, one, depth)][back][out]
                    votes += out
                has = votes > 0
                yield pa.RecordBatch.from_pydict({"y": pa.array(y[has]), "p": pa.array(total[has] / votes[has])})

        e = F.col("y") - F.col("p")
        sums = state.mapInArrow(run, "y double, p double").agg(F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), F.var_pop("y").alias("v"))
        return sums.select("n", (1 - F.try_divide("mse", "v")).alias("oob_r2"), F.sqrt("mse").alias("oob_rmse"))


@lru_cache(1 << 17)
def _allowed(p: int, max_features, seed: int, tree: int, node: int) -> list[int]:
    k = {"sqrt": math.sqrt(p), "log2": math.log2(p) if p > 1 else 1, None: p, "all": p}.get(max_features, max_features)
    k = max(1, int(k * p if isinstance(k, float) and max_features not in ("sqrt", "log2") else k))
    return list(range(p)) if k >= p else sorted(random.Random(f"{seed}:{tree}:{node}:features").sample(range(p), k))


def best_cuts(hist: np.ndarray, least: float, allowed: Sequence[Sequence[int]]) -> tuple:
    """Arrays ``(feature, cut, weight, sum, left weight, left sum)`` of nodes from their (2, node, feature, bin)
    histograms, by the fall of the sum of squares."""
    w, s = hist
    weight, total = w[:, 0].sum(axis=1), s[:, 0].sum(axis=1)
    lw, ls = np.cumsum(w, axis=2)[:, :, :-1], np.cumsum(s, axis=2)[:, :, :-1]
    rw, rs = weight[:, None, None] - lw, total[:, None, None] - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ls * ls / lw + rs * rs / rw - (total * total / weight)[:, None, None]
        least_gain = 1e-12 * np.maximum(1.0, total * total / weight)
    barred = np.ones(w.shape[:2], bool)
    for row, columns in zip(barred, allowed):
        row[columns] = False
    gain[(lw < least) | (rw < least) | barred[:, :, None]] = -np.inf
    node, gain = np.arange(len(w)), gain.reshape(len(w), -1)
    if not gain.size:
        return np.full(len(w), -1), np.zeros(len(w), int), weight, total, np.zeros(len(w)), np.zeros(len(w))
    at = np.argmax(gain, axis=1)
    split = gain[node, at] > least_gain
    feature, cut = np.divmod(np.where(split, at, 0), lw.shape[2])
    left = [np.where(split, x.reshape(len(w), -1)[node, at], 0.0) for x in (lw, ls)]
    return np.where(split, feature, -1), cut, weight, total, *left


def best_cut(hist: np.ndarray, least: float, allowed: Sequence[int]) -> tuple:
    """``best_cuts`` of one node from its (2, feature, bin) histogram."""
    return tuple(x[0].item() for x in best_cuts(hist[:, None], least, [allowed]))


def _level(state: DataFrame, trees: dict[int, GrownTree], p: int, bins: int, params: dict, seed: int) -> list:
    """One job: the best cut of every open node of these trees."""
    grown = {m: (t.arrays(), t.depth, np.array(t.open)) for m, t in trees.items()}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros((2, len(nodes) * p * bins)) for m, (_, _, nodes) in grown.items()}
        for batch in batches:
            binned, y, key = matrix(batch, "bins").astype(np.int64), batch.column("y").to_numpy(), batch.column("key").to_numpy()
            for m, (tree, depth, nodes) in grown.items():
                times = times_drawn(key, seed, m, params["bootstrap"])
                rows = np.flatnonzero(times)
                node = node_of(tree, binned[rows], depth)
                slot = np.searchsorted(nodes, node)
                there = nodes[np.minimum(slot, len(nodes) - 1)] == node
                rows, slot = rows[there], slot[there]
                at = ((slot[:, None] * p + np.arange(p)) * bins + binned[rows]).ravel()
                weight = np.repeat(times[rows].astype(np.float64), p)
                sums[m][0] += np.bincount(at, weight, len(nodes) * p * bins)
                sums[m][1] += np.bincount(at, weight * np.repeat(y[rows], p), len(nodes) * p * bins)
        out = []
        for m, s in sums.items():
            hist = s.reshape(2, -1, p, bins)
            out += [{"tree": m, "node": int(grown[m][2][k]), "sums": np.ascontiguousarray(hist[:, k]).tobytes()}
                    for k in np.flatnonzero(hist[0].any(axis=(1, 2)))]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())]))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, out = None, None, []

        def close():
            if now is not None:
                allowed = _allowed(p, params["max_features"], seed, *now)
                out.append(dict(zip(names, (*now, *best_cut(total.reshape(2, p, bins), params["min_samples_leaf"], allowed)))))

        names = ("tree", "node", "feature", "cut", "w", "s", "lw", "ls")
        for batch in batches:
            for m, node, sums in zip(*(batch.column(c).to_pylist() for c in ("tree", "node", "sums"))):
                if (m, node) != now:
                    close()
                    now, total = (m, node), 0.0
                total = total + np.frombuffer(sums)
        close()
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*[(c, pa.int32()) for c in names[:4]], *[(c, pa.float64()) for c in names[4:]]]))

    return state.mapInArrow(partial, "tree int, node int, sums binary").repartition("tree", "node") \
        .sortWithinPartitions("tree", "node").mapInArrow(
            joined, "tree int, node int, feature int, cut int, w double, s double, lw double, ls double").collect()


def _cell_sums(state: DataFrame, trees: Sequence[int], sizes: tuple, bootstrap: bool, seed: int) -> DataFrame:
    """One scan: ``(tree, part, sums)`` of a task's drawn rows by cell (weight, weighted label)."""
    n = math.prod(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # without a bootstrap the sums of one tree are those of all
        sums = {m: np.zeros((2, n)) for m in (trees if bootstrap else trees[:1])}
        for cell, y, _, key in cells.runs(batches, sizes, matrix):
            for m, s in sums.items():
                weight = times_drawn(key, seed, m, bootstrap).astype(np.float64)
                s[0] += np.bincount(cell, weight, n)
                s[1] += np.bincount(cell, weight * y, n)
        for m in trees:                             # a batch each, so that no batch is large
            s = sums[m if bootstrap else trees[0]]
            if s[0].any():
                yield pa.RecordBatch.from_pylist([{"tree": m, "part": 0, "sums": s.tobytes()}], schema=pa.schema(
                    [("tree", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())]))

    return state.mapInArrow(run, "tree int, part int, sums binary")


def cell_tree(number: int, sums: np.ndarray, binned: np.ndarray, bins: int, params: dict, seed: int) -> tuple[GrownTree, np.ndarray]:
    """A whole tree from its drawn rows' weights and label sums by cell, and its value in each cell."""
    p, rows, node = binned.shape[1], np.arange(len(binned)), np.zeros(len(binned), np.int64)
    at, drawn = binned + bins * np.arange(p), sums[0] > 0
    feature, cut, left, value, gain = np.array([-1]), np.array([0]), np.array([0]), np.zeros(1), np.zeros(1)
    opened, depth, most = np.array([0]) if drawn.any() else np.array([], int), 0, max(1, MAX_CELLS // (p * bins))
    while len(opened):
        found = []
        for i in range(0, len(opened), most):
            nodes = opened[i:i + most]
            slots = np.full(len(feature), -1)
            slots[nodes] = np.arange(len(nodes))
            slot = slots[node]
            on = np.flatnonzero(drawn & (slot >= 0))
            into = (slot[on, None] * (p * bins) + at[on]).ravel()
            hist = np.stack([np.bincount(into, np.repeat(x[on], p), len(nodes) * p * bins) for x in sums]).reshape(2, -1, p, bins)
            found.append(best_cuts(hist, params["min_samples_leaf"], [_allowed(p, params["max_features"], seed, number, k) for k in nodes.tolist()]))
        f, c, w, s, lw, ls = (np.concatenate(x) for x in zip(*found))
        value[opened] = s / w
        split = (f >= 0) & (w >= params["min_samples_split"])
        parents, lw, ls, w, s, n = opened[split], lw[split], ls[split], w[split], s[split], len(feature)
        if not len(parents):
            break
        rw, rs = w - lw, s - ls
        feature[parents], cut[parents], left[parents] = f[split], c[split], n + 2 * np.arange(len(parents))
        gain[parents] = ls * ls / lw + rs * rs / rw - s * s / w
        both = np.stack([lw, rw], axis=1).ravel()
        feature, cut, left, value, gain = (np.concatenate([old, new]) for old, new in (
            (feature, np.full(len(both), -1)), (cut, np.zeros(len(both), int)), (left, np.zeros(len(both), int)),
            (value, np.stack([ls / lw, rs / rw], axis=1).ravel()), (gain, np.zeros(len(both)))))
        of = feature[node]
        node = np.where(of >= 0, left[node] + (binned[rows, of] > cut[node]), node)
        depth += 1
        deeper = params["max_depth"] is None or depth < params["max_depth"]
        opened = n + np.flatnonzero(deeper & (both >= params["min_samples_split"]) & (both >= 2 * params["min_samples_leaf"]))
    return GrownTree(feature, cut, left, value, [], depth, gain), value[node]


def _grow_on_cells(state: DataFrame, trees: list[GrownTree], sizes: tuple, bins: int, params: dict, seed: int) -> None:
    """Grow all trees; a scan serves as many as ``MAX_CELLS`` lets a task add up."""
    types = pa.schema([("tree", pa.int32()), ("depth", pa.int32()), *[(c, pa.list_(pa.int32())) for c in ("feature", "cut", "left")],
                       *[(c, pa.list_(pa.float64())) for c in ("value", "gain")]])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binned = cells.bins_of(sizes)
        for m, sums in cells.summed(batches, "tree", "part"):
            t, _ = cell_tree(m, sums[0].reshape(2, -1), binned, bins, params, seed)
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, (m, t.depth, t.feature, t.cut, t.left, t.value, t.gain)))], schema=types)

    most = max(1, MAX_CELLS // math.prod(sizes))
    for i in range(0, len(trees), most):
        sums = _cell_sums(state, range(i, min(len(trees), i + most)), sizes, params["bootstrap"], seed)
        for r in sums.repartition("tree").sortWithinPartitions("tree").mapInArrow(
                grow, "tree int, depth int, feature array<int>, cut array<int>, left array<int>, value array<double>, gain array<double>").collect():
            trees[r["tree"]] = GrownTree(*(list(r[c]) for c in ("feature", "cut", "left", "value")), [], r["depth"], list(r["gain"]))


def _enter(tree: GrownTree, cuts: list, params: dict) -> None:
    """Enter a level's cuts; the children that may be split are the next open nodes."""
    opened = []
    deeper = params["max_depth"] is None or tree.depth + 1 < params["max_depth"]
    for c in sorted(cuts, key=lambda r: r["node"]):
        node = c["node"]
        tree.value[node] = c["s"] / c["w"]
        if c["feature"] < 0 or c["w"] < params["min_samples_split"]:
            continue
        tree.feature[node], tree.cut[node], tree.left[node] = c["feature"], c["cut"], len(tree.feature)
        sides = (c["lw"], c["ls"]), (c["w"] - c["lw"], c["s"] - c["ls"])
        tree.gain[node] = sum(s * s / w for w, s in sides) - c["s"] * c["s"] / c["w"]
        for w, s in sides:
            if deeper and w >= params["min_samples_split"] and w >= 2 * params["min_samples_leaf"]:
                opened.append(len(tree.feature))
            for values, new in ((tree.feature, -1), (tree.cut, 0), (tree.left, 0), (tree.value, s / w), (tree.gain, 0.0)):
                values.append(new)
    grew = any(c["feature"] >= 0 and c["w"] >= params["min_samples_split"] for c in cuts)
    tree.depth += grew
    tree.open = opened


def fit_forest(data: DataFrame, features: Sequence[str], label: str, key: Sequence[str], n_estimators: int = 100,
               max_depth: int | None = None, min_samples_split: int = 2, min_samples_leaf: int = 1, max_features="all",
               bootstrap: bool = True, max_bins: int = MAX_BINS, seed: int = 42, by_value: bool = False) -> tuple[Forest, DataFrame]:
    """The forest, and the binned rows it was grown on (for ``Forest.out_of_bag``)."""
    feats = list(features)
    state, cuts, bins, _ = binned_rows(data, feats, label, key, None, max_bins, by_value)
    return grow_forest(state, cuts, bins, feats, n_estimators, max_depth, min_samples_split, min_samples_leaf, max_features, bootstrap, seed), state


def grow_forest(state: DataFrame, cuts: list, bins: int, feats: list, n_estimators: int = 100, max_depth: int | None = None,
                min_samples_split: int = 2, min_samples_leaf: int = 1, max_features="all", bootstrap: bool = True, seed: int = 42) -> Forest:
    """``fit_forest`` on rows binned before."""
    params = {"max_depth": max_depth, "min_samples_split": min_samples_split, "min_samples_leaf": min_samples_leaf,
              "max_features": max_features, "bootstrap": bootstrap}
    trees = [GrownTree() for _ in range(n_estimators)]
    sizes = cells.grid_of(cuts)
    if sizes:
        _grow_on_cells(state, trees, sizes, bins, params, seed)
        return Forest(feats, cuts, trees, seed, bootstrap)
    while any(t.open for t in trees):
        rows: list = []
        group: dict[int, GrownTree] = {}
        size = 0
        for m, t in [(m, t) for m, t in enumerate(trees) if t.open]:
            wide = len(t.open) * len(feats) * bins
            if group and size + wide > MAX_CELLS:
                rows += _level(state, group, len(feats), bins, params, seed)
                group, size = {}, 0
            group[m], size = t, size + wide
        rows += _level(state, group, len(feats), bins, params, seed)
        for m, t in enumerate(trees):
            if t.open:
                _enter(t, [r for r in rows if r["tree"] == m], params)
    return Forest(feats, cuts, trees, seed, bootstrap)
