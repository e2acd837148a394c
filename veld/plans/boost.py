"""Second-order gradient-boosted trees on shared histograms.

All models of a search (candidates x held-out folds) grow together: one Spark job a tree level
serves every model.  Features are binned once, at quantiles.  A task adds up the gradients and
Hessians of its rows by (model, node, feature, bin) with one ``bincount`` a model, partial
histograms meet in a shuffle by (model, node), and the task that sums a node's histograms also
picks its split; the driver sees one row for each open node, ``models * 2**level`` at most.
When a tree is complete its leaf values are added to each row's predictions and the rows are
written, so no plan grows with the number of trees and a lost executor repeats one level.
Where the grid of all bins is small (``veld.plans.cells``), one scan adds up the drawn rows of every
(model, tree) by cell instead, and a task for each model grows its trees on the sums.  A search keeps of
such models only the held-out errors, and hashes a row once a tree for all candidates and folds.

Squared error, so a row's gradient is prediction - label and its Hessian 1.  With G and H the
sums of a node, T the soft threshold by ``reg_alpha``:

* leaf value: ``-learning_rate * T(G) / (H + reg_lambda)``;
* gain: ``(T(GL)^2/(HL+l) + T(GR)^2/(HR+l) - T(G)^2/(H+l)) / 2 - gamma``, taken where it is positive
  and both sides have ``min_child_weight``; of equal gains the first feature and lowest cut;
* ``subsample`` draws rows per tree by a hash of (seed, tree, row), ``colsample_bytree`` draws
  features per tree, ``colsample_bynode`` of these for each node; all are the same whatever the partitions;
* ``first_rate``, if given, is the learning rate of the first tree;
* ``early_stopping_rounds`` ends a model once its held-out error has not improved for so long;
  predictions stop at the best tree.

A missing feature or label raises, as the other fits do.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veld.plans import cells
from veld.plans.adaptive import ParzenSampler
from veld.plans.evaluate import best_of, sample_continuous
from veld.plans.ranks import between, order_values
from veld.session import materialize

DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "gamma": 0.0, "reg_alpha": 0.0, "reg_lambda": 1.0,
            "min_child_weight": 1.0, "subsample": 1.0, "colsample_bytree": 1.0, "colsample_bynode": 1.0, "first_rate": None,
            "early_stopping_rounds": None}
MAX_BINS = 64
#: Cells (count and sum) that a task holds at once.
MAX_CELLS = 4_000_000
#: In a search: sums of a batch that a task sends, and of a block of trees of all trials.
BLOCK_CELLS, BLOCK_SUMS = 1 << 20, 48_000_000


@dataclass
class Tree:
    """Nodes in heap order: split feature (-1 in a leaf), cut bin (left is <=), gain and leaf value."""
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n))

    def node_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(levels):
            f = self.feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (bins[rows, f] > self.cut[node]), node)
        return node


@dataclass
class Booster:
    """A model while it grows and after: predictions are ``base`` plus the values of ``trees``."""
    params: dict
    features: list
    cuts: list
    base: float
    holdout: int | None = None
    trees: list = field(default_factory=list)
    scores: list = field(default_factory=list)      # held-out RMSE before the first tree, after each
    stopped: bool = False

    @property
    def depth(self) -> int:
        return int(self.params["max_depth"])

    @property
    def best_iteration(self) -> int:
        """Number of trees that predictions use."""
        return int(np.argmin(self.scores)) if self.params["early_stopping_rounds"] and self.scores else len(self.trees)

    def growing(self) -> bool:
        return not self.stopped and len(self.trees) < int(self.params["n_estimators"])

    def score_seen(self, rmse: float) -> None:
        self.scores.append(rmse)
        rounds = self.params["early_stopping_rounds"]
        if rounds and len(self.scores) - 1 - int(np.argmin(self.scores)) >= rounds:
            self.stopped = True

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees[:self.best_iteration]:
            out += tree.value[tree.node_of(bins, self.depth)]
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with predictions, scored in Arrow batches; the model goes to the tasks with the job."""
        model, features, sizes = self, list(self.features), cells.grid_of(self.cuts)
        xs = F.array(*[F.col(c).cast("double") for c in features])
        names = [c for c in df.columns if c != out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(features))
                bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(model.cuts)])
                one, back = cells.distinct(bins, sizes)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.predict_bins(one)[back])], [*names, out])

        from pyspark.sql.types import DoubleType, StructField, StructType
        schema = StructType([*[df.schema[c] for c in names], StructField(out, DoubleType())])
        return df.select(*names, xs.alias("__x")).mapInArrow(run, schema)

    def importance(self) -> list[tuple[str, float]]:
        """Average gain of a feature's splits, as shares (``importance_type='gain'``)."""
        total, times = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees[:self.best_iteration]:
            split = tree.feature >= 0
            np.add.at(total, tree.feature[split], tree.gain[split])
            np.add.at(times, tree.feature[split], 1)
        mean = np.divide(total, times, out=np.zeros(len(total)), where=times > 0)
        return list(zip(self.features, (mean / mean.sum() if mean.sum() else mean).tolist()))


def _soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(hist: np.ndarray, params: dict, allowed: np.ndarray) -> tuple:
    """Arrays ``(feature, cut, gain, G, H, GL, HL)`` of nodes from their (2, node, feature, bin) histograms;
    ``allowed`` says which features each node may use, feature -1 that it has no split."""
    g, h = hist
    total_g, total_h = g[:, 0].sum(axis=1)[:, None, None], h[:, 0].sum(axis=1)[:, None, None]
    alpha, lam = params["reg_alpha"], params["reg_lambda"]
    score = lambda a, b: _soft(a, alpha) ** 2 / np.maximum(b + lam, 1e-300)
    gl, hl = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    hr, width = total_h - hl, gl.shape[2]
    gain = 0.5 * (score(gl, hl) + score(total_g - gl, hr) - score(total_g, total_h)) - params["gamma"]
    least = max(params["min_child_weight"], 1e-9)
    gain[(hl < least) | (hr < least) | ~allowed[:, :, None]] = -np.inf
    gain = gain.reshape(len(g), -1)
    if not gain.size:
        gain = np.full((len(g), 1), -np.inf)
    node, at = np.arange(len(g)), np.argmax(gain, axis=1)
    split = gain[node, at] > 0
    at[~split] = 0
    feature, cut = np.divmod(at, max(1, width))
    left = [np.where(split, x.reshape(len(g), -1)[node, at], 0.0) if width else np.zeros(len(g)) for x in (gl, hl)]
    return np.where(split, feature, -1), cut, np.where(split, gain[node, at], 0.0), total_g[:, 0, 0], total_h[:, 0, 0], *left


def best_split(hist: np.ndarray, params: dict, allowed: Sequence[int]) -> tuple:
    """``best_splits`` of one node from its (2, feature, bin) histogram."""
    return tuple(x[0].item() for x in best_splits(hist[:, None], params, _mask([allowed], hist.shape[1])))


def _mask(allowed: Sequence[Sequence[int]], p: int) -> np.ndarray:
    out = np.zeros((len(allowed), p), bool)
    for row, columns in zip(out, allowed):
        row[list(columns)] = True
    return out


def _columns_of(model: Booster, number: int, tree: int, seed: int) -> list[int]:
    """The features a tree may use: drawn per tree, one at least."""
    p, share = len(model.features), float(model.params["colsample_bytree"])
    if share >= 1.0:
        return list(range(p))
    return sorted(random.Random(f"{seed}:{number}:{tree}").sample(range(p), max(1, math.floor(share * p))))


def _node_columns(model: Booster, number: int, node: int, allowed: list[int], seed: int) -> list[int]:
    """Those of the next tree's features that a node may use."""
    share = float(model.params["colsample_bynode"])
    if share >= 1.0:
        return allowed
    return sorted(random.Random(f"{seed}:{number}:{len(model.trees)}:{node}").sample(allowed, math.ceil(share * len(allowed))))


def hash_rows(key: np.ndarray, salt: str) -> np.ndarray:
    """A 64-bit hash of each row key under a salt."""
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) ^ np.uint64(random.Random(salt).getrandbits(64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def _row_hash(key: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """What a tree draws its rows by, the same for all models: the larger of two shares draws the smaller's rows too."""
    return hash_rows(key, f"{seed}:0:{tree}:rows")


def _bound(share: float) -> np.uint64:
    return np.uint64(int(share * 2.0 ** 64))


def drawn_rows(key: np.ndarray, share: float, seed: int, tree: int) -> np.ndarray:
    return np.ones(len(key), bool) if share >= 1.0 else _row_hash(key, seed, tree) < _bound(share)


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _level(state: DataFrame, models: list[Booster], current: dict[int, Tree], level: int, bins: int, seed: int) -> list:
    """One job: the splits of every open node of a level, and at level 0 the held-out errors (node -1)."""
    p = len(models[0].features)
    first, width = 2 ** level - 1, 2 ** level
    allowed = {m: _columns_of(models[m], m, len(models[m].trees), seed) for m in current}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros((2, width * p * bins)) for m in current}
        errors = np.zeros((len(models), 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            y, fold, key = (batch.column(c).to_numpy() for c in ("y", "fold", "key"))
            binned, pred = matrix(batch, "bins").astype(np.int64), matrix(batch, "pred")
            for m, model in enumerate(models):
                gradient = pred[:, m] - y
                if level == 0 and model.holdout is not None:
                    out = fold == model.holdout
                    errors[m] += out.sum(), (gradient[out] ** 2).sum()
                if m not in current:
                    continue
                rows = drawn_rows(key, float(model.params["subsample"]), seed, len(model.trees))
                if model.holdout is not None:
                    rows &= fold != model.holdout
                node = current[m].node_of(binned[rows], level) - first
                there = node >= 0
                at = ((node[there, None] * p + np.arange(p)) * bins + binned[rows][there]).ravel()
                sums[m][0] += np.bincount(at, np.repeat(gradient[rows][there], p), width * p * bins)
                sums[m][1] += np.bincount(at, minlength=width * p * bins)
        out = [(m, -1, e.tobytes()) for m, e in enumerate(errors) if level == 0 and e[0]]
        for m, s in sums.items():
            nodes = s.reshape(2, width, p, bins)
            out += [(m, first + k, np.ascontiguousarray(nodes[:, k]).tobytes()) for k in np.flatnonzero(nodes[1].any(axis=(1, 2)))]
        yield pa.RecordBatch.from_pylist([dict(zip(("model", "node", "sums"), r)) for r in out],
                                         schema=pa.schema([("model", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())]))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, total, out = None, None, []

        def close():
            if open_key is not None:
                m, node = open_key
                best = (-1, 0, 0.0, total[1], total[0], 0.0, 0.0) if node < 0 else \
                    best_split(total.reshape(2, p, bins), models[m].params, _node_columns(models[m], m, node, allowed[m], seed))
                out.append(dict(zip(("model", "node", "feature", "cut", "gain", "g", "h", "gl", "hl"), (m, node, *best))))

        for batch in batches:
            for m, node, sums in zip(*(batch.column(c).to_pylist() for c in ("model", "node", "sums"))):
                if (m, node) != open_key:
                    close()
                    open_key, total = (m, node), 0.0
                total = total + np.frombuffer(sums)
        close()
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("model", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.int32()),
             *[(c, pa.float64()) for c in ("gain", "g", "h", "gl", "hl")]]))

    parts = state.mapInArrow(partial, "model int, node int, sums binary")
    return parts.repartition("model", "node").sortWithinPartitions("model", "node").mapInArrow(
        joined, "model int, node int, feature int, cut int, gain double, g double, h double, gl double, hl double").collect()


def _leaf(model: Booster, g, h):
    p = model.params
    rate = p["learning_rate"] if model.trees or p["first_rate"] is None else p["first_rate"]
    return -rate * _soft(np.asarray(g, np.float64), p["reg_alpha"]) / np.maximum(h + p["reg_lambda"], 1e-300)


def _grow(model: Booster, tree: Tree, level: int, splits: list) -> bool:
    """Enter a level's splits; whether the tree goes on."""
    goes_on = False
    for s in splits:
        node = s["node"]
        tree.value[node] = _leaf(model, s["g"], s["h"])
        if s["feature"] < 0:
            continue
        tree.feature[node], tree.cut[node], tree.gain[node] = s["feature"], s["cut"], s["gain"]
        for child, g, h in ((2 * node + 1, s["gl"], s["hl"]), (2 * node + 2, s["g"] - s["gl"], s["h"] - s["hl"])):
            tree.value[child] = _leaf(model, g, h)
        goes_on = True
    return goes_on and level + 1 < model.depth


def _with_trees(state: DataFrame, trees: dict[int, tuple[Tree, int]]) -> DataFrame:
    """The rows with the values of the finished trees added, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                binned, pred = matrix(batch, "bins"), matrix(batch, "pred").copy()
                for m, (tree, depth) in trees.items():
                    pred[:, m] += tree.value[tree.node_of(binned, depth)]
                ends = pa.array(np.arange(0, pred.size + 1, pred.shape[1], dtype=np.int32))
                at = batch.schema.get_field_index("pred")
                yield batch.set_column(at, "pred", pa.ListArray.from_arrays(ends, pa.array(pred.ravel())))

    return materialize(state.mapInArrow(run, state.schema), "boost")


def few_values(data: DataFrame, names: Sequence[str], most: int, fold: str = "fold") -> dict[tuple[str, int], np.ndarray]:
    """The sorted values of each column in each fold where they are at most ``most``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            of = batch.column(len(names)).to_numpy(zero_copy_only=False)
            for x in names:
                values = batch.column(x).to_numpy(zero_copy_only=False)
                for k in np.unique(of).tolist():
                    if (old := seen.get((x, k), ())) is not None:
                        found = np.unique(np.concatenate([old, values[of == k]]))
                        seen[x, k] = found if len(found) <= most else None
        yield pa.RecordBatch.from_pydict({"name": pa.array([x for x, _ in seen], pa.string()), "k": pa.array([k for _, k in seen], pa.int32()),
                                          "v": pa.array(list(seen.values()), pa.list_(pa.float64()))})

    found = data.select(*names, fold).mapInArrow(run, "name string, k int, v array<double>").groupBy("name", "k").agg(
        F.count_if(F.col("v").isNull()).alias("over"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("v")))).alias("v"))
    return {(r["name"], r["k"]): np.array(r["v"]) for r in found.where((F.col("over") == 0) & (F.size("v") <= most)).collect()}


def cuts_of(data: DataFrame, names: Sequence[str], max_bins: int, by_value: bool, folds: Sequence[int] = (0,),
            scales: dict | None = None, fold: str = "fold") -> dict[int | None, list]:
    """Each feature's cuts: of all rows as None, or, with ``scales``, of the rows outside each fold.
    ``scales`` has the (shift, factor) of each feature for a fold's training rows; cuts are of scaled values."""
    holdouts = [None] if scales is None else list(scales)
    scaled = {h: [lambda v: v] * len(names) if scales is None else [lambda v, a=a, b=b: (v - a) * b for a, b in zip(*scales[h])] for h in holdouts}
    few: dict = {}
    if by_value:
        seen = few_values(data, names, max_bins, fold)
        for h in holdouts:
            for x, scale in zip(names, scaled[h]):
                parts = [seen.get((x, k)) for k in folds if k != h]
                if all(v is not None for v in parts):
                    values = np.unique(scale(np.unique(np.concatenate(parts))))
                    few.update({(x, h): values} if len(values) <= max_bins else {})
    probs = [k / max_bins for k in range(1, max_bins)]
    n, values = order_values(data, [x for x in names if any((x, h) not in few for h in holdouts)], fold, holdouts, probs)
    return {h: [few[x, h][:-1] / 2 + few[x, h][1:] / 2 if (x, h) in few else
                np.unique(np.array(between(n[x, h], lambda r: scale(values[x, h, r]), probs))) for x, scale in zip(names, scaled[h])] for h in holdouts}


def bins_array(x: np.ndarray, cuts: Sequence[np.ndarray]) -> pa.ListArray:
    """Each row's bins: a value's bin is the number of cuts below it."""
    bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, bins.size + 1, bins.shape[1], dtype=np.int32)), pa.array(bins.ravel()))


class BinnedOnce:
    """Rows that ``binned_rows`` bins and writes when first asked, for a search and the fits after it."""
    def __init__(self, data: DataFrame):
        self.data, self.kept = data, {}

    def binned(self, features: list, label: str, key: Sequence[str], *how) -> tuple:
        asked = (tuple(features), label, tuple(key), *how)
        if asked not in self.kept:
            self.kept[asked] = binned_rows(self.data, features, label, key, *how)
        return self.kept[asked]


def binned_rows(data: DataFrame | BinnedOnce, features: list, label: str, key: Sequence[str], fold: str | None,
                max_bins: int, by_value: bool = False) -> tuple[DataFrame, list, int, dict]:
    """Written rows (key, fold, y, bins), each feature's cuts, the number of bins, and count, mean and variance by fold.
    ``by_value`` cuts a feature of at most ``max_bins`` values between every two of them.
    Raises where a feature or the label is missing."""
    if isinstance(data, BinnedOnce):
        return data.binned(features, label, key, fold, max_bins, by_value)
    names = [f"x{j}" for j in range(len(features))]
    group = F.col(fold).cast("int") if fold else F.lit(0)
    # the rows' plan runs once; the scans that follow read the written columns
    data = materialize(data.select(F.xxhash64(*key).alias("key"), group.alias("fold"), F.col(label).cast("double").alias("y"),
                                   *[F.col(c).cast("double").alias(x) for c, x in zip(features, names)]), "fit-rows")
    gaps = F.count_if(F.col("y").isNull() | F.greatest(*[F.col(x).isNull().cast("int") for x in names], F.lit(0)).cast("boolean"))
    by_fold = {r["k"]: r for r in data.groupBy(F.col("fold").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("my"),
                                                                             F.var_pop("y").alias("v"), gaps.alias("gaps")).collect()}
    if not by_fold or any(r["gaps"] for r in by_fold.values()):
        raise ValueError("no rows to fit" if not by_fold else "rows lack a feature or the label: fill or drop them first")
    cuts = cuts_of(data, names, max_bins, by_value, list(by_fold))[None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], bins_array(matrix(batch, "x"), cuts)], ["key", "fold", "y", "bins"])

    rows = data.select("key", "fold", "y", F.array(*names).alias("x")).mapInArrow(run, "key long, fold int, y double, bins array<int>")
    return materialize(rows, "binned"), cuts, max(len(c) for c in cuts) + 1, by_fold


def _cell_sums(rows: DataFrame, models: list[Booster], trees: dict[int, range], sizes: tuple, center: float, seed: int) -> DataFrame:
    """One scan: ``(model, tree, sums)`` of a task's drawn rows by cell (count, sum of label - ``center``), and
    as tree -1 the same and the sum of squares of the model's held-out rows."""
    n = math.prod(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(m, t): np.zeros((2, n)) for m, numbers in trees.items() for t in numbers}
        folds = {models[m].holdout for m in trees}
        held = {k: np.zeros((3, n)) for k in folds if k is not None}
        for cell, y, fold, key in cells.runs(batches, sizes, matrix):
            y = y - center
            for k in folds:
                c, v, ids = cell, y, key
                if k is not None:
                    out = fold == k
                    for power in range(3):
                        held[k][power] += np.bincount(cell[out], y[out] ** power, n)
                    c, v, ids = cell[~out], y[~out], key[~out]
                for m, t in sums:
                    if models[m].holdout == k:
                        drawn = drawn_rows(ids, float(models[m].params["subsample"]), seed, t)
                        sums[m, t][0] += np.bincount(c[drawn], minlength=n)
                        sums[m, t][1] += np.bincount(c[drawn], v[drawn], n)
        found = [(m, t, s) for (m, t), s in sums.items()] + [(m, -1, held[models[m].holdout]) for m in trees if models[m].holdout is not None]
        for m, t, s in found:                       # a batch each, so that no batch is large
            if s[0].any():
                yield pa.RecordBatch.from_pylist([{"model": m, "tree": t, "sums": s.tobytes()}], schema=pa.schema(
                    [("model", pa.int32()), ("tree", pa.int32()), ("sums", pa.binary())]))

    return rows.mapInArrow(run, "model int, tree int, sums binary")


def cell_tree(model: Booster, number: int, pred: np.ndarray, sums: np.ndarray | None, binned: np.ndarray, bins: int, seed: int
               ) -> tuple[Tree, np.ndarray]:
    """The next tree of a model from its drawn rows' counts and label sums by cell, and its value in each cell."""
    tree, p = Tree.empty(model.depth), binned.shape[1]
    node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
    if sums is None:
        return tree, tree.value[node]
    gradient, drawn, at = sums[0] * pred - sums[1], sums[0] > 0, binned + bins * np.arange(p)
    allowed = _columns_of(model, number, len(model.trees), seed)
    level, goes_on = 0, True
    while goes_on:
        first = 2 ** level - 1
        on = np.flatnonzero(drawn & (node >= first))
        there = np.bincount(node[on] - first, minlength=first + 1) > 0
        nodes, slot = first + np.flatnonzero(there), (np.cumsum(there) - 1)[node[on] - first]
        into = (slot[:, None] * (p * bins) + at[on]).ravel()
        hist = np.stack([np.bincount(into, np.repeat(x[on], p), len(nodes) * p * bins) for x in (gradient, sums[0])]).reshape(2, -1, p, bins)
        mask = _mask([_node_columns(model, number, k, allowed, seed) for k in nodes.tolist()] if model.params["colsample_bynode"] < 1.0 else [allowed], p)
        feature, cut, gain, g, h, gl, hl = best_splits(hist, model.params, mask)
        tree.value[nodes] = _leaf(model, g, h)
        split = feature >= 0
        parents = nodes[split]
        tree.feature[parents], tree.cut[parents], tree.gain[parents] = feature[split], cut[split], gain[split]
        for child, a, b in ((2 * parents + 1, gl, hl), (2 * parents + 2, g - gl, h - hl)):
            tree.value[child] = _leaf(model, a[split], b[split])
        f = tree.feature[node]
        node = np.where(f >= 0, 2 * node + 1 + (binned[rows, f] > tree.cut[node]), node)
        level += 1
        goes_on = bool(split.any()) and level < model.depth
    return tree, tree.value[node]


def _grow_on_cells(rows: DataFrame, models: list[Booster], sizes: tuple, bins: int, center: float, seed: int) -> None:
    """Grow all models; a scan serves as many (model, tree) as ``MAX_CELLS`` lets a task add up."""
    fields = "model int, tree int, feature array<int>, cut array<int>, gain array<double>, value array<double>, rmse double"
    types = pa.schema([("model", pa.int32()), ("tree", pa.int32()), ("feature", pa.list_(pa.int32())), ("cut", pa.list_(pa.int32())),
                       ("gain", pa.list_(pa.float64())), ("value", pa.list_(pa.float64())), ("rmse", pa.float64())])
    pairs = max(1, MAX_CELLS // math.prod(sizes))
    unscored = {m for m, model in enumerate(models) if model.holdout is not None}

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binned = cells.bins_of(sizes)
        for m, sums in cells.summed(batches, "model", "tree"):
            model = replace(models[m], trees=list(models[m].trees), scores=list(models[m].scores))
            pred = np.full(len(binned), model.base - center)
            for tree in model.trees:
                pred += tree.value[tree.node_of(binned, model.depth)]
            held, out = sums[-1].reshape(3, -1) if -1 in sums else None, []

            def seen(t: int, tree: Tree) -> None:
                rmse = None
                if held is not None:
                    error = held[0] * pred ** 2 - 2 * held[1] * pred + held[2]
                    rmse = math.sqrt(max(0.0, float(error.sum())) / float(held[0].sum()))
                    model.score_seen(rmse)
                out.append(dict(zip(types.names, (m, t, tree.feature, tree.cut, tree.gain, tree.value, rmse))))

            if not model.scores:
                seen(-1, Tree.empty(0))
            for t in trees[m]:
                if model.growing():
                    tree, values = cell_tree(model, m, pred, sums[t].reshape(2, -1) if t in sums else None, binned, bins, seed)
                    pred += values
                    model.trees.append(tree)
                    seen(t, tree)
            yield pa.RecordBatch.from_pylist(out, schema=types)

    while todo := [m for m, model in enumerate(models) if model.growing() or m in unscored][:pairs]:
        unscored -= set(todo)
        each = max(1, pairs // len(todo))
        trees = {m: range(len(models[m].trees), min(int(models[m].params["n_estimators"]), len(models[m].trees) + each)) for m in todo}
        sums = _cell_sums(rows, models, trees, sizes, center, seed)
        grown = sums.repartition("model").sortWithinPartitions("model", "tree").mapInArrow(grow, fields).collect()
        for r in sorted(grown, key=lambda r: (r["model"], r["tree"])):
            model = models[r["model"]]
            if r["tree"] >= 0:
                model.trees.append(Tree(*(np.array(r[c]) for c in ("feature", "cut", "gain", "value"))))
            if r["rmse"] is not None:
                model.score_seen(r["rmse"])
        for m in set(todo) - {r["model"] for r in grown}:       # no row drawn, none held out: trees without a split
            models[m].trees += [Tree.empty(models[m].depth) for _ in trees[m]]


def _known(candidates: Sequence[dict]) -> None:
    unknown = {k for c in candidates for k in c} - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}; known: {sorted(DEFAULTS)}")


def fit_boosted(data: DataFrame | BinnedOnce, features: Sequence[str], label: str, key: Sequence[str], candidates: Sequence[dict],
                fold: str | None = None, holdouts: Sequence[int | None] = (None,), max_bins: int = MAX_BINS,
                seed: int = 42, by_value: bool = False) -> list[list[Booster]]:
    """A booster for each candidate (outer) and held-out fold (inner; None: all rows), grown together."""
    feats = list(features)
    _known(candidates)
    return grow_boosted(*binned_rows(data, feats, label, key, fold, max_bins, by_value), feats, candidates, holdouts, seed)


def _models(cuts: list, by_fold: dict, feats: list, candidates: Sequence[dict], holdouts: Sequence[int | None]) -> list[Booster]:
    models = []
    for params in candidates:
        for holdout in holdouts:
            train = [r for k, r in by_fold.items() if k != holdout]
            base = sum(r["n"] * r["my"] for r in train) / sum(r["n"] for r in train)
            models.append(Booster(DEFAULTS | dict(params), feats, cuts, float(base), holdout))
    return models


def _center(by_fold: dict) -> float:
    return sum(r["n"] * r["my"] for r in by_fold.values()) / sum(r["n"] for r in by_fold.values())


def grow_boosted(rows: DataFrame, cuts: list, bins: int, by_fold: dict, feats: list, candidates: Sequence[dict],
                 holdouts: Sequence[int | None] = (None,), seed: int = 42) -> list[list[Booster]]:
    """``fit_boosted`` on rows binned before."""
    models = _models(cuts, by_fold, feats, candidates, holdouts)
    per = len(holdouts)
    sizes = cells.grid_of(cuts)
    if sizes:
        _grow_on_cells(rows, models, sizes, bins, _center(by_fold), seed)
        return [models[i:i + per] for i in range(0, len(models), per)]
    state = rows.withColumn("pred", F.array(*[F.lit(m.base) for m in models]))
    while True:
        current = {m: Tree.empty(model.depth) for m, model in enumerate(models) if model.growing()}
        trees, level = dict(current), 0
        while current or level == 0:
            rows = _level(state, models, current, level, bins, seed)
            if level == 0:
                for r in rows:
                    if r["node"] < 0 and (models[r["model"]].growing() or len(models[r["model"]].scores) <= len(models[r["model"]].trees)):
                        models[r["model"]].score_seen(math.sqrt(r["g"] / r["h"]))
                # a model that has just stopped grows no more
                trees = {m: t for m, t in trees.items() if not models[m].stopped}
            splits = {m: [r for r in rows if r["model"] == m and r["node"] >= 0] for m in current if m in trees}
            current = {m: trees[m] for m, s in splits.items() if _grow(models[m], trees[m], level, s)}
            level += 1
        if not trees:
            break
        state = _with_trees(state, {m: (t, models[m].depth) for m, t in trees.items()})
        for m, t in trees.items():
            models[m].trees.append(t)
    return [models[i:i + per] for i in range(0, len(models), per)]


def _slot_sums(rows: DataFrame, trees: range, shares: dict[int, float], seed: int) -> DataFrame:
    """One scan: ``(trial, slots, counts, sums)`` of each trial's drawn rows by slot, tree after tree.  A row is
    hashed once for a tree, whatever the trials: its hash lies between two of the sorted bounds, and a trial's
    sums are those of all rows below its bound.  Rows come sorted by slot, so a task has few slots."""
    whole = [t for t, share in shares.items() if share >= 1.0]
    bounds = np.unique(np.array([_bound(v) for v in shares.values() if v < 1.0], np.uint64))
    place = {t: len(bounds) if t in whole else int(np.searchsorted(bounds, _bound(v))) for t, v in shares.items()}
    most = max(1, BLOCK_CELLS // ((len(bounds) + 1) * len(trees)))

    def of_slots(slot: np.ndarray, y: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        slots, local = np.unique(slot, return_inverse=True)
        n, kinds = len(slots), len(bounds) + 1
        counts, sums = np.zeros((kinds, len(trees), n), np.int32), np.zeros((kinds, len(trees), n))
        for b, t in enumerate(trees):
            at = np.searchsorted(bounds, _row_hash(key, seed, t), "right") * n + local if len(bounds) else local
            counts[:, b] = np.cumsum(np.bincount(at, minlength=kinds * n).reshape(kinds, n), axis=0)
            sums[:, b] = np.cumsum(np.bincount(at, y, kinds * n).reshape(kinds, n), axis=0)
        slots = slots.astype(np.int32).tobytes()
        return pa.RecordBatch.from_pydict({
            "trial": pa.array(list(place), pa.int32()), "slots": pa.array([slots] * len(place), pa.binary()),
            "counts": pa.array([counts[k].tobytes() for k in place.values()], pa.binary()),
            "sums": pa.array([sums[k].tobytes() for k in place.values()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, y, key in cells.columns_of(batches, ("slot", "y", "key")):
            order = np.argsort(slot, kind="stable")
            slot, y, key = slot[order], y[order], key[order]
            starts = np.flatnonzero(np.diff(slot, prepend=-1))[::most].tolist()
            for a, b in zip(starts, [*starts[1:], len(slot)]):
                yield of_slots(slot[a:b], y[a:b], key[a:b])

    return rows.mapInArrow(run, "trial int, slots binary, counts binary, sums binary")


def _scores_on_cells(rows: DataFrame, cuts: list, bins: int, by_fold: dict, feats: list, candidates: Sequence[dict],
                     holdouts: Sequence[int], seed: int) -> list[list[float]]:
    """The held-out errors of every (candidate, fold), as ``grow_boosted`` gives them; the trees stay in the tasks.
    A scan serves a block of trees of all models; a task grows those of one candidate on all folds from the drawn rows' sums
    by slot (fold, cell).  Between blocks the models are their predictions by cell, written beside the errors."""
    sizes, folds, center = cells.grid_of(cuts), sorted(by_fold), _center(by_fold)
    n, models, per = math.prod(sizes), _models(cuts, by_fold, feats, candidates, holdouts), len(holdouts)
    strides = [math.prod(sizes[j + 1:]) for j in range(len(sizes))]
    cell = reduce(lambda a, b: a + b, [F.col("bins")[j] * k for j, k in enumerate(strides)])
    fold = (F.array_position(F.array(*[F.lit(k) for k in folds]), F.col("fold")) - 1).cast("int")
    rows = rows.select((fold * n + cell).alias("slot"), (F.col("y") - center).alias("y"), "key")
    rows = materialize(rows.repartitionByRange("slot", "key").sortWithinPartitions("slot"), "search-rows")
    y = F.col("y")
    total = rows.groupBy("slot").agg(F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")).toArrow()
    slot = total["slot"].to_numpy()
    there = np.unique(slot % n)                     # the cells that have rows
    place = lambda slot: slot // n * len(there) + np.searchsorted(there, slot % n)
    held = np.zeros((3, len(folds) * len(there)))
    for power, c in enumerate("nsq"):
        held[power, place(slot)] = total[c].to_numpy()
    held = held.reshape(3, len(folds), -1)

    def error(model: Booster, pred: np.ndarray) -> float:
        count, s, q = held[:, folds.index(model.holdout)]
        return math.sqrt(max(0.0, float((count * pred ** 2 - 2 * s * pred + q).sum())) / float(count.sum()))

    for model in models:
        model.score_seen(error(model, np.full(len(there), model.base - center)))
    binned, state, done = cells.bins_of(sizes, there), None, 0
    fields = "trial int, model int, scores array<double>, pred binary"

    while growing := sorted({m // per for m, model in enumerate(models) if model.growing()}):
        size = len(growing) * len(folds) * len(there)
        last = max(int(models[t * per].params["n_estimators"]) for t in growing)
        trees = range(done, min(last, done + max(1, BLOCK_SUMS // size)))
        going = {m: replace(models[m], trees=[None] * done, scores=list(models[m].scores)) for m in range(len(models)) if models[m].growing()}

        def grow(batches: Iterator[pa.RecordBatch], trees=trees, going=going) -> Iterator[pa.RecordBatch]:
            def of_trial(t: int, sums: np.ndarray, preds: dict) -> pa.RecordBatch:
                out = []
                for m in range(t * per, t * per + per):
                    if m not in going:
                        continue
                    model = replace(going[m], trees=list(going[m].trees), scores=list(going[m].scores))
                    pred, seen = preds.get(m, np.full(len(there), model.base - center)), len(model.scores)
                    inside = [f for f, k in enumerate(folds) if k != model.holdout]
                    for b in range(len(trees)):
                        if not model.growing():
                            break
                        drawn = sums[:, b, inside].sum(axis=1)
                        _, values = cell_tree(model, m, pred, drawn if drawn[0].any() else None, binned, bins, seed)
                        pred = pred + values
                        model.trees.append(None)
                        model.score_seen(error(model, pred))
                    out.append({"trial": t, "model": m, "scores": model.scores[seen:], "pred": pred.tobytes()})
                return pa.RecordBatch.from_pylist(out, schema=pa.schema([("trial", pa.int32()), ("model", pa.int32()), ("scores", pa.list_(pa.float64())), ("pred", pa.binary())]))

            now, sums, preds = None, None, {}
            for batch in batches:
                for t, model, pred, slots, counts, parts in zip(*(batch.column(c) for c in ("trial", "model", "pred", "slots", "counts", "sums"))):
                    if t.as_py() != now:
                        if now is not None:
                            yield of_trial(now, sums.reshape(2, len(trees), len(folds), -1), preds)
                        now, sums, preds = t.as_py(), np.zeros((2, len(trees), len(folds) * len(there))), {}
                    if model.as_py() is not None:
                        preds[model.as_py()] = np.frombuffer(pred.as_buffer())
                    else:
                        at = place(np.frombuffer(slots.as_buffer(), np.int32))
                        sums[0][:, at] += np.frombuffer(counts.as_buffer(), np.int32).reshape(len(trees), -1)
                        sums[1][:, at] += np.frombuffer(parts.as_buffer()).reshape(len(trees), -1)
            if now is not None:
                yield of_trial(now, sums.reshape(2, len(trees), len(folds), -1), preds)

        parts = _slot_sums(rows, trees, {t: float(models[t * per].params["subsample"]) for t in growing}, seed)
        if state is not None:
            parts = parts.unionByName(state.where(F.col("trial").isin(growing)).select("trial", "model", "pred"), allowMissingColumns=True)
        else:
            parts = parts.select("*", F.lit(None).cast("int").alias("model"), F.lit(None).cast("binary").alias("pred"))
        # partitions of their own number: by size they would be few, and the growth is the work
        grown = parts.repartition(max(8, 2 * len(growing)), "trial").sortWithinPartitions("trial").mapInArrow(grow, fields)
        state = materialize(grown, "search-models")
        for r in state.select("model", "scores").collect():
            models[r["model"]].trees += [None] * len(r["scores"])
            for score in r["scores"]:
                models[r["model"]].score_seen(score)
        done = trees.stop
    return [model.scores for model in models]


#: The ranges that the reference's trials draw from.
SPACE = {"max_depth": ("int", 3, 9), "learning_rate": ("log", 0.01, 0.3), "min_child_weight": ("int", 1, 7),
         "subsample": ("uniform", 0.6, 1.0), "colsample_bytree": ("uniform", 0.6, 1.0), "gamma": ("log", 1e-8, 1.0),
         "reg_alpha": ("log", 1e-8, 1.0), "reg_lambda": ("log", 1e-8, 1.0)}


def boosted_workflow(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str], fold: str = "fold",
                     n_trials: int = 100, num_boost_round: int = 100, early_stopping_rounds: int = 20,
                     seed: int = 42, batch: int | None = None) -> dict:
    """Search, then a final fit of the best parameters: ``search`` (``boosted_search``'s table), ``best`` (its
    best row) and ``model`` (V6).  Trials stop early on their held-out folds, the final fit on
    fold 0 of the training rows, never on test rows.  With ``batch`` the trials are proposed by the
    Parzen estimator of ``adaptive``, that many grown together; else all are drawn at random and
    grown together."""
    train = BinnedOnce(train)
    rounds = {"n_estimators": num_boost_round, "early_stopping_rounds": early_stopping_rounds}
    if batch is None:
        trials = [c | rounds for c in sample_continuous(SPACE, n_trials, seed)]
        search = boosted_search(train, features, label, key, trials, fold, seed)
    else:
        sampler, trials, tables = ParzenSampler(SPACE, seed), [], []
        while len(trials) < n_trials:
            new = [c | rounds for c in sampler.ask(min(batch, n_trials - len(trials)))]
            table = boosted_search(train, features, label, key, new, fold, seed)
            for row in table.orderBy("candidate").collect():
                sampler.tell({k: new[row["candidate"]][k] for k in SPACE}, row["mean_r2"])
            tables.append(table.withColumn("candidate", F.col("candidate") + len(trials)))
            trials += new
        search = reduce(DataFrame.unionByName, tables)
    best = best_of(search).first()
    model = fit_boosted(train, features, label, key, [trials[best["candidate"]]], fold, [0], seed=seed)[0][0]
    return {"search": search, "best": best, "model": model}


def boosted_search(data: DataFrame | BinnedOnce, features: Sequence[str], label: str, key: Sequence[str], candidates: Sequence[dict],
                   fold: str = "fold", seed: int = 42) -> DataFrame:
    """``(candidate, params, trees, mean_r2, std_r2)``: each candidate's held-out R^2 over the folds."""
    _known(candidates)
    feats, rows = list(features), []
    binned, cuts, bins, by_fold = binned_rows(data, feats, label, key, fold, MAX_BINS)
    folds = {k: r["v"] for k, r in by_fold.items()}
    ks = sorted(folds)
    if cells.grid_of(cuts):
        scores = _scores_on_cells(binned, cuts, bins, by_fold, feats, candidates, ks, seed)
    else:
        scores = [m.scores for models in grow_boosted(binned, cuts, bins, by_fold, feats, candidates, ks, seed) for m in models]
    for j, params in enumerate(candidates):
        of_folds = scores[j * len(ks):(j + 1) * len(ks)]
        best = [int(np.argmin(s)) if params.get("early_stopping_rounds") else len(s) - 1 for s in of_folds]
        r2 = [1.0 - s[b] ** 2 / folds[k] if folds[k] else None for s, b, k in zip(of_folds, best, ks)]
        whole = None not in r2
        rows.append((j, {k: str(v) for k, v in params.items()}, float(np.mean(best)),
                     float(np.mean(r2)) if whole else None, float(np.std(r2)) if whole else None))
    return binned.sparkSession.createDataFrame(
        rows, "candidate int, params map<string,string>, trees double, mean_r2 double, std_r2 double")
