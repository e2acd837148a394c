"""Cross-validation and search of the tree models with all folds binned together (V2, V4).

A fit for each (candidate, fold) of its own would scale, cut at quantiles and write the same rows again
every time.  Here the rows are written once with their bins by the cuts of every fold's training rows,
counted for all folds in the same scans (``veld.plans.ranks``); every fit reads its columns of them.
Where the bins' grid of every fold is small (``veld.plans.cells``) the candidates share the scans too: a tree's draws hang
on its number and the rows alone, so the drawn rows' sums by cell are added up once for each (fold, tree), and the trees of
that number of all candidates are grown on them.  Held-out scores come from the held-out rows' sums by cell.
Features are scaled by each fold's ``StandardScaler`` and a fold's rows are numbered as
``monotonically_increasing_id`` numbers them alone, so trees and scores are those of fits of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veld.plans import boost, cells, forest, tree_stages
from veld.plans.evaluate import regression_metrics
from veld.plans.models import make_regressor
from veld.session import materialize

TREE_KINDS = ("random_forest", "gbt")


def shares_bins(kind: str, candidates: Sequence[dict]) -> bool:
    """Whether all candidates are grown on the same bins."""
    return kind in TREE_KINDS and not any({"validation_col", "scale"} & set(c) for c in candidates)


class FoldBins:
    """The rows of ``data`` with their bins for every held-out fold of ``0..k-1``."""

    def __init__(self, data: DataFrame, features: Sequence[str], label: str, fold: str, k: int, parallelism: int = 8):
        data = data.where(F.col(fold).isNotNull())
        assembler = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error")
        scaler = Pipeline(stages=[assembler, StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)])
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(lambda i: scaler.fit(data.where(F.col(fold) != i)).stages[-1], range(k)))
        shift, std = [m.mean.toArray() for m in fitted], [m.std.toArray() for m in fitted]
        self.names = names = [f"x{j}" for j in range(len(shift[0]))]
        # as the scaler does: a constant feature becomes 0
        self.scales = scales = {i: (shift[i], np.divide(1.0, std[i], out=np.zeros(len(names)), where=std[i] != 0)) for i in range(k)}
        y = F.col(label).cast("double")
        rows = assembler.transform(data).select(F.when(~F.isnan(y), y).alias("y"), F.col(fold).cast("int").alias("fold"), vector_to_array("_raw").alias("x")) \
            .select("y", "fold", *[F.col("x")[j].alias(x) for j, x in enumerate(names)])
        rows = materialize(_numbered(rows, k), "search-rows")
        outside = [F.col("fold") != i for i in range(k)]
        sums = rows.agg(F.count_if(F.col("y").isNull()).alias("gaps"), *[F.count_if(o).alias(f"n{i}") for i, o in enumerate(outside)],
                        *[F.avg(F.when(o, F.col("y"))).alias(f"my{i}") for i, o in enumerate(outside)]).first()
        if sums["gaps"] or not all(sums[f"n{i}"] for i in range(k)):
            raise ValueError("rows lack the label: fill or drop them first" if sums["gaps"] else "no rows to fit")
        self.sums = {i: {"n": sums[f"n{i}"], "my": sums[f"my{i}"]} for i in range(k)}
        folds = [r["fold"] for r in rows.select("fold").distinct().collect()]
        self.cuts = cuts = boost.cuts_of(rows, names, tree_stages.MAX_BINS, True, folds, scales)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
                kept = ["y", "fold", *[f"id{i}" for i in range(k)]]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[boost.bins_array((x - scales[i][0]) * scales[i][1], cuts[i]) for i in range(k)]],
                                                 [*kept, *[f"bins{i}" for i in range(k)]])

        self.rows = materialize(rows.mapInArrow(run, ", ".join(["y double, fold int", *[f"id{i} long" for i in range(k)],
                                                                *[f"bins{i} array<int>" for i in range(k)]])), "search-bins")

    def r2(self, regressor, i: int) -> float | None:
        """Held-out R^2 of fold ``i`` of a model grown on the other folds."""
        train = self.rows.where(F.col("fold") != i).select(F.xxhash64(f"id{i}").alias("key"), F.lit(0).alias("fold"), "y", F.col(f"bins{i}").alias("bins"))
        model = regressor.grown(train, self.cuts[i], max(len(c) for c in self.cuts[i]) + 1, {0: self.sums[i]})
        held = self.rows.where(F.col("fold") == i).select("y", F.col(f"bins{i}").alias("bins"))
        return regression_metrics(model.predicted(held, F.col("bins"), binned=True), "y").first()["r2"]


def _numbered(rows: DataFrame, k: int) -> DataFrame:
    """With ``id0..``: a row's ``monotonically_increasing_id`` among the rows outside each fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << 33
        seen = np.full(k, start, np.int64)
        for batch in batches:
            fold, ids = batch.column("fold").to_numpy(zero_copy_only=False), []
            for i in range(k):
                upto = seen[i] + np.cumsum(fold != i)
                ids.append(pa.array(upto - 1, pa.int64()))
                seen[i] = upto[-1] if len(upto) else seen[i]
            yield pa.RecordBatch.from_arrays([*batch.columns, *ids], [*batch.schema.names, *[f"id{i}" for i in range(k)]])

    return rows.mapInArrow(run, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"id{i} long" for i in range(k)]))


def _chunks(batches: Iterator[pa.RecordBatch], which: Sequence[int], sizes: Sequence[tuple]) -> Iterator[tuple]:
    """``(i, outside, cell, y, key)`` of many rows at a time, for each of these folds."""
    def split(parts: list) -> Iterator[tuple]:
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        y, fold = (table.column(c).to_numpy() for c in ("y", "fold"))
        for i in which:
            yield i, fold != i, cells.cell_of(boost.matrix(table, f"bins{i}"), sizes[i]), y, table.column(f"key{i}").to_numpy()

    parts, n = [], 0
    for batch in batches:
        parts, n = parts + [batch] * bool(batch.num_rows), n + batch.num_rows
        if n >= cells.RUN_ROWS:
            yield from split(parts)
            parts, n = [], 0
    if parts:
        yield from split(parts)


class FoldCells:
    """Growth and scores of candidates on the cells of each fold's grid."""

    def __init__(self, folds: FoldBins, k: int, seed: int):
        self.k, self.seed, self.base = k, seed, [folds.sums[i]["my"] for i in range(k)]
        self.sizes = [cells.grid_of(folds.cuts[i]) for i in range(k)]
        self.bins = [max(len(c) for c in folds.cuts[i]) + 1 for i in range(k)]
        self.rows = folds.rows.select("y", "fold", *[F.xxhash64(f"id{i}").alias(f"key{i}") for i in range(k)], *[f"bins{i}" for i in range(k)])
        cores = self.rows.sparkSession.sparkContext.defaultParallelism
        if self.rows.rdd.getNumPartitions() < cores:          # few rows: the draws are the work
            self.rows = self.rows.repartition(cores)
        self.parts = 4 * cores
        spread = folds.rows.groupBy("fold").agg(F.count("y").alias("n"), F.avg("y").alias("my"), F.var_pop("y").alias("v")).collect()
        self.spread = {r["fold"]: (r["n"], r["v"]) for r in spread}
        self.center = sum(r["n"] * r["my"] for r in spread) / sum(r["n"] for r in spread)
        self.total = self._totals()

    def _totals(self) -> list[np.ndarray]:
        """By cell, of each fold: count and label sum of the rows outside, then count, sum and sum of squares of the label
        less ``center`` of those in it."""
        sizes, center, folds = self.sizes, self.center, range(self.k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros((5, math.prod(s))) for s in sizes]
            for i, out, cell, y, _ in _chunks(batches, folds, sizes):
                for row, rows, weight in ((0, out, None), (1, out, y), (2, ~out, None), (3, ~out, y - center), (4, ~out, (y - center) ** 2)):
                    sums[i][row] += np.bincount(cell[rows], None if weight is None else weight[rows], sums[i].shape[1])
            for i, s in enumerate(sums):
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "part": pa.array([0], pa.int32()), "sums": pa.array([s.tobytes()], pa.binary())})

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for i, sums in cells.summed(batches, "i", "part"):
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "sums": pa.array([sums[0].tobytes()], pa.binary())})

        rows = self.rows.mapInArrow(run, "i int, part int, sums binary").repartition("i").sortWithinPartitions("i").mapInArrow(joined, "i int, sums binary")
        return [np.frombuffer(r["sums"]).reshape(5, -1) for r in sorted(rows.collect(), key=lambda r: r["i"])]

    def _drawn(self, units: Sequence[tuple], weigh) -> DataFrame:
        """One scan: ``(i, number, sums)`` of the drawn rows of each (fold, number) by cell (weight, weighted label)."""
        of = {i: [m for j, m in units if j == i] for i in sorted({i for i, _ in units})}
        sizes = self.sizes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {(i, m): np.zeros((2, math.prod(sizes[i]))) for i, ms in of.items() for m in ms}
            for i, out, cell, y, key in _chunks(batches, list(of), sizes):
                cell, y, key = cell[out], y[out], key[out]
                for m in of[i]:
                    weight = weigh(key, m)
                    s = sums[i, m]
                    s[0] += np.bincount(cell, weight, s.shape[1])
                    s[1] += np.bincount(cell, weight * y, s.shape[1])
            for (i, m), s in sums.items():              # a batch each, so that no batch is large
                if s[0].any():
                    yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "number": pa.array([m], pa.int32()), "sums": pa.array([s.tobytes()], pa.binary())})

        return self.rows.mapInArrow(run, "i int, number int, sums binary")

    def r2(self, i: int, pred: np.ndarray) -> float | None:
        """Held-out R^2 of fold ``i`` from the prediction of each cell."""
        if i not in self.spread or not self.spread[i][1]:
            return None
        n, s, q = self.total[i][2:]
        pred = np.where(n > 0, pred - self.center, 0.0)
        return 1.0 - float((n * pred ** 2 - 2 * s * pred + q).sum()) / (self.spread[i][0] * self.spread[i][1])

    def forests(self, params: Sequence[dict]) -> list[list[float | None]]:
        """Each forest's scores of the folds.  A forest without any draw has equal trees, so one stands for all."""
        sizes, bins, seed, k = self.sizes, self.bins, self.seed, self.k
        plain = [t[:2] for t in self.total]
        grows = [1 if not p["bootstrap"] and p["max_features"] >= len(sizes[0]) else p["n_estimators"] for p in params]
        units = [(i, m) for m in range(max((p["n_estimators"] for p in params if p["bootstrap"]), default=0)) for i in range(k)]
        others = [(i, m) for m in range(max((g for g, p in zip(grows, params) if not p["bootstrap"]), default=0)) for i in range(k)]
        values = {(j, i): np.zeros(math.prod(sizes[i])) for j in range(len(params)) for i in range(k)}
        schema = pa.schema([("i", pa.int32()), ("candidate", pa.int32()), ("sums", pa.binary())])

        def grow(bootstrap: bool):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                binned, added = {}, {}
                for (i, m), sums in _units(batches):
                    if i not in binned:
                        binned[i] = cells.bins_of(sizes[i])
                    for j, p in enumerate(params):
                        if p["bootstrap"] == bootstrap and m < grows[j]:
                            settings = {name: p[name] for name in ("max_depth", "min_samples_leaf", "min_samples_split", "max_features")}
                            value = forest.cell_tree(m, plain[i] if sums is None else sums, binned[i], bins[i], settings, seed)[1]
                            added[j, i] = added.get((j, i), 0.0) + value
                for (j, i), value in added.items():
                    yield pa.RecordBatch.from_pylist([{"i": i, "candidate": j, "sums": value.tobytes()}], schema=schema)
            return run

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, total = None, 0.0
            for batch in batches:
                for i, j, part in zip(*(batch.column(c).to_pylist() for c in ("i", "candidate", "sums"))):
                    if now != (i, j):
                        if now is not None:
                            yield pa.RecordBatch.from_pylist([{"i": now[0], "candidate": now[1], "sums": total.tobytes()}], schema=schema)
                        now, total = (i, j), 0.0
                    total = total + np.frombuffer(part)
            if now is not None:
                yield pa.RecordBatch.from_pylist([{"i": now[0], "candidate": now[1], "sums": total.tobytes()}], schema=schema)

        def add(sums: DataFrame, bootstrap: bool) -> None:
            parts = sums.repartition(self.parts, "number").sortWithinPartitions("number", "i") \
                .mapInArrow(grow(bootstrap), "i int, candidate int, sums binary")
            for r in parts.repartition("i", "candidate").sortWithinPartitions("i", "candidate").mapInArrow(joined, "i int, candidate int, sums binary").collect():
                values[r["candidate"], r["i"]] += np.frombuffer(r["sums"])

        most = max(1, boost.MAX_CELLS // max(math.prod(s) for s in sizes))
        for a in range(0, len(units), most):
            add(self._drawn(units[a:a + most], lambda key, m: forest.times_drawn(key, seed, m).astype(np.float64)), True)
        if others:
            spark = self.rows.sparkSession
            add(spark.createDataFrame([(i, m, None) for i, m in others], "i int, number int, sums binary"), False)
        return [[self.r2(i, values[j, i] / grows[j]) for i in range(k)] for j in range(len(params))]

    def boosted(self, params: Sequence[dict]) -> list[list[float | None]]:
        """Each boosting's scores of the folds: those of one share of the rows grow on the same sums."""
        sizes, bins, seed, k = self.sizes, self.bins, self.seed, self.k
        base, shares = self.base, sorted({float(p["subsample"]) for p in params})
        trees = max(p["n_estimators"] for p in params)
        scores: dict = {}
        schema = pa.schema([("i", pa.int32()), ("candidate", pa.int32()), ("value", pa.binary())])

        def grow(share: float):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for group, sums in cells.summed(batches, "of", "number"):
                    i, j = group % k, group // k
                    binned = cells.bins_of(sizes[i])
                    model = boost.Booster(boost.DEFAULTS | params[j], list(range(len(sizes[i]))), [], base[i])
                    pred = np.full(len(binned), base[i])
                    while model.growing():
                        drawn = sums.get(0 if share >= 1.0 else len(model.trees))
                        pred = pred + boost.cell_tree(model, 0, pred, None if drawn is None else drawn.reshape(2, -1), binned, bins[i], seed)[1]
                        model.trees.append(None)
                    yield pa.RecordBatch.from_pylist([{"i": i, "candidate": j, "value": pred.tobytes()}], schema=schema)
            return run

        for share in shares:
            of = [j for j, p in enumerate(params) if float(p["subsample"]) == share]
            numbers = range(1 if share >= 1.0 else trees)
            most = max(1, boost.MAX_CELLS // (len(numbers) * max(math.prod(s) for s in sizes)))
            for a in range(0, k, most):
                units = [(i, m) for i in range(a, min(k, a + most)) for m in numbers]
                sums = self._drawn(units, lambda key, m, share=share: boost.drawn_rows(key, share, seed, m).astype(np.float64))
                sums = sums.select(F.explode(F.array(*[F.lit(j * k) + F.col("i") for j in of])).alias("of"), "number", "sums")
                for r in sums.repartition(self.parts, "of").sortWithinPartitions("of", "number").mapInArrow(
                        grow(share), "i int, candidate int, value binary").collect():
                    scores[r["candidate"], r["i"]] = self.r2(r["i"], np.frombuffer(r["value"]))
                for j in of:                            # no row drawn: the base for all
                    for i in range(a, min(k, a + most)):
                        scores.setdefault((j, i), self.r2(i, np.full(math.prod(sizes[i]), base[i])))
        return [[scores[j, i] for i in range(k)] for j in range(len(params))]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """From rows sorted by (number, i): ``((i, number), added sums or None)``."""
    now, sums = None, None
    for batch in batches:
        for i, m, part in zip(*(batch.column(c).to_pylist() for c in ("i", "number", "sums"))):
            if (i, m) != now:
                if now is not None:
                    yield now, sums
                now, sums = (i, m), None
            if part is not None:
                part = np.frombuffer(part).reshape(2, -1)
                sums = part if sums is None else sums + part
    if now is not None:
        yield now, sums


def tree_scores(data: DataFrame, kind: str, features: Sequence[str], label: str, candidates: Sequence[dict], fold: str, k: int,
                seed: int = 42, parallelism: int = 8) -> list[tuple[int, float | None]]:
    """``(candidate, r2)`` for every candidate and fold."""
    bins = FoldBins(data, features, label, fold, k, parallelism)
    grown_by = [make_regressor(kind, label="y", seed=seed, **p) for p in candidates]
    grids = [cells.grid_of(bins.cuts[i]) for i in range(k)]
    params = [r.grower_params(len(bins.names)) for r in grown_by]
    if all(grids) and (kind == "random_forest" or max(p["n_estimators"] for p in params) * max(map(math.prod, grids)) <= boost.MAX_CELLS):
        on_cells = FoldCells(bins, k, seed)
        scores = on_cells.forests(params) if kind == "random_forest" else on_cells.boosted(params)
        return [(j, r2) for j, of_folds in enumerate(scores) for r2 in of_folds]
    jobs = [(j, i) for j in range(len(candidates)) for i in range(k)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(zip([j for j, _ in jobs], pool.map(lambda job: bins.r2(grown_by[job[0]], job[1]), jobs)))
