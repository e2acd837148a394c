"""Random forest and gradient-boosted trees as ``pyspark.ml`` stages that scale with the rows.

They fit what Spark ML's ``RandomForestRegressor`` and ``GBTRegressor`` fit from the same parameters,
on the growers of ``veld.plans.forest`` and ``veld.plans.boost``: where the bins' grid is small, a scan adds
up the drawn rows of every tree by cell, so the number of scans of the rows depends neither on depth nor on
trees.  Without draws (no bootstrap or subsample, all features) the trees are Spark ML's if features have at
most ``MAX_BINS`` values; drawn rows and features come from a hash of seed, tree and row number or node.

* A forest's tree takes each row Poisson(1) times; a node's features are drawn for it, the share rounded up.
* Boosting begins with a whole tree on the label; each further tree fits twice the residual (the gradient
  of the squared error) and is added times the learning rate.
* Importances: the fall of the sum of squares by feature, of each tree of a forest as shares.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsReadable, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veld.plans import boost, cells, forest

#: Bins of a feature: Spark ML's default.
MAX_BINS = 32
TREE_FIELDS = "tree int, depth int, scale double, feature array<int>, cut array<int>, left array<int>, value array<double>, gain array<double>"


def features_of(strategy, p: int) -> int:
    """How many of ``p`` features a node draws."""
    named = {"all": p, "sqrt": math.ceil(math.sqrt(p)), "log2": max(1, math.ceil(math.log2(p))), "onethird": math.ceil(p / 3)}
    if strategy in named:
        return named[strategy]
    return min(p, max(1, int(strategy) if str(strategy).isdigit() else math.ceil(float(strategy) * p)))


class _TreeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    kind = Param(Params._dummy(), "kind", "forest | boosted", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "parameters of the grower as JSON", TypeConverters.toString)


class TreesRegressor(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """``kind`` forest: ``n_estimators, max_depth, min_samples_leaf, max_features, bootstrap``; boosted:
    ``n_estimators, max_depth, learning_rate, subsample, colsample_bynode, min_child_weight``."""

    @keyword_only
    def __init__(self, *, kind=None, settings=None, featuresCol="features", labelCol="label", predictionCol="prediction", seed=42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TreesRegressorModel:
        xs = vector_to_array(self.getFeaturesCol())
        first = df.select(F.size(xs)).first()
        if first is None:
            raise ValueError("no rows to fit")
        names = [f"x{j}" for j in range(first[0])]
        y = F.col(self.getLabelCol()).cast("double")
        # a row's number stands for it in the draws: equal rows are drawn each for itself
        rows = df.select(xs.alias("x"), F.when(~F.isnan(y), y).alias("y"), F.monotonically_increasing_id().alias("row")) \
            .select("row", "y", *[F.col("x")[j].alias(x) for j, x in enumerate(names)])
        return self.grown(*boost.binned_rows(rows, names, "y", ["row"], None, MAX_BINS, True))

    def grower_params(self, p: int) -> dict:
        """The settings as the growers take them for ``p`` features."""
        settings = json.loads(self.getOrDefault(self.settings))
        no_split = settings["max_depth"] == 0
        if self.getOrDefault(self.kind) == "forest":
            return settings | {"max_features": features_of(settings["max_features"], p), "min_samples_split": math.inf if no_split else 2}
        rate = settings.pop("learning_rate")
        return settings | {"learning_rate": 2 * rate, "first_rate": 1.0, "reg_lambda": 0.0, "gamma": math.inf if no_split else 0.0}

    def grown(self, state: DataFrame, cuts: list, bins: int, by_fold: dict) -> TreesRegressorModel:
        """The model of rows binned before (``boost.binned_rows``)."""
        seed, names = self.getSeed(), [f"x{j}" for j in range(len(cuts))]
        params = self.grower_params(len(names))
        if self.getOrDefault(self.kind) == "forest":
            grown = forest.grow_forest(state, cuts, bins, names, **params, seed=seed)
            trees = [(t.depth, 1.0, *t.arrays(), np.array(t.gain)) for t in grown.trees]
            base, shared = 0.0, 1.0 / len(trees)
        else:
            grown = boost.grow_boosted(state, cuts, bins, by_fold, names, [params], seed=seed)[0][0]
            # the first tree fits the label, the others twice the residual, whose sum of squares falls four times as far
            trees = [(grown.depth, 4.0 if m else 1.0, t.feature, t.cut, 2 * np.arange(len(t.feature)) + 1, t.value, 2 * t.gain)
                     for m, t in enumerate(grown.trees)]
            base, shared = grown.base, 1.0
        model = TreesRegressorModel(kind=self.getOrDefault(self.kind), featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
                                    state=json.dumps({"base": base, "share": shared, "cuts": [c.tolist() for c in grown.cuts]}))
        model.trees = trees
        return model


class TreesRegressorModel(Model, _TreeParams, MLReadable, MLWritable):
    """Predicts ``base`` plus ``share`` of the sum of the trees' values; the trees are saved as a table beside the metadata."""
    state = Param(Params._dummy(), "state", "base, share and cuts as JSON", TypeConverters.toString)
    #: (depth, scale of the gains, feature, cut, left child, value, gain) of each tree
    trees: list | None = None

    @keyword_only
    def __init__(self, *, kind=None, state=None, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.predicted(df, vector_to_array(self.getFeaturesCol()))

    def predicted(self, df: DataFrame, values: Column, binned: bool = False) -> DataFrame:
        """``df`` with predictions from an array of the features, or of their bins."""
        state = json.loads(self.getOrDefault(self.state))
        cuts, base, shared, trees = [np.array(c) for c in state["cuts"]], state["base"], state["share"], [(t[0], t[2:6]) for t in self.trees]

        def of_bins(bins: np.ndarray) -> np.ndarray:
            return base + shared * sum((t[3][forest.node_of(t, bins, depth)] for depth, t in trees), np.zeros(len(bins)))

        @F.arrow_udf("double")
        def score(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
            look = cells.lookup(cells.grid_of(cuts), of_bins)
            for x in arrays:
                x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts))
                yield pa.array(look(x if binned else np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])))

        return df.withColumn(self.getPredictionCol(), score(values))

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        total = np.zeros(len(json.loads(self.getOrDefault(self.state))["cuts"]))
        for _, scale, feature, _, _, _, gain in self.trees:
            split = feature >= 0
            one = scale * np.bincount(feature[split], gain[split], len(total))
            total += one / one.sum() if self.getOrDefault(self.kind) == "forest" and one.sum() else one
        return DenseVector(total / total.sum() if total.sum() else total)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.trees = self.trees
        return out

    def write(self):
        return _TreesWriter(self)

    @classmethod
    def read(cls):
        return _TreesReader(cls)


class _TreesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        rows = [(m, int(depth), float(scale), *(a.tolist() for a in arrays)) for m, (depth, scale, *arrays) in enumerate(self.instance.trees)]
        self.sparkSession.createDataFrame(rows, TREE_FIELDS).write.parquet(f"{path}/trees")


class _TreesReader(DefaultParamsReader):
    def load(self, path: str) -> TreesRegressorModel:
        model = super().load(path)
        model.trees = [(r["depth"], r["scale"], *(np.array(r[c]) for c in ("feature", "cut", "left", "value", "gain")))
                       for r in self.sparkSession.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return model
