"""``pyspark.ml`` stages for the fitted preparation steps.

They wrap the DataFrame operators of ``veld.operators.encode`` so that preparation and
regressor go into one ``Pipeline`` and persist as one ``PipelineModel``; bounds and fill
values (one per column) are a small JSON param, and category means, one row per category,
are a Parquet table in the stage's folder.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLWritable)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veld.operators import encode


class _State(Params):
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def _state(self):
        return json.loads(self.getOrDefault(self.state))


class QuantileClipper(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fit per-column bounds at quantiles ``(lower, upper)``; NULL stays NULL."""
    lower = Param(Params._dummy(), "lower", "lower quantile per column", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=None, upper=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "QuantileClipperModel":
        cols = self.getInputCols()
        probs = dict(zip(cols, zip(self.getOrDefault(self.lower), self.getOrDefault(self.upper))))
        clip = encode.QuantileClip(probs).fit(df)
        return QuantileClipperModel(inputCols=cols,
                                    state=json.dumps({c: list(b) for c, b in clip.bounds.items()}))


class QuantileClipperModel(Model, HasInputCols, _State, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        clip = encode.QuantileClip({c: (0.0, 1.0) for c in self.getInputCols()})
        clip.bounds = {c: tuple(b) for c, b in self._state().items()}
        return clip.transform(df)


class StatImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill NULL with the column's mode (smallest on ties), exact median or mean."""
    strategy = Param(Params._dummy(), "strategy", "mode | median | mean", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, strategy="mode"):
        super().__init__()
        self._setDefault(strategy="mode")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "StatImputerModel":
        vals = encode.fill_values(df, self.getInputCols(), self.getOrDefault(self.strategy))
        return StatImputerModel(inputCols=self.getInputCols(), state=json.dumps(vals))


class StatImputerModel(Model, HasInputCols, _State, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return encode.apply_fill(df, self._state())


class TargetMeanEncoder(Estimator, HasInputCols, HasLabelCol, DefaultParamsReadable,
                        DefaultParamsWritable):
    """``<col>_encoded`` = mean label per category of the training rows; unseen -> NULL."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label"):
        super().__init__()
        self._setDefault(labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "TargetMeanEncoderModel":
        encoder = encode.TargetEncoder(self.getInputCols(), self.getLabelCol()).fit(df)
        model = TargetMeanEncoderModel(inputCols=self.getInputCols())
        model.mapping = encoder.mapping
        return model


class TargetMeanEncoderModel(Model, HasInputCols, MLReadable, MLWritable):
    """Joins the table of category means, which is saved beside the stage's metadata."""

    mapping: DataFrame | None = None

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return encode.TargetEncoder(self.getInputCols(), "", mapping=self.mapping).transform(df)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.mapping = self.mapping
        return out

    def write(self):
        return _MappingWriter(self)

    @classmethod
    def read(cls):
        return _MappingReader(cls)


class _MappingWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.mapping.write.parquet(f"{path}/mapping")


class _MappingReader(DefaultParamsReader):
    def load(self, path: str) -> TargetMeanEncoderModel:
        model = super().load(path)
        model.mapping = self.sparkSession.read.parquet(f"{path}/mapping")
        return model
