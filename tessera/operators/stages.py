"""Stages of Spark ML pipelines: winsorising and z-scores whose fitted numbers are saved and loaded with the model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .research import STD_FLOOR, WinsorZScore

FITTED = ("lows", "mids", "highs", "means", "deviations")


class _Shared(HasInputCols):
    zscore = Param(Params._dummy(), "zscore", "fill nulls by the median and give z-scores, or only winsorise", TypeConverters.toBoolean)


class Winsor(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Fits quantiles, medians, means and deviations of columns; each is null-safe and replaced where it stands."""

    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=0.01, upper=0.99, zscore=True):
        super().__init__()
        self._setDefault(lower=0.01, upper=0.99, zscore=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> WinsorModel:
        cols = self.getInputCols()
        z = self.getOrDefault(self.zscore)
        row = WinsorZScore(tuple(cols), self.getOrDefault(self.lower), self.getOrDefault(self.upper), z).fit(dataset).fitted.first()  # one row
        of = lambda k: [float("nan") if row[f"_{c}_{k}"] is None else float(row[f"_{c}_{k}"]) for c in cols]
        return WinsorModel()._set(inputCols=cols, zscore=z, **{name: of(k) for name, k in zip(FITTED, ("lo", "mid", "hi", "mean", "std"), strict=True)})


class WinsorModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """What was fitted, a number a column each; NaN where the training rows had no value, which gives nulls."""

    lows, mids, highs, means, deviations = (Param(Params._dummy(), n, f"fitted {n}, by column", TypeConverters.toListFloat) for n in FITTED)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        z, out = self.getOrDefault(self.zscore), {}
        for c, lo, mid, hi, mean, std in zip(self.getInputCols(), *(self.getOrDefault(self.getParam(n)) for n in FITTED), strict=True):
            if lo != lo:
                out[c] = F.lit(None).cast("double")
                continue
            x = F.coalesce(F.col(c).cast("double"), F.lit(mid)) if z else F.col(c).cast("double")
            x = F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(hi)), F.lit(lo)))
            out[c] = (x - mean) / (std if std > STD_FLOOR else 1.0) if z else x
        return dataset.withColumns(out)
