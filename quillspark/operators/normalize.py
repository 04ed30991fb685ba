"""Fitted normalisers as a pyspark.ml estimator and model."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.normal import normal_cdf
from quillspark.schemas import normalized_column

METHODS = ("z_score", "min_max")


def fit_statistics(df: DataFrame, columns: list[str], method: str) -> DataFrame:
    """One row with the two fitted values of each column, in one pass."""
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    low, high = (F.min, F.max) if method == "min_max" else (F.avg, F.stddev_samp)
    pairs = []
    for name in columns:
        value = F.col(f"`{name}`").cast("double")
        pairs += [low(value).alias(f"a_{name}"), high(value).alias(f"b_{name}")]
    return df.agg(*pairs)


def scaled(name: str, a: Column, b: Column, capped: bool) -> Column:
    """Min-max scaling; a column without spread gives 0."""
    value = F.coalesce(F.try_divide(F.col(f"`{name}`").cast("double") - a, b - a), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)) if capped else value


def with_normal_score(df: DataFrame, name: str, a: Column, b: Column) -> DataFrame:
    """z-score mapped through the normal distribution; a column without spread gives 0.5."""
    z = F.coalesce(F.try_divide(F.col(f"`{name}`").cast("double") - a, b), F.lit(0.0))
    scored = df.withColumn("_z", z)
    return scored.withColumn(normalized_column(name), normal_cdf("_z")).drop("_z")


class _HasColumns(Params):
    columns = Param(Params._dummy(), "columns", "columns to normalise", TypeConverters.toListString)
    method = Param(Params._dummy(), "method", "z_score or min_max", TypeConverters.toString)


class Normalizer(Estimator, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits mean and deviation (or minimum and maximum) of several columns in one aggregate."""

    @keyword_only
    def __init__(self, *, columns=None, method="z_score"):
        super().__init__()
        self._setDefault(method="z_score")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> NormalizerModel:
        names, method = self.getOrDefault("columns"), self.getOrDefault("method")
        row = fit_statistics(dataset, names, method).first()
        fitted = {n: [row[f"a_{n}"], row[f"b_{n}"]] for n in names}
        return NormalizerModel(columns=names, method=method, fitted=json.dumps(fitted))


class NormalizerModel(Model, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Applies fitted values; new data is capped to the fitted range (``capped=False`` for
    the training data itself, where it makes no difference)."""

    fitted = Param(Params._dummy(), "fitted", "fitted pairs as JSON", TypeConverters.toString)
    capped = Param(Params._dummy(), "capped", "cap to [0, 1]", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, columns=None, method=None, fitted=None, capped=True):
        super().__init__()
        self._setDefault(capped=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = json.loads(self.getOrDefault("fitted"))
        out = dataset
        for name in self.getOrDefault("columns"):
            a, b = (F.lit(v).cast("double") for v in fitted[name])
            if self.getOrDefault("method") == "min_max":
                value = scaled(name, a, b, self.getOrDefault("capped"))
                out = out.withColumn(normalized_column(name), value)
            else:
                out = with_normal_score(out, name, a, b)
        return out
