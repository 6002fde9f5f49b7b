"""Radial kernel machines by random Fourier features.

For directions w drawn from a normal law of variance 2 gamma and phases b, the mean of
2 cos(w·x + b) cos(w·y + b) is exp(-gamma |x - y|^2). A linear machine on these cosines is thus a
kernel machine without a kernel matrix: rows stay independent, and the fit is a sum over rows.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tasks get the functions of this module by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GAMMAS = ("scale", "auto")


@lru_cache(maxsize=4)
def directions(size: int, components: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (size x components) and phases; the same wherever they are drawn."""
    draw = np.random.default_rng(seed)
    wide = draw.standard_normal((size, components)) * np.sqrt(2 * gamma)
    return wide, draw.uniform(0, 2 * np.pi, components)


def fourier_features(rows: np.ndarray, components: int, gamma: float, seed: int) -> np.ndarray:
    wide, phases = directions(rows.shape[1], components, gamma, seed)
    found = rows @ wide
    found += phases
    np.cos(found, out=found)
    found *= np.sqrt(2 / components)
    return found


class _Settings(HasInputCol, HasOutputCol, HasSeed):
    components = Param(Params._dummy(), "components", "number of cosines", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel, found by the fit where it is 0", TypeConverters.toFloat)


class FourierFeatures(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Vectors to their random Fourier features; the directions take size x components numbers a task."""

    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        components, gamma, seed = (self.getOrDefault(p) for p in (self.components, self.gamma, self.seed))

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def cosines(rows: pa.Array) -> pa.Array:
            if not len(rows):
                return pa.array([], pa.list_(pa.float64()))
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            found = fourier_features(x, components, gamma, seed)
            offsets = np.arange(0, found.size + 1, components, dtype=np.int32)
            return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(cosines(vector_to_array(self.getInputCol()))))


class RadialFeatures(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Finds gamma from the rows: ``auto`` is 1 / size, ``scale`` divides by the variance as well."""

    rule = Param(Params._dummy(), "rule", "scale or auto", TypeConverters.toString)

    def __init__(self, inputCol=None, outputCol=None, components=512, gamma=0.0, rule="scale", seed=42):
        super().__init__()
        if rule not in GAMMAS:
            raise ValueError(f"gamma is a number or one of {GAMMAS}, not {rule}")
        given = {"components": components, "gamma": gamma, "rule": rule, "seed": seed}
        self._set(**given, **{k: v for k, v in (("inputCol", inputCol), ("outputCol", outputCol)) if v is not None})

    def _fit(self, dataset: DataFrame) -> FourierFeatures:
        gamma = self.getOrDefault(self.gamma)
        if gamma <= 0:
            summary = Summarizer.metrics("mean", "variance", "count").summary(F.col(self.getInputCol()))
            found = dataset.select(summary.alias("s")).select("s.*").first()
            spread = found["variance"].toArray() * (found["count"] - 1) / max(found["count"], 1)
            gamma = 1 / len(spread)
            # columns are taken as centred; rows that are all the same have no scale
            if self.getOrDefault(self.rule) == "scale" and spread.mean() > 0:
                gamma /= spread.mean()
        made = FourierFeatures()
        return made._set(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), components=self.getOrDefault(self.components),
            gamma=float(gamma), seed=self.getOrDefault(self.seed),
        )
