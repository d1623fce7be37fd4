"""Random Fourier features: a map after which a linear classifier decides as one with a radial kernel.

The map is a projection, drawn by a seed and not from the data. Only the kernel's width may depend on them, through one aggregate: the
variance over all entries. So the map costs the same per row at any size, and needs neither a sample nor a kernel matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.binning import matrix


def waves(width: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (width, size) and phases of cosines whose products average exp(-gamma * squared distance)."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 * gamma), (width, size)), rng.uniform(0.0, 2.0 * np.pi, size)


def mapped(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    return np.sqrt(2.0 / len(phases)) * np.cos(x @ directions + phases)


class _MapParams(HasInputCol, HasOutputCol):
    size = Param(Params._dummy(), "size", "number of cosines", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "exponent per squared distance; 0: one over features times variance", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "decides the cosines", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "number of inputs", TypeConverters.toInt)


class RadialKernelMap(Estimator, _MapParams):
    """Fits the width of the kernel, unless it is given. No rows: an error."""

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="mapped", size=256, gamma=0.0, seed=42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="mapped", size=256, gamma=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RadialKernelModel:
        x = vector_to_array(self.getInputCol())
        first = dataset.select(F.size(x)).first()
        if first is None:
            raise ValueError("no rows to fit")
        gamma = self.getOrDefault(self.gamma)
        if gamma <= 0:
            spread = dataset.select(F.explode(x).alias("v")).agg(F.var_pop("v")).first()[0]
            gamma = 1.0 / (first[0] * spread) if spread > 0 else 1.0
        return RadialKernelModel(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), size=self.getOrDefault(self.size), gamma=float(gamma),
            seed=self.getOrDefault(self.seed), width=first[0],
        )


class RadialKernelModel(Model, _MapParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="mapped", size=256, gamma=1.0, seed=42, width=1):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="mapped", size=256, gamma=1.0, seed=42, width=1)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        width, size = get(self.width), get(self.size)
        directions, phases = waves(width, size, get(self.gamma), get(self.seed))

        @F.arrow_udf("array<double>")
        def cosines(lists: pa.Array) -> pa.Array:
            values = mapped(matrix(lists, width), directions, phases) if len(lists) else np.zeros((0, size))
            ends = np.arange(len(values) + 1, dtype=np.int32) * size
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(cosines(vector_to_array(self.getInputCol()))))
