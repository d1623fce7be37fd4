"""Gaussian naive Bayes by aggregation, with variance smoothing."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_statistics(df: DataFrame, features: str, label: str) -> dict[int, tuple[int, list[float], list[float]]]:
    """Per class: row count, means and population variances. One aggregate, one row per class."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col(features))
    found = {}
    for row in df.groupBy(F.col(label).cast("int").alias("c")).agg(summary.alias("s")).collect():
        n = row["s"]["count"]
        shrink = (n - 1) / n
        found[row["c"]] = (n, list(row["s"]["mean"]), [v * shrink for v in row["s"]["variance"]])
    return found


def overall_variances(classes: dict[int, tuple[int, list[float], list[float]]]) -> list[float]:
    """Population variances of all rows, from those of the classes."""
    total = sum(n for n, _, _ in classes.values())
    width = len(next(iter(classes.values()))[1])
    centers = [sum(n * m[i] for n, m, _ in classes.values()) / total for i in range(width)]
    return [
        sum(n * (v[i] + (m[i] - centers[i]) ** 2) for n, m, v in classes.values()) / total for i in range(width)
    ]


def log_likelihood(x: Column, means: list[float], variances: list[float]) -> Column:
    """Log density of independent normals at the array ``x``."""
    squares = F.zip_with(x, F.lit(means), lambda v, m: (v - m) * (v - m))
    scaled = F.zip_with(squares, F.lit([-0.5 / v for v in variances]), lambda d, w: d * w)
    constant = -0.5 * sum(math.log(2.0 * math.pi * v) for v in variances)
    return F.aggregate(scaled, F.lit(constant), lambda total, term: total + term)


class _BayesParams(HasFeaturesCol, HasLabelCol):
    smoothing = Param(
        Params._dummy(), "smoothing", "share of the largest variance added to all", TypeConverters.toFloat
    )


class GaussianNaiveBayes(Estimator, _BayesParams):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", smoothing=1e-9):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> GaussianNaiveBayesModel:
        features, label = self.getFeaturesCol(), self.getLabelCol()
        classes = class_statistics(dataset, features, label)
        if set(classes) != {0, 1}:
            raise ValueError("both classes are needed")
        extra = self.getOrDefault(self.smoothing) * max(overall_variances(classes))
        numbers = [float(classes[0][0]), float(classes[1][0])]
        for c in (0, 1):
            _, means, variances = classes[c]
            numbers += [*means, *[v + extra for v in variances]]
        return GaussianNaiveBayesModel(featuresCol=features, labelCol=label, numbers=numbers)


class GaussianNaiveBayesModel(Model, _BayesParams, DefaultParamsReadable, DefaultParamsWritable):
    numbers = Param(
        Params._dummy(),
        "numbers",
        "class counts, then means and smoothed variances of class 0 and of class 1",
        TypeConverters.toListFloat,
    )

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", numbers=None):
        super().__init__()
        self._setDefault(numbers=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers = self.getOrDefault(self.numbers)
        rest = numbers[2:]
        width = len(rest) // 4
        x = F.col("__x")
        negative = log_likelihood(x, rest[:width], rest[width : 2 * width])
        positive = log_likelihood(x, rest[2 * width : 3 * width], rest[3 * width :])
        odds = positive - negative + F.lit(math.log(numbers[1] / numbers[0]))
        odds = F.greatest(F.least(odds, F.lit(700.0)), F.lit(-700.0))
        return (
            dataset.withColumn("__x", vector_to_array(self.getFeaturesCol()))
            .withColumn("__p", F.lit(1.0) / (F.exp(-odds) + 1.0))
            .withColumns(
                {
                    "probability": array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p"))),
                    "prediction": F.when(F.col("__p") > 0.5, 1.0).otherwise(0.0),
                }
            )
            .drop("__x", "__p")
        )
