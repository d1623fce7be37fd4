"""Discrete AdaBoost (SAMME) over decision stumps."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.boosting import Ensemble, as_rows, class_weighted, fit_side_by_side
from cardwatch.learners.trees import BranchingTree

Stump = tuple[int, float, float, float]


def votes_positive(x: Column, stump: Stump) -> Column:
    feature, threshold, below, above = stump
    if below == above:
        return F.lit(below == 1.0)
    at_most = x[feature] <= F.lit(threshold)
    return ~at_most if above == 1.0 else at_most


class _BoostParams(HasFeaturesCol, HasLabelCol):
    rounds = Param(Params._dummy(), "rounds", "most boosting rounds", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinks every round's say", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "candidate splits per feature", TypeConverters.toInt)


class AdaBoostStumps(Estimator, _BoostParams):
    """Boosting rounds, each one aggregate over binned features (see ``boosting``)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", rounds=50, learningRate=1.0, maxBins=128):
        super().__init__()
        self._setDefault(maxBins=128)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> AdaBoostModel:
        features, label = self.getFeaturesCol(), self.getLabelCol()
        params = {"n_estimators": self.getOrDefault(self.rounds), "learning_rate": self.getOrDefault(self.learningRate)}
        rows = as_rows(dataset, features, label, fold=F.lit(-1))
        found = fit_side_by_side(rows, [class_weighted(params, "adaboost")], most_cuts=self.getOrDefault(self.maxBins))[0]
        return stump_model(found, features, label)


def stump_model(found: Ensemble, features: str, label: str) -> AdaBoostModel:
    flat = [v for tree in found.trees for v in _stump(tree, found.cuts)]
    return AdaBoostModel(featuresCol=features, labelCol=label, stumps=flat)


def _stump(tree: BranchingTree, cuts: list[list[float]]) -> list[float]:
    """Feature, threshold, class at or below, class above, say."""
    feature = int(tree.feature[0])
    if feature < 0:
        return [0.0, math.inf, *[float(tree.value[0] > 0)] * 2, abs(float(tree.value[0]))]
    below, above = (float(tree.value[side[0]]) for side in (tree.left, tree.right))
    return [float(feature), cuts[feature][tree.cut[0] - 1], float(below > 0), float(above > 0), abs(below)]


class AdaBoostModel(Model, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    stumps = Param(
        Params._dummy(),
        "stumps",
        "five numbers per round: feature, threshold, class at or below, class above, say",
        TypeConverters.toListFloat,
    )

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", stumps=None):
        super().__init__()
        self._setDefault(stumps=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def rounds_used(self) -> list[tuple[Stump, float]]:
        flat = self.getOrDefault(self.stumps)
        return [((int(flat[i]), *flat[i + 1 : i + 4]), flat[i + 4]) for i in range(0, len(flat), 5)]

    def importances(self, n_features: int) -> list[float]:
        """Share of the total say each feature's stumps hold."""
        held = [0.0] * n_features
        for (feature, _, below, above), say in self.rounds_used():
            if below != above:
                held[feature] += say
        whole = sum(held)
        return [h / whole if whole > 0 else 0.0 for h in held]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = F.col("__x")
        used = self.rounds_used()
        whole = sum(say for _, say in used) or 1.0
        decision = F.lit(0.0)
        for stump, say in used:
            decision = decision + F.when(votes_positive(x, stump), say).otherwise(-say)
        positive = F.lit(1.0) / (F.exp(-decision / F.lit(whole)) + 1.0)
        return (
            dataset.withColumn("__x", vector_to_array(self.getFeaturesCol()))
            .withColumn("__p", positive)
            .withColumns(
                {
                    "probability": array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p"))),
                    "prediction": F.when(F.col("__p") > 0.5, 1.0).otherwise(0.0),
                }
            )
            .drop("__x", "__p")
        )
