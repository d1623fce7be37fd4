"""A support vector classifier, linear or with a radial kernel, with probabilities."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasRegParam, HasWeightCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.kernel_map import RadialKernelMap
from cardwatch.operators.folds import stratified_folds
from cardwatch.schema import ID
from cardwatch.session import settle


class CalibratedSVC(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasRegParam):
    """Margins from a linear SVC, turned into probabilities by a logistic fit on out-of-fold margins.

    With ``waves``, features are mapped to so many cosines first, which stand for a radial kernel. The map is applied in every fit
    anew, and never written.
    """

    folds = Param(Params._dummy(), "folds", "folds of the margin table", TypeConverters.toInt)
    waves = Param(Params._dummy(), "waves", "cosines of the radial kernel; 0: linear", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "exponent of the radial kernel; 0: one over features times variance", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "decides the cosines", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", weightCol="weight", regParam=0.01, maxIter=100, folds=5, waves=0, gamma=0.0,
        seed=42,
    ):
        super().__init__()
        self._setDefault(weightCol="weight", regParam=0.01, maxIter=100, folds=5, waves=0, gamma=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _svc(self, features: str) -> LinearSVC:
        return LinearSVC(
            featuresCol=features,
            labelCol=self.getLabelCol(),
            weightCol=self.getWeightCol(),
            regParam=self.getRegParam(),
            maxIter=self.getMaxIter(),
            standardization=False,
            rawPredictionCol="margins",
            predictionCol="side",
        )

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        k, features = self.getOrDefault(self.folds), self.getFeaturesCol()
        kernel = []
        if self.getOrDefault(self.waves):
            size, gamma, seed = (self.getOrDefault(p) for p in (self.waves, self.gamma, self.seed))
            kernel = [RadialKernelMap(inputCol=features, outputCol="kernel_features", size=size, gamma=gamma, seed=seed).fit(dataset)]
            features = "kernel_features"
        mapped = lambda df: reduce(lambda rows, stage: stage.transform(rows), kernel, df)
        columns = [ID, self.getFeaturesCol(), self.getLabelCol(), self.getWeightCol()]
        # Folds keep the classes' shares, so that none is left without positives while there are k of them.
        dealt = stratified_folds(dataset.select(*columns), k, label=self.getLabelCol()).withColumnRenamed("fold", "part")
        parts = settle(dealt, partition_by=["part"])

        def margins(i: int) -> DataFrame:
            fitted = self._svc(features).fit(mapped(parts.filter(F.col("part") != i)))
            return fitted.transform(mapped(parts.filter(F.col("part") == i))).select("margins", self.getLabelCol())

        with ThreadPoolExecutor(max_workers=k) as pool:
            held_out = reduce(
                DataFrame.unionByName, pool.map(inheritable_thread_target(dataset.sparkSession)(margins), range(k))
            )
        margin = VectorSlicer(inputCol="margins", outputCol="margin", indices=[1])
        calibration = LogisticRegression(featuresCol="margin", labelCol=self.getLabelCol(), regParam=0.0)
        curve = calibration.fit(margin.transform(settle(held_out)))
        return PipelineModel([*kernel, self._svc(features).fit(mapped(dataset)), margin, curve])
