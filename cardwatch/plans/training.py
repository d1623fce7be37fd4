"""Cross-validation, out-of-fold scores, tuning and final fits."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.adaboost import stump_model
from cardwatch.learners.boosting import HistogramBoosterModel, Trial, as_rows, class_weighted, fit_side_by_side, out_of_fold
from cardwatch.learners.zoo import LEARNERS, Learner, Setting, notebook_variant
from cardwatch.operators.evaluate import fold_mean_metrics, threshold_predict
from cardwatch.operators.folds import stratified_folds
from cardwatch.plans.sampler import propose
from cardwatch.schema import ID, LABEL
from cardwatch.session import settle, settled


def assembler(features: list[str], with_missing: bool = False) -> VectorAssembler:
    """Inputs as one vector in a fixed column order; a missing value is NaN, or an error."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep" if with_missing else "error")


def feature_matrix(df: DataFrame, features: list[str], with_missing: bool = False) -> DataFrame:
    """Model inputs as one vector in a fixed column order, next to id and label."""
    return assembler(features, with_missing).transform(df)


def training_table(train: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """The engineered train rows with their folds, written once and read by every fit."""
    return settle(stratified_folds(train, k, seed), partition_by=["fold"])


def class_counts(folded: DataFrame) -> dict[int, tuple[int, int]]:
    """(negatives, positives) per fold: k rows."""
    rows = folded.groupBy("fold").agg(
        F.count_if(F.col(LABEL) == 0).alias("n0"), F.count_if(F.col(LABEL) == 1).alias("n1")
    )
    return {r["fold"]: (r["n0"], r["n1"]) for r in rows.collect()}


def class_weights(learner: Learner, n0: int, n1: int) -> tuple[float, float]:
    """Weights of the two classes in ``n0`` and ``n1`` rows."""
    if learner.weighting is None:
        return 1.0, 1.0
    if n0 == 0 or n1 == 0:
        raise ValueError("class weights need both classes")
    if learner.weighting == "balanced":
        return (n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1)
    return 1.0, n0 / n1


def fit(learner: Learner, params: dict, train: DataFrame, features: list[str], n0: int, n1: int) -> PipelineModel:
    """Assemble, scale if the learner asks for it, weight the classes, fit."""
    by_class = class_weights(learner, n0, n1)
    stages = [assembler(features, with_missing=learner.preset is not None)]
    column = "features"
    if learner.scaled:
        column = "scaled_features"
        stages += population_scaler("features", column, n0 + n1, len(features))
    setting = Setting(len(features), n0 * by_class[0] + n1 * by_class[1], column, by_class)
    stages.append(learner.build(params, setting))
    weighted = train.withColumn("weight", F.when(F.col(LABEL) == 1, by_class[1]).otherwise(by_class[0]))
    return Pipeline(stages=stages).fit(weighted)


def population_scaler(inputs: str, output: str, rows: int, width: int) -> list:
    """Stages that z-score a vector by the population deviation; the built-in one divides by the sample deviation."""
    ratio = math.sqrt(rows / max(1, rows - 1))
    return [
        StandardScaler(inputCol=inputs, outputCol=f"{output}_sample", withMean=True, withStd=True),
        ElementwiseProduct(inputCol=f"{output}_sample", outputCol=output, scalingVec=Vectors.dense([ratio] * width)),
    ]


def positive_score(scored: DataFrame) -> Column:
    """Probability of class 1; without one the decision value, without that the label."""
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in scored.columns:
        return vector_to_array("rawPrediction")[1]
    return F.col("prediction").cast("double")


def score(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    scored = model.transform(df)
    return scored.select(*keep, positive_score(scored).alias("score"), F.col("prediction").cast("int").alias("prediction"))


def oof_predict(
    learner: Learner,
    params: dict,
    folded: DataFrame,
    features: list[str],
    parallelism: int = 4,
    resample: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every row scored by the fold model that did not see it; fold fits run side by side, those of boosters, random trees and perceptrons in the same jobs.

    ``resample`` may add or drop rows before a fold model is fitted; the rows that are scored stay as they are.
    """
    if learner.preset is not None and resample is None:
        scored = boosted_out_of_fold([(learner, params)], folded, features, [ID, LABEL, "fold"])
        value = F.col("scores")[0]
        return scored.select(ID, LABEL, "fold", value.alias("score"), (value > 0.5).cast("int").alias("prediction"))
    if learner.trials_at_once is not None and resample is None:
        scored = linear_out_of_fold(learner, [params], folded, features, [ID, LABEL, "fold"])
        value = F.col("scores")[0]
        return scored.select(ID, LABEL, "fold", value.alias("score"), (value > 0.5).cast("int").alias("prediction"))
    counts = class_counts(folded)
    n0, n1 = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if learner.folds_at_once is not None and resample is None:
        by_class = {f: class_weights(learner, n0 - own[0], n1 - own[1]) for f, own in counts.items()}
        scored = learner.folds_at_once(params, feature_matrix(folded, features), "features", LABEL, [ID, LABEL, "fold"], by_class)
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

    def one(fold: int) -> DataFrame:
        rest = folded.filter(F.col("fold") != fold)
        if resample is not None:
            model = fit_final(learner, params, settle(resample(rest)), features)
            return score(model, folded.filter(F.col("fold") == fold), [ID, LABEL, "fold"])
        model = fit(learner, params, rest, features, n0 - counts[fold][0], n1 - counts[fold][1])
        return score(model, folded.filter(F.col("fold") == fold), [ID, LABEL, "fold"])

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        parts = list(pool.map(inheritable_thread_target(folded.sparkSession)(one), sorted(counts)))
    return reduce(DataFrame.unionByName, parts)


def linear_out_of_fold(learner: Learner, trials: list[dict], folded: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``scores``, one out-of-fold score per trial of a learner whose trials and folds are fitted in the same jobs."""
    counts = class_counts(folded)
    n0, n1 = (sum(c[i] for c in counts.values()) for i in (0, 1))
    weights = {}
    for fold, own in counts.items():
        rest = n0 - own[0], n1 - own[1]
        by_class = class_weights(learner, *rest)
        weights[fold] = (*by_class, rest[0] * by_class[0] + rest[1] * by_class[1])
    return learner.trials_at_once(trials, feature_matrix(folded, features), "features", LABEL, keep, weights, learner.scaled)


def boosted_out_of_fold(trials: list[tuple[Learner, dict]], folded: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``scores``, one out-of-fold score per booster with its parameters."""
    counts = class_counts(folded)
    n0, n1 = (sum(c[i] for c in counts.values()) for i in (0, 1))
    made = [
        Trial(learner.preset, params, {f: class_weights(learner, n0 - own[0], n1 - own[1]) for f, own in counts.items()})
        for learner, params in trials
    ]
    return out_of_fold(feature_matrix(folded, features, with_missing=True), "features", LABEL, keep, made)


def boosted_models(trials: list[tuple[Learner, dict]], train: DataFrame, features: list[str]) -> list[PipelineModel]:
    """Boosters with their parameters, fitted on all rows side by side."""
    vectors = assembler(features, with_missing=True)
    n0, n1 = train.agg(F.count_if(F.col(LABEL) == 0), F.count_if(F.col(LABEL) == 1)).first()
    fits = [class_weighted(params, learner.preset, class_weights(learner, n0, n1)) for learner, params in trials]
    rows = as_rows(vectors.transform(train), "features", LABEL, fold=F.lit(-1))
    made = []
    for (learner, _), found in zip(trials, fit_side_by_side(rows, fits)):
        if learner.preset == "adaboost":
            made.append(stump_model(found, "features", LABEL))
        else:
            made.append(HistogramBoosterModel(featuresCol="features", labelCol=LABEL, ensemble=found.to_json()))
    return [PipelineModel([vectors, model]) for model in made]


def cross_validate(
    learner: Learner, params: dict, folded: DataFrame, features: list[str], parallelism: int = 4
) -> DataFrame:
    """F1, precision, recall, accuracy and average precision per fold, averaged: one row."""
    oof = settle(oof_predict(learner, params, folded, features, parallelism))
    return fold_mean_metrics(oof, F.col("prediction"), [])


def tune(
    learner: Learner,
    folded: DataFrame,
    features: list[str],
    *,
    n_trials: int = 20,
    space: dict[str, tuple] | None = None,
    fixed: dict | None = None,
    seed: int = 42,
    parallelism: int = 4,
    side_by_side: int = 5,
    seconds: float | None = None,
    sampler: str = "parzen",
) -> DataFrame:
    """Search for the highest mean-fold F1, by densities of good and bad trials (``parzen``) or at ``random``.

    Trials are proposed in batches of ``side_by_side`` and run together, a booster's in the same jobs. What is proposed depends on the
    seed and on finished batches only, so the same seed gives the same trials. After ``seconds`` no batch is begun. One row
    per trial, in trial order. A trial whose fit fails scores 0 and carries its error.
    """
    rng, began = random.Random(seed), time.monotonic()
    space = space or learner.script_space
    rows, finished = [], []
    while len(rows) < n_trials and (seconds is None or not rows or time.monotonic() - began < seconds):
        size = min(side_by_side, n_trials - len(rows))
        known = finished if sampler == "parzen" else []
        drawn = [propose(space, known, rng) for _ in range(size)]
        trials = [params | (fixed or {}) for params in drawn]
        for params, tried, (f1, error) in zip(drawn, trials, _scores_of(learner, trials, folded, features, parallelism)):
            finished.append((params, f1))
            rows.append((len(rows), json.dumps(tried), float(f1), error))
    return folded.sparkSession.createDataFrame(rows, "trial int, params string, mean_f1 double, error string")


def _scores_of(
    learner: Learner, trials: list[dict], folded: DataFrame, features: list[str], parallelism: int
) -> list[tuple[float, str | None]]:
    """(mean-fold F1, error) of each trial."""
    if learner.preset is not None or learner.trials_at_once is not None:
        try:
            keep = [LABEL, "fold"]
            if learner.preset is not None:
                scored = boosted_out_of_fold([(learner, params) for params in trials], folded, features, keep)
            else:
                scored = linear_out_of_fold(learner, trials, folded, features, keep)
            with settled(scored) as oof:
                long = oof.select(LABEL, "fold", F.posexplode("scores").alias("trial", "score"))
                means = fold_mean_metrics(long, (F.col("score") > 0.5).cast("int"), ["trial"])
                f1 = {r["trial"]: r["mean_f1"] for r in means.collect()}
                return [(f1[k], None) for k in range(len(trials))]
        except (IllegalArgumentException, ValueError) as failure:
            if len(trials) == 1:
                return [(0.0, str(failure))]
            return [_scores_of(learner, [params], folded, features, parallelism)[0] for params in trials]

    def one(params: dict) -> tuple[float, str | None]:
        try:
            with settled(oof_predict(learner, params, folded, features, parallelism)) as oof:
                return fold_mean_metrics(oof, F.col("prediction"), []).first()["mean_f1"], None
        except (IllegalArgumentException, ValueError) as failure:
            # Parameters that cannot be fitted. Anything else, such as a lost executor, ends the search.
            return 0.0, str(failure)

    with ThreadPoolExecutor(max_workers=max(1, len(trials))) as pool:
        return list(pool.map(inheritable_thread_target(folded.sparkSession)(one), trials))


def best_params(trials: DataFrame) -> dict:
    """Parameters of the first trial of maximal F1 among those that could be fitted."""
    best = trials.filter(F.col("error").isNull()).orderBy(F.desc("mean_f1"), "trial").first()
    if best is None:
        raise ValueError("no trial could be fitted")
    return json.loads(best["params"])


def fit_final(learner: Learner, params: dict, train: DataFrame, features: list[str]) -> PipelineModel:
    """Refit on all train rows."""
    counts = train.agg(F.count_if(F.col(LABEL) == 0), F.count_if(F.col(LABEL) == 1)).first()
    return fit(learner, params, train, features, counts[0], counts[1])


def score_test(model: PipelineModel, test: DataFrame) -> DataFrame:
    return score(model, test, [ID])


def predictions(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """(id, label): the model's own class, or the score against a threshold."""
    label = F.col("prediction") if threshold is None else threshold_predict(F.col("score"), threshold)
    return scored.select(ID, label.cast("int").alias(LABEL))


def learner(name: str, preset: str = "script") -> Learner:
    """A learner by name, in one of the two presets: ``script`` or ``notebook``."""
    if preset == "notebook":
        return notebook_variant(LEARNERS[name])
    return LEARNERS[name]
