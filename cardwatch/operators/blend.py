"""Blending of model scores and choice among logged models."""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.ratios import f1
from cardwatch.operators.evaluate import confusion_counts, threshold_predict
from cardwatch.schema import ID, LABEL

ENSEMBLE_NAME = "Ensemble_SoftVoting"


def weighted_blend(weights: dict[str, float]) -> Column:
    """Weighted mean of score columns."""
    total = sum(weights.values())
    weighted = [F.col(m) * F.lit(float(w)) for m, w in weights.items()]
    return sum(weighted[1:], weighted[0]) / F.lit(float(total))


def weight_trials(n: int, members: int, seed: int = 42) -> list[list[float]]:
    """Seeded uniform weight vectors."""
    draw = random.Random(seed)
    return [[draw.random() for _ in range(members)] for _ in range(n)]


# Room for the rounding of a weighted mean around one half.
_SLACK = 1e-9


def search_weights(oof: DataFrame, members: list[str], trials: list[list[float]], label: str = LABEL) -> DataFrame:
    """F1 at 0.5 of every weight vector over the out-of-fold table.

    A weighted mean lies between the lowest and the highest member score, so rows whose members
    agree on a side of 0.5 count the same for every vector. Only the rows they dispute are scored
    vector by vector, and only the hits among those are counted. A vector that sums to zero scores 0.
    """
    positive = F.col(label) == 1
    lowest, highest = F.least(*members), F.greatest(*members)
    agreed = lowest >= 0.5 + _SLACK
    shared = oof.agg(
        F.struct(
            F.count_if(positive).alias("n_pos"),
            F.count_if(agreed & positive).alias("tp"),
            F.count_if(agreed & ~positive).alias("fp"),
        )
    ).scalar()

    totals = [sum(w) for w in trials]
    # One literal for all vectors: JSON keeps doubles exactly, and parsing it folds into a constant.
    fields = ["trial int", *[f"{m} double" for m in members], "total double"]
    listed = [
        {"trial": i, **dict(zip(members, w, strict=True)), "total": t}
        for i, (w, t) in enumerate(zip(trials, totals, strict=True))
        if t > 0
    ]
    vectors = F.from_json(F.lit(json.dumps(listed)), f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in fields)}>>")

    def hits(vector: Column) -> Column:
        weighted = [F.col(m) * vector[m] for m in members]
        return sum(weighted[1:], weighted[0]) / vector["total"] >= 0.5

    disputed = oof.filter((highest >= 0.5 - _SLACK) & ~agreed)
    counted = (
        disputed.select(label, F.explode(F.filter(vectors, hits)).alias("vector"))
        .groupBy(F.col("vector.trial").alias("trial"))
        .agg(F.count_if(positive).alias("tp"), F.count_if(~positive).alias("fp"))
    )
    shares = [(i, t, *[w_ / t if t > 0 else 0.0 for w_ in w]) for i, (w, t) in enumerate(zip(trials, totals, strict=True))]
    names = [f"w_{m}" for m in members]
    schema = ", ".join(["trial int", "total double", *[f"{n} double" for n in names]])
    table = oof.sparkSession.createDataFrame(shares, schema)
    tp = F.coalesce(F.col("tp"), F.lit(0)) + F.col("shared.tp")
    fp = F.coalesce(F.col("fp"), F.lit(0)) + F.col("shared.fp")
    score = F.when(F.col("total") > 0, f1(tp, fp, F.col("shared.n_pos") - tp)).otherwise(0.0)
    return (
        table.withColumn("shared", shared).join(counted, "trial", "left").select("trial", *names, score.alias("f1"))
    )


#: Ends the log name of a model's means over folds; the plain name has the metrics over all rows at once.
FOLD_MEAN = " (mean of folds)"


def best_trial(trials: DataFrame) -> DataFrame:
    """The first trial of maximal F1."""
    best = F.max_by(F.struct(*trials.columns), F.struct(F.col("f1"), -F.col("trial")))
    return trials.agg(best.alias("best")).select("best.*")


def soft_vote(scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted probability and its arg-max class; exactly one half stays class 0."""
    voted = scores.withColumn("vote_score", weighted_blend(weights))
    return voted.select(ID, "vote_score", threshold_predict(F.col("vote_score"), 0.5, "above").alias("prediction"))


def latest_runs(log: DataFrame) -> DataFrame:
    """The last run of every model."""
    columns = [F.col(c) for c in log.columns]
    last = log.groupBy("Model_Name").agg(F.max_by(F.struct(*columns), "run_seq").alias("last"))
    return last.select("last.*")


def leaderboard(log: DataFrame) -> DataFrame:
    """Last runs ranked by F1, ties by name. One row per model name, so one small sort."""
    ranking = Window.orderBy(F.desc("CV_F1_Score"), "Model_Name")
    return latest_runs(log).select(
        F.row_number().over(ranking).alias("Rank"),
        "Model_Name",
        "CV_F1_Score",
        "CV_Precision",
        "CV_Recall",
        "CV_PR_AUC",
        "CV_Accuracy",
    )


def pick_top_models(log: DataFrame, k: int = 5) -> DataFrame:
    """The best ``k`` single models, without the ensemble and without rows of fold means."""
    single = latest_runs(log).filter((F.col("Model_Name") != ENSEMBLE_NAME) & ~F.col("Model_Name").endswith(FOLD_MEAN))
    return single.orderBy(F.desc("CV_F1_Score"), "Model_Name").limit(k).select("Model_Name", "CV_F1_Score")


def pooled_f1(df: DataFrame, predicted: Column, label: str = LABEL) -> DataFrame:
    counts = df.agg(*confusion_counts(predicted, label))
    return counts.select(f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def select_final(oof: DataFrame, test: DataFrame, candidate: Column, incumbent: Column, threshold: float = 0.5) -> DataFrame:
    """Test predictions of the candidate if its F1 is strictly greater, else of the incumbent."""
    better = pooled_f1(oof, threshold_predict(candidate, threshold)).scalar() > pooled_f1(
        oof, threshold_predict(incumbent, threshold)
    ).scalar()
    return test.withColumn("__better", better).select(
        ID,
        F.when(F.col("__better"), threshold_predict(candidate, threshold))
        .otherwise(threshold_predict(incumbent, threshold))
        .alias(LABEL),
    )


def importance_consensus(importances: DataFrame) -> DataFrame:
    """Mean over models of each feature's share of the model's importance.

    Input rows: (model, feature, importance); one per model and feature, so the window is small.
    """
    share = F.col("importance") / F.sum("importance").over(Window.partitionBy("model"))
    return importances.withColumn("share", share).groupBy("feature").agg(F.avg("share").alias("mean_importance"))
