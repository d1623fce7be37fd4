"""Metrics, curves and thresholds over scored rows.

Scored rows are long: one row per (model, transaction) with a label and a score. ``by`` names the
columns that keep models (or folds) apart.

A missing score (null or NaN) is below every score: no threshold is reached, and curves count the row last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.ratios import f1, percent, precision, ratio_or_zero, recall
from cardwatch.functions.running import running_sums, score_bucket
from cardwatch.operators.quality import long_row
from cardwatch.schema import LABEL

# The threshold grid is 0.01 + i * 0.01, i = 0..98, in double arithmetic.
GRID_STEP = 0.01
GRID_SIZE = 99

# The named decision strategies.
STANDARD = ("Standard (0.5)", 0.5)
AGGRESSIVE = ("Aggressive (0.3)", 0.3)


def long_scores(wide: DataFrame, models: list[str], keep: list[str]) -> DataFrame:
    """One score column per model -> one row per model.

    Inlined rather than unpivoted: two readers of an unpivot do not share its shuffle.
    """
    pairs = [F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models]
    return wide.select(*keep, F.inline(F.array(*pairs)))


def known(score: Column) -> Column:
    """The score as a double, null where it is missing."""
    return F.nanvl(score.cast("double"), F.lit(None).cast("double"))


def threshold_predict(score: Column, threshold: float | Column = 0.5, mode: str = "at_least") -> Column:
    """1 from the threshold on (``at_least``) or only above it (``above``, the vote's arg-max rule)."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    score = known(score)
    hit = score >= limit if mode == "at_least" else score > limit
    return F.when(hit, 1).otherwise(0)


def confusion_counts(predicted: Column, label: str = LABEL) -> list[Column]:
    y = F.col(label)
    return [
        F.count_if((y == 1) & (predicted == 1)).alias("tp"),
        F.count_if((y == 0) & (predicted == 1)).alias("fp"),
        F.count_if((y == 1) & (predicted == 0)).alias("fn"),
        F.count_if((y == 0) & (predicted == 0)).alias("tn"),
    ]


def confusion_matrix(df: DataFrame, predicted: Column, by: list[str], label: str = LABEL) -> DataFrame:
    """All four cells, zeros included."""
    counts = df.groupBy(*by).agg(*confusion_counts(predicted, label))
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return counts.select(
        *by,
        F.inline(
            F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells])
        ),
    )


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "f1": f1(tp, fp, fn),
        "precision": precision(tp, fp),
        "recall": recall(tp, fn),
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
    }


def pooled_metrics(df: DataFrame, predicted: Column, by: list[str], label: str = LABEL) -> DataFrame:
    """F1, precision, recall and accuracy over all rows of a group; 0 where a denominator is 0."""
    counts = df.groupBy(*by).agg(*confusion_counts(predicted, label))
    metrics = rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return counts.select(*by, *[c.alias(n) for n, c in metrics.items()])


def fold_mean_metrics(df: DataFrame, predicted: Column, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """Every metric per fold, then averaged over the folds."""
    keys = [*by, "fold"]
    per_fold = pooled_metrics(df, predicted, keys, label).join(average_precision(df, keys, score, label), keys)
    names = ["f1", "precision", "recall", "accuracy", "average_precision"]
    return per_fold.groupBy(*by).agg(*[F.avg(n).alias(f"mean_{n}") for n in names])


def classification_report(df: DataFrame, predicted: Column, by: list[str], label: str = LABEL) -> DataFrame:
    """Per-class scores, accuracy, macro and weighted averages."""
    counts = df.groupBy(*by).agg(*confusion_counts(predicted, label))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    fraud = (precision(tp, fp), recall(tp, fn), f1(tp, fp, fn), tp + fn)
    legit = (precision(tn, fn), recall(tn, fp), f1(tn, fn, fp), tn + fp)
    total = tp + fp + fn + tn
    accuracy = ratio_or_zero(tp + tn, total)
    rows = {
        "Legitimate": legit,
        "Fraud": fraud,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": (*[(a + b) / 2 for a, b in zip(legit[:3], fraud[:3], strict=True)], total),
        "weighted avg": (
            *[
                ratio_or_zero(a * legit[3] + b * fraud[3], total)
                for a, b in zip(legit[:3], fraud[:3], strict=True)
            ],
            total,
        ),
    }
    names = ("precision", "recall", "f1", "support")
    items = {r: dict(zip(names, values, strict=True)) for r, values in rows.items()}
    return long_row(counts, by, items, "row_name")


def curve_counts(df: DataFrame, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """Per distinct score: positives and negatives at it and from it upwards, and the group totals.

    Rows first fold into one row per distinct score, so ties cost nothing; the running counts then
    work bucket by bucket.
    """
    y = F.col(label)

    def rows(condition: Column) -> Column:
        # Written as a sum: count_if names a helper column anew each time it is planned, and then
        # the two readers of this table would not share its shuffle.
        return F.sum(F.when(condition, 1).otherwise(0))

    distinct = (
        df.groupBy(*by, known(F.col(score)).alias("threshold"))
        .agg(rows(y == 1).alias("pos"), rows(y == 0).alias("neg"))
        .withColumn("bucket", score_bucket(F.col("threshold")))
    )
    return running_sums(
        distinct,
        group=by,
        bucket="bucket",
        order=[F.col("threshold").desc()],
        sums={"tp": "pos", "fp": "neg"},
        totals={"n_pos": "pos", "n_neg": "neg"},
        descending=True,
    )


def _is_first() -> Column:
    """Is this the row of the highest score?"""
    return (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))


def corners_only(curve: DataFrame, by: list[str]) -> DataFrame:
    """Drop the points that lie on the straight line between their neighbours.

    A point stays when the next score adds other counts than it does; the first and the last always
    stay. The next score may sit in the next bucket, so each bucket gets that bucket's top counts as
    one more row.
    """
    height = F.coalesce("threshold", F.lit(float("-inf")))
    tops = curve.groupBy(*by, "bucket").agg(F.max_by(F.struct("pos", "neg"), height).alias("top"))
    downwards = Window.partitionBy(*by).orderBy(F.desc("bucket"))
    following = tops.withColumn("top", F.lead("top").over(downwards)).select(
        *by, "bucket", F.col("top.pos").alias("pos"), F.col("top.neg").alias("neg"), F.lit(1).alias("last")
    )
    inside = Window.partitionBy(*by, "bucket").orderBy("last", F.desc("threshold"))
    looked_ahead = (
        curve.withColumn("last", F.lit(0))
        .unionByName(following, allowMissingColumns=True)
        .withColumns({"next_pos": F.lead("pos").over(inside), "next_neg": F.lead("neg").over(inside)})
        .filter(F.col("last") == 0)
    )
    turns = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
    return looked_ahead.filter(_is_first() | F.col("next_pos").isNull() | turns).drop("last", "next_pos", "next_neg")


def roc_points(
    df: DataFrame, by: list[str], score: str = "score", label: str = LABEL, drop_collinear: bool = False
) -> DataFrame:
    """(fpr, tpr, threshold) per distinct score, with the leading corner at an infinite threshold."""
    curve = curve_counts(df, by, score, label)
    if drop_collinear:
        curve = corners_only(curve, by)
    point = F.struct(
        ratio_or_zero(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio_or_zero(F.col("tp"), F.col("n_pos")).alias("tpr"),
        "threshold",
    )
    corner = F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return curve.select(*by, F.inline(F.when(_is_first(), F.array(corner, point)).otherwise(F.array(point))))


def roc_auc(df: DataFrame, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule."""
    curve = curve_counts(df, by, score, label)
    below = F.col("tp").cast("double") - F.col("pos") / 2
    area = F.sum(F.col("neg") * below)
    return curve.groupBy(*by).agg(
        F.try_divide(area, F.max("n_pos").cast("double") * F.max("n_neg")).alias("roc_auc")
    )


def pr_points(df: DataFrame, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """(precision, recall, threshold) per distinct score and the closing point (1, 0)."""
    curve = curve_counts(df, by, score, label)
    point = F.struct(
        precision(F.col("tp"), F.col("fp")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("n_pos")).alias("recall"),
        "threshold",
    )
    closing = F.struct(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return curve.select(*by, F.inline(F.when(_is_first(), F.array(point, closing)).otherwise(F.array(point))))


def average_precision(df: DataFrame, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """Precision weighted by the step in recall; 0 without positives."""
    curve = curve_counts(df, by, score, label)
    step = F.col("pos").cast("double") * precision(F.col("tp"), F.col("fp"))
    return curve.groupBy(*by).agg(ratio_or_zero(F.sum(step), F.max("n_pos")).alias("average_precision"))


def prevalence_baseline(df: DataFrame, by: list[str], label: str = LABEL) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(label).alias("prevalence"))


def grid_threshold(i: Column) -> Column:
    return F.lit(GRID_STEP) + i.cast("double") * F.lit(GRID_STEP)


def thresholds_reached(score: Column) -> Column:
    """How many grid thresholds a score reaches: a guess by division, corrected on the grid itself."""
    score = F.coalesce(known(score), F.lit(0.0))
    guess = F.greatest(F.least(F.floor(score * 100), F.lit(GRID_SIZE)) - 2, F.lit(0))
    reached = guess
    for offset in range(4):
        i = guess + offset
        reached = reached + F.when((i < GRID_SIZE) & (grid_threshold(i) <= score), 1).otherwise(0)
    return reached.cast("int")


def threshold_sweep(df: DataFrame, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """F1, precision and recall at each of the 99 thresholds.

    Each row falls into one of 100 classes by the thresholds it reaches; the sweep itself runs on
    those 100 counts per group, never on rows times thresholds.
    """
    y = F.col(label)
    reached = (
        df.groupBy(*by, thresholds_reached(F.col(score)).alias("reached"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    # At most 100 entries per group; classes nobody falls into count zero.
    cells = F.map_from_entries(F.collect_list(F.struct("reached", F.struct("pos", "neg"))))
    every = reached.groupBy(*by).agg(cells.alias("cells")).withColumn("reached", F.explode(F.sequence(F.lit(0), F.lit(GRID_SIZE))))
    cell = F.try_element_at("cells", F.col("reached"))
    counts = every.select(
        *by,
        "reached",
        F.coalesce(cell["pos"], F.lit(0)).alias("pos"),
        F.coalesce(cell["neg"], F.lit(0)).alias("neg"),
    )
    group = Window.partitionBy(*by)
    upwards = group.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulated = counts.select(
        *by,
        "reached",
        F.sum("pos").over(upwards).alias("tp"),
        F.sum("neg").over(upwards).alias("fp"),
        F.sum("pos").over(group).alias("n_pos"),
    ).filter(F.col("reached") >= 1)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("n_pos") - F.col("tp")
    return cumulated.select(
        *by,
        grid_threshold(F.col("reached") - 1).alias("threshold"),
        "tp",
        "fp",
        fn.alias("fn"),
        f1(tp, fp, fn).alias("f1"),
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
    )


def best_threshold(sweep: DataFrame, by: list[str]) -> DataFrame:
    """The lowest threshold of maximal F1; 0.5 when F1 is 0 throughout."""
    best = F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), -F.col("threshold")))
    found = sweep.groupBy(*by).agg(best.alias("best"))
    return found.select(
        *by,
        F.when(F.col("best.f1") > 0, F.col("best.threshold")).otherwise(F.lit(0.5)).alias("best_threshold"),
        F.col("best.f1").alias("best_f1"),
    )


def threshold_at(sweep: DataFrame, by: list[str], targets: list[float]) -> DataFrame:
    """The sweep row nearest each target; the lower one on a tie."""
    rows = sweep.groupBy(*by).agg(
        *[
            F.min_by(
                F.struct("threshold", "f1", "precision", "recall"),
                F.struct(F.abs(F.col("threshold") - F.lit(t)), F.col("threshold")),
            ).alias(f"at_{i}")
            for i, t in enumerate(targets)
        ]
    )
    found = [
        F.struct(F.lit(t).alias("target"), *[F.col(f"at_{i}.{n}").alias(n) for n in ("threshold", "f1", "precision", "recall")])
        for i, t in enumerate(targets)
    ]
    return rows.select(*by, F.inline(F.array(*found)))


def strategy_table(df: DataFrame, by: list[str], score: str = "score", label: str = LABEL) -> DataFrame:
    """Standard, aggressive and F1-optimal thresholds side by side."""
    columns = ["threshold", "f1", "precision", "recall", "fp", "fn"]
    s = F.coalesce(known(F.col(score)), F.lit(float("-inf")))
    y = F.col(label)
    fixed = [STANDARD, AGGRESSIVE]
    counts = df.groupBy(*by).agg(
        *[
            c.alias(f"{n}{i}")
            for i, (_, t) in enumerate(fixed)
            for n, c in (
                ("tp", F.count_if((y == 1) & (s >= t))),
                ("fp", F.count_if((y == 0) & (s >= t))),
                ("fn", F.count_if((y == 1) & (s < t))),
            )
        ]
    )
    items = {}
    for i, (name, t) in enumerate(fixed):
        tp, fp, fn = F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}")
        values = [F.lit(t), f1(tp, fp, fn), precision(tp, fp), recall(tp, fn), fp, fn]
        items[name] = dict(zip(columns, values, strict=True))
    named = long_row(counts, by, items, "strategy")
    sweep = threshold_sweep(df, by, score, label)
    best = F.max_by(F.struct(*columns), F.struct(F.col("f1"), -F.col("threshold")))
    optimal = sweep.groupBy(*by).agg(best.alias("best")).select(*by, F.lit("Optimal").alias("strategy"), "best.*")
    return named.unionByName(optimal)


def prediction_summary(df: DataFrame, by: list[str], thresholds: list[float], score: str = "score") -> DataFrame:
    """How many rows each threshold flags."""
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(known(F.col(score)) >= t).alias(f"n{i}") for i, t in enumerate(thresholds)],
    )
    rows = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.col(f"n{i}").alias("n_fraud"),
            F.col("total").alias("total"),
            percent(F.col(f"n{i}"), F.col("total")).alias("fraud_pct"),
        )
        for i, t in enumerate(thresholds)
    ]
    return counts.select(*by, F.inline(F.array(*rows)))
