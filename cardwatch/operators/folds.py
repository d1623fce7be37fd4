"""Class weights and stratified folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.running import running_sums
from cardwatch.schema import ID, LABEL


def pos_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives per positive."""
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(F.try_divide(n0.cast("double"), n1).alias("pos_weight"))


def balanced_weights(df: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """Each row weighted by n / (2 * rows of its class); the class counts are one subquery row."""
    counts = df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(label) == 0).alias("n0"),
            F.count_if(F.col(label) == 1).alias("n1"),
        )
    ).scalar()

    def weight(n_class: str) -> Column:
        return F.try_divide(F.col("__counts.n").cast("double"), F.col(f"__counts.{n_class}") * 2)

    weighted = df.withColumn("__counts", counts)
    return weighted.withColumn(name, F.when(F.col(label) == 1, weight("n1")).otherwise(weight("n0"))).drop("__counts")


def shuffled_key(seed: int, key: str = ID) -> Column:
    """A seeded pseudo-random sort key that depends on the id alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = LABEL, key: str = ID) -> DataFrame:
    """Deal the rows of each class, in shuffled order, to folds 0..k-1.

    Fold sizes differ by at most one per class. The rank inside a class is a running count over
    buckets of the shuffled order, so the majority class is not sorted in one task.
    """
    keyed = df.withColumns({"__key": shuffled_key(seed, key), "__one": F.lit(1)})
    bucketed = keyed.withColumn("__bucket", F.conv(F.substring("__key", 1, 4), 16, 10).cast("int"))
    ranked = running_sums(
        bucketed,
        group=[label],
        bucket="__bucket",
        order=[F.col("__key"), F.col(key)],
        sums={"__rank": "__one"},
        ties=False,
    )
    fold = ((F.col("__rank") - 1) % k).cast("int")
    return ranked.withColumn("fold", fold).drop("__key", "__one", "__bucket", "__rank")
