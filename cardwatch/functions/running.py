"""Running sums over an order, without putting a whole group into one task.

A window over one big group runs in one task. Here each group is cut into buckets along its
order; bucket totals are small, are summed up among themselves, and give every bucket the sum it
starts from. Only the rows of one bucket meet in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEPS_PER_OCTAVE = 256
# Above every possible log2 of a double times the steps, so that signs never mix.
_SIGN_OFFSET = 1100 * _STEPS_PER_OCTAVE


def value_bucket(value: Column) -> Column:
    """An integer that never falls as the value rises; equal steps on a log scale, both signs."""
    v = value.cast("double")
    magnitude = F.floor(F.log2(F.abs(v)) * _STEPS_PER_OCTAVE) + _SIGN_OFFSET
    return F.when(v > 0, magnitude).when(v < 0, -magnitude).otherwise(F.lit(0).cast("long"))


def score_bucket(score: Column) -> Column:
    """As ``value_bucket``, with fine steps near 0 and near 1, where probabilities gather. Null is below every score."""
    s = score.cast("double")
    beyond = 4 * _SIGN_OFFSET
    return (
        F.when(s.isNull(), F.lit(-4 * beyond).cast("long"))
        .when(s <= 0, value_bucket(s) - beyond)
        .when(s < 1, value_bucket(s / (F.lit(1.0) - s)))
        .otherwise(value_bucket(s) + beyond)
    )


def running_sums(
    df: DataFrame,
    *,
    group: list[str],
    bucket: str,
    order: list[Column],
    sums: dict[str, str],
    totals: dict[str, str] | None = None,
    descending: bool = False,
    ties: bool = True,
) -> DataFrame:
    """Add inclusive running sums (``sums``: new name -> column) and group totals (``totals``).

    ``bucket`` must be monotone in ``order`` (falling if ``descending``). With ``ties`` rows equal
    in ``order`` see each other. Each bucket receives one more row, holding what came before it, so
    rows and starting sums meet in the window's own shuffle and no join is needed.
    """
    totals = totals or {}
    by_bucket = F.col(bucket).desc() if descending else F.col(bucket).asc()
    carried = sorted(set(sums.values()))
    measures = sorted({*carried, *totals.values()})
    per_bucket = df.groupBy(*group, bucket).agg(*[F.sum(m).alias(m) for m in measures])

    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(by_bucket).rowsBetween(Window.unboundedPreceding, -1)
    start = per_bucket.select(
        *group,
        bucket,
        F.lit(1).alias("__first"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(m) for m in carried],
        *[F.sum(m).over(whole).alias(n) for n, m in totals.items()],
    )

    inside = Window.partitionBy(*group, bucket).orderBy(F.col("__first").desc(), *order)
    inside = (
        inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        if ties
        else inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    added = {n: F.sum(m).over(inside) for n, m in sums.items()} | {n: F.max(n).over(inside) for n in totals}
    return (
        df.withColumn("__first", F.lit(0))
        .unionByName(start, allowMissingColumns=True)
        .withColumns(added)
        .filter(F.col("__first") == 0)
        .drop("__first")
    )
