"""Guarded arithmetic shared by the statistics and the metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double") * F.lit(100.0), denominator.cast("double"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; null when either side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio_or_zero(tp * 2, tp * 2 + fp + fn)


def precision(tp: Column, fp: Column) -> Column:
    return ratio_or_zero(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio_or_zero(tp, tp + fn)
