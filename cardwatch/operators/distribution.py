"""Exact distribution statistics per feature: moments, quantiles, fences, histograms.

Nothing here shuffles the rows themselves. Each pass over the (column-pruned) table folds it into
bucket or bin counts before anything moves; only the few buckets that hold a wanted quantile are
looked at value by value.

``by`` is a class-like column (label, split). Statistics per (class, feature) are therefore a handful
of rows, at most columns times classes, which is what is broadcast below.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.running import running_sums, value_bucket
from cardwatch.operators.quality import long_row

# Cells a quantile's bucket is cut into, so that even a crowded bucket is spread over tasks.
_CELLS = 4096


def long_values(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows (by..., feature, value). Nulls and NaN are left out, as in pandas."""
    by = by or []
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(by, columns, "feature", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per (by..., feature), one column per prob.

    A first job counts rows per value bucket and brings back the buckets around each wanted rank:
    at most two per prob and group. A bucket holding one value is done; only the rows inside the
    value ranges of the others are read again, and ranked.
    """
    by = by or []
    keys = [*by, "feature"]

    def rank(p: float) -> Column:
        return (F.col("n_group") - 1) * F.lit(float(p))

    def holds(position: Column) -> Column:
        return (F.col("upto") > position) & (F.col("upto") - F.col("n") <= position)

    positions = [end(rank(p)) for p in probs.values() for end in (F.floor, F.ceil)]
    bucketed = long_values(df, columns, by).withColumn("bucket", value_bucket(F.col("value")))
    whole = Window.partitionBy(*keys)
    upwards = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    targets = (
        bucketed.groupBy(*keys, "bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumns({"upto": F.sum("n").over(upwards), "n_group": F.sum("n").over(whole)})
        .filter(reduce(or_, map(holds, positions)))
    )
    rows = targets.collect()
    found = df.sparkSession.createDataFrame(rows, targets.schema)
    spread = sorted({(r["feature"], r["low"], r["high"]) for r in rows if r["low"] < r["high"]})

    names = [*keys, "value", "n", "upto", "n_group"]
    candidates = found.filter(F.col("low") == F.col("high")).withColumn("value", F.col("low")).select(*names)
    if spread:
        in_range = reduce(or_, [F.col(c).between(low, high) for c, low, high in spread])
        buckets = found.filter(F.col("low") < F.col("high")).select(
            *keys, "bucket", "low", "high", (F.col("upto") - F.col("n")).alias("before"), "n_group"
        )
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        inside = long_values(df.filter(in_range), sorted({c for c, _, _ in spread}), by)
        counted = (
            inside.withColumn("bucket", value_bucket(F.col("value")))
            .join(F.broadcast(buckets), [*keys, "bucket"])
            .withColumn("cell", F.floor(share * _CELLS))
            .groupBy(*keys, "bucket", "before", "n_group", "cell", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        ranked = running_sums(
            counted, group=[*keys, "bucket"], bucket="cell", order=[F.col("value")], sums={"within": "n"}
        )
        candidates = candidates.unionByName(
            ranked.withColumn("upto", F.col("within") + F.col("before")).select(*names)
        )

    aggs = []
    for name, p in probs.items():
        for end, position in (("lo", F.floor(rank(p))), ("hi", F.ceil(rank(p)))):
            aggs.append(F.max(F.when(holds(position), F.col("value"))).alias(f"{end}_{name}"))
        aggs.append(F.max(rank(p) - F.floor(rank(p))).alias(f"part_{name}"))
    picked = candidates.groupBy(*keys).agg(*aggs)
    return picked.select(
        *keys,
        *[(F.col(f"lo_{n}") + (F.col(f"hi_{n}") - F.col(f"lo_{n}")) * F.col(f"part_{n}")).alias(n) for n in probs],
    )


def moments(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min and max of every column in one aggregate."""
    by = by or []
    kinds = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    stats = df.groupBy(*by).agg(
        *[
            F.expr(f"{f}(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)))").alias(f"{n}_{c}")
            for c in columns
            for n, f in kinds.items()
        ]
    )
    return long_row(stats, by, {c: {n: F.col(f"{n}_{c}") for n in kinds} for c in columns}, "feature")


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max of each column."""
    keys = [*(by or []), "feature"]
    return (
        moments(df, columns, by)
        .join(F.broadcast(quantiles(df, columns, QUARTILES, by)), keys, "left")
        .select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")
    )


# Fixed value: fences lie this many interquartile ranges outside the quartiles.
FENCE = 1.5


def _fences(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    q = quantiles(df, columns, QUARTILES, by)
    iqr = F.col("p75") - F.col("p25")
    return q.withColumns({"lower": F.col("p25") - iqr * FENCE, "upper": F.col("p75") + iqr * FENCE})


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    counted = (
        long_values(df, columns)
        .join(F.broadcast(_fences(df, columns)), "feature")
        .groupBy("feature", "p25", "p75", "lower", "upper")
        .agg(F.count_if(outside).alias("outliers"), F.count(F.lit(1)).alias("total"))
    )
    return counted.select(
        "feature",
        F.col("p25").alias("q1"),
        F.col("p75").alias("q3"),
        "lower",
        "upper",
        "outliers",
        (F.col("outliers") * 100.0 / F.col("total")).alias("pct"),
    )


def box_summary(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Quartiles, whisker ends (the most extreme values inside the fences) and fliers per class."""
    keys = [by, "feature"]
    inside = (F.col("value") >= F.col("lower")) & (F.col("value") <= F.col("upper"))
    return (
        long_values(df, columns, [by])
        .join(F.broadcast(_fences(df, columns, [by])), keys)
        .groupBy(*keys, "p25", "p50", "p75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("fliers"),
        )
    )


def histogram(df: DataFrame, bins: dict[str, int], by: str) -> DataFrame:
    """Equal-width density histograms of several columns, each group over its own range.

    Empty bins are kept; the top edge belongs to the last bin.
    """
    keys = [by, "feature"]
    n_bins = F.element_at(F.create_map(*[F.lit(x) for kv in bins.items() for x in kv]), F.col("feature"))
    ranges = (
        moments(df, list(bins), [by])
        .select(*keys, F.col("min").alias("low"), F.col("max").alias("high"), F.col("count").alias("total"))
        .filter(F.col("total") > 0)
        .withColumn("bins", n_bins)
        .withColumn("width", (F.col("high") - F.col("low")) / F.col("bins"))
    )
    scaled = F.try_divide((F.col("value") - F.col("low")) * F.col("bins"), F.col("high") - F.col("low"))
    counted = (
        long_values(df, list(bins), [by])
        .join(F.broadcast(ranges.select(*keys, "low", "high", "bins")), keys)
        .withColumn("bin", F.least(F.floor(F.coalesce(scaled, F.lit(0.0))), F.col("bins") - 1).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    n = F.coalesce(F.col("n"), F.lit(0))
    return grid.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("low") + F.col("width") * F.col("bin")).alias("left_edge"),
        n.alias("n"),
        F.try_divide(n.cast("double"), F.col("total") * F.col("width")).alias("density"),
    )


def split_drift(df: DataFrame, columns: list[str], by: str = "split") -> DataFrame:
    """Mean, median and deviation of train and test side by side."""
    keys = [by, "feature"]
    stats = moments(df, columns, [by]).join(F.broadcast(quantiles(df, columns, {"median": 0.5}, [by])), keys, "left")

    def of(name: str, split: str) -> Column:
        return F.max(F.when(F.col(by) == split, F.col(name))).alias(f"{split}_{name}")

    return stats.groupBy("feature").agg(*[of(n, s) for n in ("mean", "median", "std") for s in ("train", "test")])


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct values per column, without null and NaN; each value travels once, as text."""

    def text(c: str) -> Column:
        value = F.col(c)
        if df.schema[c].dataType.simpleString() in ("double", "float"):
            # Both zeros are one value.
            value = F.when(value == 0, F.lit(0.0)).when(~F.isnan(value), value)
        return value.cast("string").alias(c)

    long = df.select(*[text(c) for c in columns]).unpivot([], columns, "column_name", "value")
    seen = long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.lit(1).alias("one"))
    return seen.groupBy("column_name").agg(F.count("one").alias("n_unique"))
