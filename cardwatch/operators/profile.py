"""Profiling tables: counts, shares, rates, cross-tabulations and correlations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.features import right_closed_bin
from cardwatch.functions.ratios import correlation, percent
from cardwatch.operators.quality import long_row
from cardwatch.schema import ID, LABEL, TIME_OF_DAY_ORDER

# The overall fraud percentage that marks a category as above baseline.
BASELINE_PCT = 1.51

# Bin edges and labels of the trust and amount profiles.
TRUST_EDGES = [20, 30, 40, 50, 60, 70, 80, 90, 100]
TRUST_LABELS = ["20-30", "30-40", "40-50", "50-60", "60-70", "70-80", "80-90", "90-100"]
AMOUNT_EDGES = [0, 50, 100, 200, 500, 1500]
AMOUNT_LABELS = ["$0-50", "$50-100", "$100-200", "$200-500", "$500+"]

def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    total = df.agg(F.count(column)).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(column, "n", (F.col("n") / total).alias("share"))


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    counts = df.agg(n0.alias("n0"), n1.alias("n1"), F.count(F.lit(1)).alias("n"))
    return counts.select(
        "n",
        "n0",
        "n1",
        percent(F.col("n0"), F.col("n")).alias("pct0"),
        percent(F.col("n1"), F.col("n")).alias("pct1"),
        F.floor(F.try_divide(F.col("n0"), F.col("n1"))).alias("ratio"),
        F.try_divide(F.col("n1").cast("double"), F.col("n")).alias("prevalence"),
    )


def rate_by(df: DataFrame, keys: list[str | Column], label: str = LABEL) -> DataFrame:
    """Percentage of positives and row count per group."""
    return df.groupBy(*keys).agg((F.avg(label) * 100).alias("rate_pct"), F.count(F.lit(1)).alias("n"))


def rate_by_category(df: DataFrame, column: str = "merchant_category") -> DataFrame:
    rates = rate_by(df, [column]).select(column, "rate_pct", (F.col("rate_pct") > BASELINE_PCT).alias("above_baseline"))
    return rates.orderBy(F.desc("rate_pct"), column)


def rate_by_bin(df: DataFrame, value: str, edges: list[float], labels: list[str], name: str) -> DataFrame:
    """Rate per right-closed bin; values outside all bins drop out."""
    binned = df.withColumn(name, right_closed_bin(F.col(value), edges, labels))
    return rate_by(binned.filter(F.col(name).isNotNull()), [name])


def crosstab(df: DataFrame, keys: list[str], label: str = LABEL) -> DataFrame:
    """Rows per group and class."""
    return df.groupBy(*keys).agg(
        F.count_if(F.col(label) == 0).alias("legitimate"), F.count_if(F.col(label) == 1).alias("fraud")
    )


def row_pct(counts: DataFrame, keys: list[str]) -> DataFrame:
    total = F.col("legitimate") + F.col("fraud")
    return counts.select(
        *keys,
        percent(F.col("legitimate"), total).alias("legitimate_pct"),
        percent(F.col("fraud"), total).alias("fraud_pct"),
    )


def flag_row_pct(df: DataFrame, flags: list[str], label: str = LABEL) -> DataFrame:
    """Row-normalised class shares of several flags in one pass."""
    long = df.unpivot([label], flags, "flag", "flag_value")
    return row_pct(crosstab(long, ["flag", "flag_value"], label), ["flag", "flag_value"])


def crosstab_margins(df: DataFrame, a: str, b: str, label: str = LABEL) -> DataFrame:
    """Two keys by class, with an All column and one All row."""
    total = F.grouping_id() > 0
    counts = df.groupingSets([[F.col(a), F.col(b)], []], F.col(a), F.col(b)).agg(
        F.count_if(F.col(label) == 0).alias("legitimate"),
        F.count_if(F.col(label) == 1).alias("fraud"),
        F.count(F.lit(1)).alias("all"),
        total.alias("is_total"),
    )
    return counts.select(
        *[F.when(F.col("is_total"), "All").otherwise(F.col(k).cast("string")).alias(k) for k in (a, b)],
        "legitimate",
        "fraud",
        "all",
    )


def interaction_grid(df: DataFrame, a: str, b: str, label: str = LABEL) -> DataFrame:
    """Positive percentage by two keys, the second spread over columns."""
    return df.groupBy(a).agg(*[(F.avg(F.when(F.col(b) == v, F.col(label))) * 100).alias(f"{b}_{v}") for v in (0, 1)])


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair below the diagonal, all in one aggregate."""
    pairs = [(columns[i], columns[j]) for i in range(len(columns)) for j in range(i)]
    stats = df.selectExpr(
        *[f"stddev_pop(`{c}`) AS `sd_{c}`" for c in columns],
        *[f"covar_pop(`{a}`, `{b}`) AS cov_{i}" for i, (a, b) in enumerate(pairs)],
    )
    rows = ", ".join(
        f"'{a}', '{b}', try_divide(cov_{i}, `sd_{a}` * `sd_{b}`)" for i, (a, b) in enumerate(pairs)
    )
    return stats.selectExpr(f"stack({len(pairs)}, {rows}) AS (row_name, column_name, correlation)")


def correlation_with(df: DataFrame, columns: list[str], target: str = LABEL) -> DataFrame:
    stats = df.agg(*[correlation(F.col(c), F.col(target)).alias(f"r_{c}") for c in columns])
    return long_row(stats, [], {c: {"correlation": F.col(f"r_{c}")} for c in columns}, "feature")


def strongest_correlations(correlations: DataFrame, n: int = 5) -> DataFrame:
    return (
        correlations.filter(F.col("correlation").isNotNull())
        .orderBy(F.desc(F.round(F.abs("correlation"), 9)), "feature")
        .limit(n)
    )


def feature_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Min, max, mean and sample deviation of every column in one aggregate."""
    stats = df.selectExpr(
        *[
            f"CAST({f}(`{c}`) AS DOUBLE) AS `{n}_{c}`"
            for c in columns
            for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))
        ]
    )
    rows = ", ".join(f"'{c}', `min_{c}`, `max_{c}`, `mean_{c}`, `std_{c}`" for c in columns)
    return stats.selectExpr(f"stack({len(columns)}, {rows}) AS (feature, min, max, mean, std)")


def minority_plus_sample(df: DataFrame, columns: list[str], n: int = 500, seed: int = 42, label: str = LABEL) -> DataFrame:
    """All positives and exactly ``n`` negatives, drawn by a seeded hash of the id."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(ID).cast("string")))
    drawn = df.filter(F.col(label) == 0).orderBy(draw, ID).limit(n)
    return df.filter(F.col(label) == 1).select(ID, *columns).unionByName(drawn.select(ID, *columns))


def feature_catalog(df: DataFrame, original: list[str], uniques: DataFrame) -> DataFrame:
    """Type, distinct count and origin of every column."""
    facts = {
        f.name: (f.dataType.simpleString(), "Original" if f.name in original else "Engineered") for f in df.schema
    }

    def lookup(position: int) -> Column:
        pairs = [F.lit(x) for name, fact in facts.items() for x in (name, fact[position])]
        return F.element_at(F.create_map(*pairs), F.col("column_name"))

    return uniques.select(
        "column_name", lookup(0).alias("dtype"), "n_unique", lookup(1).alias("source")
    )


def counts_in_order(df: DataFrame, column: str, order: list[str] = TIME_OF_DAY_ORDER) -> DataFrame:
    """Counts per category in a given order; a category without rows has a null count."""
    stats = df.agg(*[F.count_if(F.col(column) == v).alias(f"n{i}") for i, v in enumerate(order)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(v).alias(column),
            F.when(F.col(f"n{i}") > 0, F.col(f"n{i}")).alias("n"),
        )
        for i, v in enumerate(order)
    ]
    return stats.select(F.inline(F.array(*rows)))
