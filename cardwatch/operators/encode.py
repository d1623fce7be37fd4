"""Engineering and encoding of transaction tables. No shuffle, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.features import engineered_columns
from cardwatch.schema import ID, LABEL, MERCHANT_CATEGORIES, SPLIT, TIMES_OF_DAY, feature_names


def combine(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both splits in one table; the test label is null, ids and labels travel along."""
    tagged_train = train.withColumn(SPLIT, F.lit("train"))
    tagged_test = test.drop(LABEL).withColumns({SPLIT: F.lit("test"), LABEL: F.lit(None).cast("int")})
    return tagged_train.unionByName(tagged_test)


def split_back(combined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train with its label, test without one."""
    train = combined.filter(F.col(SPLIT) == "train").drop(SPLIT)
    test = combined.filter(F.col(SPLIT) == "test").drop(SPLIT, LABEL)
    return train, test


def engineer_features(df: DataFrame) -> DataFrame:
    return df.withColumns(engineered_columns())


def one_hot(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """Replace each column by one 0/1 column per value, appended in sorted order."""
    encoded = {
        f"{c}_{v}": F.when(F.col(c) == v, 1).otherwise(0) for c, values in columns.items() for v in sorted(values)
    }
    return df.withColumns(encoded).drop(*columns)


def unknown_categories(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """(column_name, value, n): values that ``one_hot`` has no column for, null included."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col(c).isin(v).alias("fits")) for c, v in columns.items()]
    long = df.select(F.inline(F.array(*pairs))).filter(~F.coalesce("fits", F.lit(False)))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def require_known_categories(df: DataFrame, columns: dict[str, list[str]]) -> None:
    """Raise when a category would be encoded as all zeros; the message names the most frequent ones."""
    unknown = unknown_categories(df, columns).orderBy(F.desc("n"), "value").limit(10).collect()
    if unknown:
        raise ValueError("no column for " + ", ".join(f"{r['column_name']}={r['value']} ({r['n']} rows)" for r in unknown))


def bool_to_int(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("int") for f in df.schema if f.dataType.simpleString() == "boolean"})


def encode(df: DataFrame, merchants: list[str] = MERCHANT_CATEGORIES) -> DataFrame:
    return one_hot(df, {"merchant_category": merchants, "time_of_day_category": TIMES_OF_DAY})


def preprocess(train: DataFrame, test: DataFrame, merchants: list[str] = MERCHANT_CATEGORIES) -> DataFrame:
    """The engineered table of both splits: id, split, the model inputs, label (null in test)."""
    encoded = encode(engineer_features(combine(train, test)), merchants)
    return encoded.select(ID, SPLIT, *feature_names(merchants), LABEL)


def fold_scaler(df: DataFrame, columns: list[str], k: int, fold: str = "fold") -> DataFrame:
    """Mean and population deviation of each column over the rows outside each fold, in one aggregate."""
    stats = df.agg(
        *[
            f(F.when(F.col(fold) != i, F.col(c))).alias(f"{n}_{i}_{c}")
            for i in range(k)
            for c in columns
            for n, f in (("mean", F.avg), ("std", F.stddev_pop))
        ]
    )
    rows = [
        F.struct(
            F.lit(i).alias(fold),
            F.lit(c).alias("feature"),
            F.col(f"mean_{i}_{c}").alias("mean"),
            F.col(f"std_{i}_{c}").alias("std"),
        )
        for i in range(k)
        for c in columns
    ]
    return stats.select(F.inline(F.array(*rows)))


def standard_scale(df: DataFrame, columns: list[str], fitted_on: DataFrame) -> DataFrame:
    """Z-scores with the mean and population deviation of ``fitted_on``; a constant column becomes 0.

    The statistics are one row; the subquery hands them to every task.
    """
    stats = fitted_on.agg(
        F.struct(
            *[
                f(c).alias(f"{n}_{c}")
                for c in columns
                for n, f in (("mean", F.avg), ("std", F.stddev_pop))
            ]
        ).alias("stats")
    )
    return scale_by(df.withColumn("__stats", stats.scalar()), columns).drop("__stats")


def scale_by(df: DataFrame, columns: list[str], stats: str = "__stats") -> DataFrame:
    def z(c: str) -> Column:
        centred = F.col(c) - F.col(f"{stats}.mean_{c}")
        deviation = F.col(f"{stats}.std_{c}")
        return F.when(deviation == 0, centred).otherwise(F.try_divide(centred, deviation))

    return df.withColumns({c: z(c) for c in columns})


