"""Data-quality checks, each one aggregate over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardwatch.schema import ID, LABEL, SPLIT


def long_row(stats: DataFrame, keys: list[str], items: dict[str, dict[str, Column]], name: str = "column_name") -> DataFrame:
    """Turn one wide statistics row into one row per item."""
    rows = [F.struct(F.lit(k).alias(name), *[c.alias(n) for n, c in v.items()]) for k, v in items.items()]
    return stats.select(*keys, F.inline(F.array(*rows)))


def missing(df: DataFrame, column: str) -> Column:
    null = F.col(column).isNull()
    return null | F.isnan(column) if df.schema[column].dataType.simpleString() in ("double", "float") else null


def null_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Missing values per column; NaN is missing as well."""
    by = by or []
    stats = df.groupBy(*by).agg(*[F.count_if(missing(df, c)).alias(f"n_{c}") for c in columns])
    return long_row(stats, by, {c: {"nulls": F.col(f"n_{c}")} for c in columns})


def duplicate_rows(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows equal to an earlier one; equal rows meet as counts, so many copies of one row are cheap."""
    by = by or []
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy(*by).agg(F.sum(F.col("copies") - 1).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, key: str = ID, by: list[str] | None = None) -> DataFrame:
    """Repeated keys; a missing key counts as one more value."""
    by = by or []
    per_key = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy(*by).agg(F.sum(F.col("copies") - 1).alias("duplicate_keys"))


def id_overlap(a: DataFrame, b: DataFrame, key: str = ID) -> DataFrame:
    """How many distinct ids both tables hold: one grouped pass instead of a join, so hot ids do not matter."""
    tagged = a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionAll(
        b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    per_id = tagged.groupBy(key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return per_id.agg(F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)).alias("overlap"))


def schema_match(a: StructType, b: StructType) -> dict[str, tuple[str, str, bool]]:
    """Types of the columns both schemas have."""
    other = {f.name: f.dataType.simpleString() for f in b.fields}
    return {
        f.name: (f.dataType.simpleString(), other[f.name], f.dataType.simpleString() == other[f.name])
        for f in a.fields
        if f.name in other
    }


def schema_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """Types of the common columns side by side, with the non-null counts behind them."""
    types = schema_match(train.schema, test.schema)
    filled = (
        train.select(F.lit("train").alias(SPLIT), *types)
        .unionByName(test.select(F.lit("test").alias(SPLIT), *types), allowMissingColumns=True)
        .agg(
            *[
                F.count(F.when(F.col(SPLIT) == s, F.col(c))).alias(f"{s}_{c}")
                for c in types
                for s in ("train", "test")
            ]
        )
    )
    return long_row(
        filled,
        [],
        {
            c: {
                "train_type": F.lit(t),
                "test_type": F.lit(u),
                "types_match": F.lit(same),
                "train_non_null": F.col(f"train_{c}"),
                "test_non_null": F.col(f"test_{c}"),
            }
            for c, (t, u, same) in types.items()
        },
    )


def domain_check(df: DataFrame, columns: list[str], values: list[int], by: list[str] | None = None) -> DataFrame:
    """Whether the distinct values of each column are exactly the given ones, without collecting them."""
    by = by or []
    aggs = []
    for c in columns:
        inside = F.coalesce(F.col(c).isin(values), F.lit(False))
        aggs.append(F.count_if(~inside).alias(f"out_{c}"))
        aggs += [F.count_if(F.col(c) == v).alias(f"v{i}_{c}") for i, v in enumerate(values)]
    stats = df.groupBy(*by).agg(*aggs)
    items = {}
    for c in columns:
        seen = sum((F.col(f"v{i}_{c}") > 0).cast("long") for i in range(len(values)))
        items[c] = {
            "values_seen": seen,
            "outside": F.col(f"out_{c}"),
            "passed": (F.col(f"out_{c}") == 0) & (seen == len(values)),
        }
    return long_row(stats, by, items)


def edge_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    by = by or []
    stats = df.groupBy(*by).agg(
        *[F.count_if(F.col(c) == 0).alias(f"zero_{c}") for c in columns],
        *[F.count_if(F.col(c) < 0).alias(f"neg_{c}") for c in columns],
    )
    return long_row(stats, by, {c: {"zeros": F.col(f"zero_{c}"), "negatives": F.col(f"neg_{c}")} for c in columns})


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def column_info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return long_row(
        counts, [], {f.name: {"dtype": F.lit(f.dataType.simpleString()), "non_null": F.col(f.name)} for f in df.schema}
    )


def preview(df: DataFrame, n: int = 5, key: str = ID) -> DataFrame:
    return df.orderBy(key).limit(n)


def engineered_gate(train: DataFrame, test: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: is the engineered data complete, labelled in train only, and as long as the raw data?"""
    features = [c for c in test.columns if c != SPLIT]

    labelled = [*features, LABEL] if LABEL in train.columns else features
    both = train.select(F.lit("train").alias(SPLIT), nullity(labelled)).unionAll(
        test.select(F.lit("test").alias(SPLIT), nullity(features))
    )
    stats = both.agg(
        F.coalesce(F.sum(F.when(F.col(SPLIT) == "train", F.col("nulls"))), F.lit(0)).alias("train_nulls"),
        F.coalesce(F.sum(F.when(F.col(SPLIT) == "test", F.col("nulls"))), F.lit(0)).alias("test_nulls"),
        F.count_if(F.col(SPLIT) == "train").alias("train_rows"),
        F.count_if(F.col(SPLIT) == "test").alias("test_rows"),
    )
    expected = raw.agg(F.count(F.lit(1))).scalar()
    facts = stats.withColumns(
        {
            "label_in_train": F.lit(LABEL in train.columns),
            "label_in_test": F.lit(LABEL in test.columns),
            "rows_conserved": F.col("train_rows") + F.col("test_rows") == expected,
        }
    )
    return facts.withColumn(
        "passed",
        (F.col("train_nulls") == 0)
        & (F.col("test_nulls") == 0)
        & F.col("label_in_train")
        & ~F.col("label_in_test")
        & F.col("rows_conserved"),
    )


def nullity(columns: list[str]) -> Column:
    """Number of nulls (or NaNs, for doubles read from text) in a row."""
    return sum((F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).cast("long") for c in columns).alias("nulls")


def require(gate: DataFrame) -> None:
    """Raise when a one-row gate did not pass."""
    row = gate.first()
    if not row["passed"]:
        raise ValueError(f"data gate failed: {row.asDict()}")
