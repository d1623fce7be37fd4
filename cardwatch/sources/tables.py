"""Transaction tables in and out: CSV or Parquet, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from cardwatch.schema import ID, SPLIT, TEST_SCHEMA, TRAIN_SCHEMA


def read_transactions(
    spark: SparkSession, path: str, split: str, fmt: str = "csv", *, mode: str = "FAILFAST"
) -> DataFrame:
    """Raw transactions of one split, columns bound by name. Types are declared, so no pass over the file infers them.

    A CSV header may have the columns in any order; a missing or further column is an error. NaN is read as missing.
    """
    schema: StructType = TRAIN_SCHEMA if split == "train" else TEST_SCHEMA
    reader = spark.read
    if fmt == "csv":
        found = spark.read.option("header", True).csv(path).columns
        if sorted(found) != sorted(schema.names):
            raise ValueError(f"columns {found} in place of {schema.names}")
        in_file = StructType([schema[name] for name in found])
        # With enforceSchema off, every file's own header is checked as well.
        reader = reader.option("header", True).option("mode", mode).option("enforceSchema", False).schema(in_file)
    else:
        reader = reader.schema(schema)
    numbers = {f.name for f in schema if isinstance(f.dataType, DoubleType)}
    columns = [F.when(~F.isnan(c), F.col(c)).alias(c) if c in numbers else F.col(c) for c in schema.names]
    return reader.format(fmt).load(path).select(*columns).withColumn(SPLIT, F.lit(split))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def read_engineered(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train features, test features and test ids from one engineered table split by partition."""
    table = spark.read.parquet(path)
    train = table.filter(F.col(SPLIT) == "train").drop(SPLIT)
    test = table.filter(F.col(SPLIT) == "test").drop(SPLIT, "is_fraud")
    return train, test, test.select(ID)


def id_sidecar(test: DataFrame) -> DataFrame:
    """The ids a prediction file has to cover."""
    return test.select(ID)


def id_range(test: DataFrame) -> DataFrame:
    return test.agg(
        F.min(ID).alias("min_id"),
        F.max(ID).alias("max_id"),
        F.count(F.lit(1)).alias("n_ids"),
    )
