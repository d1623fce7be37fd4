"""Small helpers of the corpus operators: tables, texts as columns, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def write_once(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the folder all executors share and go on from the written table.

    Cuts the lineage, so that a lost executor costs a read and not a recomputation, and fixes row ids.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, text) of every row, written once: all later passes read the stored uid.

    A row's place differs between two scans if they are split differently, e.g. after an executor was lost.
    """
    uid = F.monotonically_increasing_id().alias("uid")
    return write_once(docs.select(uid, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "texts", "zstd")


def store_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """All columns of ``docs`` with a uid per row, written once, and the name of the uid, which no other column has."""
    uid, taken = "__uid", {c.lower() for c in docs.columns}
    while uid in taken:
        uid += "_"
    return write_once(docs.withColumn(uid, F.monotonically_increasing_id()), "rows", "zstd"), uid


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts in ASCII take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for a row, however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: ``join_by_key`` spreads a key that holds more than one in this many rows.
SHARES = 1000


def hot_keys(counts: DataFrame, key: str, share: int = SHARES) -> DataFrame:
    """(key, __slices) of the keys that hold more than one in ``share`` rows, by ``counts`` (key, n): at most ``share`` of them."""
    whole = counts.agg(F.sum("n")).first()[0] or 0
    slices = F.ceil(F.col("n") * share / F.lit(max(whole, 1))).cast("int")
    return counts.select(key, slices.alias("__slices")).filter("__slices > 1")


def dealt(rows: DataFrame, hot: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Add ``__slice``: rows of a hot key are dealt into its slices. Hot keys are few whatever the size of the tables."""
    place = F.pmod(F.xxhash64(spread_by), F.coalesce("__slices", F.lit(1))).cast("int")
    return rows.join(F.broadcast(hot), key, "left").withColumn("__slice", place).drop("__slices")


def copied(facts: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Add ``__slice``: one copy of a hot key's row for each of its slices."""
    slices = F.sequence(F.lit(0), F.coalesce("__slices", F.lit(1)) - 1)
    return facts.join(F.broadcast(hot), key, "left").withColumn("__slice", F.explode(slices)).drop("__slices")


def join_by_key(rows: DataFrame, facts: DataFrame, key: str, counts: DataFrame, spread_by: str, how: str = "inner") -> DataFrame:
    """Join of ``rows`` with ``facts`` (unique by ``key``) that no hot key holds up; ``counts`` (key, n) are the rows per key."""
    hot = hot_keys(counts, key)
    met = dealt(rows, hot, key, spread_by).join(copied(facts, hot, key), [key, "__slice"], how)
    return met.drop("__slice")
