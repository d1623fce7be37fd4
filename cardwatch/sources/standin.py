"""Transactions and model scores derived from an ``events`` table.

The card-transaction files themselves are not public, so the registered queries run on a table of
the same shape, derived by Spark from the events (definition: FIXTURES.md).
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardwatch.functions.running import running_sums
from cardwatch.schema import LABEL, RAW_COLUMNS, SPLIT, TRAIN_SCHEMA
from cardwatch.session import scratch_path
from cardwatch.sources.tables import write_table

# The event types stand in for the merchant categories.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _hour_index(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def with_velocity(rows: DataFrame) -> DataFrame:
    """Count each user's other events of the last 24 hours.

    Every event enters its user's window at its time and leaves it 24 hours (and an instant)
    later; the running sum of +1 and -1 is the number of live events. Users are cut into hours,
    so a user with a large share of all events is spread over many tasks.
    """
    leaves = F.col("ts") + F.expr("INTERVAL '1 00:00:00.000001' DAY TO SECOND")
    moves = F.array(
        F.struct(F.col("ts").alias("at"), F.lit(1).alias("live")), F.struct(leaves.alias("at"), F.lit(-1).alias("live"))
    )
    moved = rows.select("*", F.inline(moves))
    # The leaving row needs only its user and time; its other columns would be shuffled for nothing.
    slim = moved.selectExpr(
        "user_id",
        "at",
        "live",
        *[f"CASE WHEN live = 1 THEN {c} END AS {c}" for c in rows.columns if c not in ("user_id", "ts")],
    )
    changes = slim.withColumn("hour_index", _hour_index(F.col("at")))
    counted = running_sums(
        changes,
        group=["user_id"],
        bucket="hour_index",
        order=[F.col("at")],
        sums={"in_window": "live"},
    )
    return (
        counted.filter(F.col("live") == 1)
        .withColumn("velocity_last_24h", (F.col("in_window") - 1).cast("int"))
        .drop("at", "live", "hour_index", "in_window")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test transactions in one table, told apart by ``split``."""
    base = events(spark, sf_dir).selectExpr(
        "user_id",
        "ts",
        "event_id AS transaction_id",
        "round(value * 3, 2) AS amount",
        "hour(ts) AS transaction_hour",
        "event_type AS merchant_category",
        "CASE WHEN (event_id * 7 + user_id) % 10 = 3 THEN 1 ELSE 0 END AS foreign_transaction",
        "CASE WHEN (event_id * 31 + user_id * 3) % 13 = 0 THEN 1 ELSE 0 END AS location_mismatch",
        "25 + CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 75 AS device_trust_score",
        "CAST(18 + user_id % 52 AS INT) AS cardholder_age",
        "CASE WHEN event_id % 5 = 4 THEN 'test' ELSE 'train' END AS split",
    )
    label = """CASE WHEN 2 * foreign_transaction + 2 * location_mismatch
            + CASE WHEN device_trust_score < 40 THEN 2 ELSE 0 END
            + CASE WHEN transaction_hour <= 5 THEN 1 ELSE 0 END
            + CASE WHEN velocity_last_24h >= 4 THEN 1 ELSE 0 END
            + CASE WHEN amount > 500 THEN 1 ELSE 0 END
        >= CASE WHEN transaction_id % 7 = 0 THEN 4 ELSE 6 END THEN 1 ELSE 0 END"""
    return with_velocity(base).selectExpr(*RAW_COLUMNS, SPLIT, f"{label} AS {LABEL}")


_written: dict[tuple[str, str], str] = {}
_writing = threading.Lock()


def transactions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived transactions as a written table, as transaction files would be.

    Derived once per application into the shared folder, one directory per split, so that queries
    scan columns and splits they need instead of deriving the whole table again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    with _writing:
        if key not in _written:
            _written[key] = write_table(
                transactions(spark, sf_dir), scratch_path(spark, "transactions"), partition_by=[SPLIT]
            )
    schema = StructType([*TRAIN_SCHEMA.fields, StructField(SPLIT, StringType())])
    return spark.read.schema(schema).parquet(_written[key]).select(*RAW_COLUMNS, SPLIT, LABEL)


def train_rows(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col(SPLIT) == "train").drop(SPLIT)


def test_rows(tx: DataFrame) -> DataFrame:
    """Test rows as a scorer sees them: without the label."""
    return tx.filter(F.col(SPLIT) == "test").drop(SPLIT, LABEL)


def with_scores(tx: DataFrame) -> DataFrame:
    """Three deterministic score columns next to the transactions, each a number of points out of 20."""
    located = "(foreign_transaction + location_mismatch)"
    low_trust = "CAST(device_trust_score < 40 AS INT)"
    night = "CAST(transaction_hour <= 5 AS INT)"
    points = {
        "a": f"4*{located} + 5*{low_trust} + 3*{night} + 2*CAST(velocity_last_24h >= 4 AS INT) + 2*CAST(amount > 500 AS INT)",
        "b": f"6*{located} + 4*{low_trust} + 2*{night} + CAST(velocity_last_24h >= 5 AS INT) + CAST(amount > 300 AS INT)",
        "c": f"4*{located} + 3*{low_trust} + 5*{night} + 2*CAST(velocity_last_24h >= 3 AS INT) + 2*CAST(amount > 200 AS INT)",
    }
    return tx.selectExpr("*", *[f"CAST({p} AS DOUBLE) / 20D AS score_{n}" for n, p in points.items()])


def scores(tx: DataFrame) -> DataFrame:
    """The scores alone, by id, split and label."""
    return with_scores(tx).select("transaction_id", SPLIT, LABEL, "score_a", "score_b", "score_c")
