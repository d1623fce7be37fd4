"""Score transactions as they arrive: the same features and a saved model, no state."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwatch.operators.encode import encode, engineer_features
from cardwatch.plans.training import score
from cardwatch.schema import ID, TEST_SCHEMA


def read_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(TEST_SCHEMA).format(fmt).load(path)


def score_stream(stream: DataFrame, model: PipelineModel, merchants: list[str], threshold: float = 0.5) -> DataFrame:
    scored = score(model, encode(engineer_features(stream), merchants), [ID])
    return scored.select(ID, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("is_fraud"))


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored rows to Parquet; takes what is there and ends."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
