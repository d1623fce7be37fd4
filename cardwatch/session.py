"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "cardwatch") -> SparkSession:
    """A session for one machine. On a cluster, use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only in a local session that names none (a test on one machine) is a temporary folder set.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cardwatch-checkpoint-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{shared_dir(spark)}/cardwatch/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, partition_by: list[str] | None) -> DataFrame:
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def settle(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, as Parquet, and go on from the written table.

    Cuts the lineage, survives lost executors, and lets several consumers share one computation, each reading
    only its columns, and its partitions of ``partition_by``.
    """
    return _written(df, scratch_path(df.sparkSession, "settled"), partition_by)


def discard(spark: SparkSession, path: str) -> None:
    """Delete what ``scratch_path`` named."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settled(df: DataFrame) -> Iterator[DataFrame]:
    """``settle`` for a table that is not needed afterwards: it is deleted at the end."""
    path = scratch_path(df.sparkSession, "settled")
    try:
        yield _written(df, path, None)
    finally:
        discard(df.sparkSession, path)
