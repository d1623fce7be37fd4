"""Rows packed into blocks of numbers, for learners that read all values many times."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from cardwatch.learners.binning import matrix, rows_without_copies
from cardwatch.session import discard, scratch_path

#: Rows of one block, at most.
BLOCK_ROWS = 1 << 14
#: With more partitions than this, tasks' results are merged by other tasks before they reach the driver; unless their bytes are fewer.
MERGED_BY_DRIVER, BYTES_BY_DRIVER = 8, 1 << 25


@dataclass
class Block:
    """``x`` is (rows, features), ``y`` 0 or 1."""

    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    def rows_without(self, fold: int | None) -> np.ndarray | slice:
        return slice(None) if fold is None else np.flatnonzero(self.fold != fold)


@dataclass
class Blocks:
    """The written blocks, kept in memory as far as they fit; the table behind them stays, so a lost executor costs a read."""

    stored: DataFrame
    width: int
    #: Rows by (fold, class).
    counts: dict[tuple[int, int], int]
    parts: int

    def sizes(self, held_out: int | None) -> tuple[int, int]:
        """(negatives, positives) outside a fold."""
        return tuple(sum(n for (fold, y), n in self.counts.items() if y == c and fold != held_out) for c in (0, 1))

    def summed(
        self,
        count: Callable[[list[Block], Callable[[int], bool]], Iterator[tuple]],
        merge: Callable,
        end: Callable | None = None,
        task_bytes: int | None = None,
    ) -> dict[tuple, list[np.ndarray]]:
        """``count`` makes (key, part, arrays) of the blocks of one task, for the keys it is told to; ``merge`` joins the arrays of
        two with the same (key, part).

        ``end`` shortens what is merged, given (key, part, arrays), before it is sent to the driver.
        ``task_bytes``: what a task makes, if that is known.
        """
        many = self.parts > MERGED_BY_DRIVER and (task_bytes is None or self.parts * task_bytes > BYTES_BY_DRIVER)
        width, spread = self.width, many or end is not None
        schema = "key int, part int, arrays array<binary>, types array<string>"

        def rows_of(held: dict[tuple, list[np.ndarray]]) -> pa.RecordBatch:
            flat = [(*k, [a.tobytes() for a in arrays], [a.dtype.str for a in arrays]) for k, arrays in held.items()]
            columns = zip(*flat) if flat else [[]] * 4
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "part", "arrays", "types"])

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shared: dict[tuple[int, int], list[Block]] = {}
            for batch in batches:
                for row in rows_without_copies(batch):
                    shared.setdefault((row["share"], row["shares"]), []).append(_unpacked(row, width))
            for (share, shares), blocks in shared.items():
                own = lambda key, share=share, shares=shares: key % shares == share
                yield rows_of({(key, part): arrays for key, part, arrays in count(blocks, own)})

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list[np.ndarray]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    _merge_into(held, row, merge)
            if end is not None:
                held = {k: end(*k, arrays) for k, arrays in held.items()}
            yield rows_of(held)

        found = self.stored.mapInArrow(counted, schema)
        if spread:
            # As many tasks as run at a time: each is a job's overhead.
            found = found.repartition(self.stored.sparkSession.sparkContext.defaultParallelism, "key", "part").mapInArrow(merged, schema)
        held: dict[tuple, list[np.ndarray]] = {}
        for row in found.collect():
            _merge_into(held, row, merge)
        return held


def _merge_into(held: dict[tuple, list[np.ndarray]], row, merge: Callable) -> None:
    key = (row["key"], row["part"])
    arrays = [np.frombuffer(a, t) for a, t in zip(row["arrays"], row["types"])]
    held[key] = merge(held[key], arrays) if key in held else arrays


def _unpacked(row: dict, width: int) -> Block:
    return Block(
        np.frombuffer(row["x"]).reshape(-1, width), np.frombuffer(row["y"], np.uint8), np.frombuffer(row["fold"], np.int32)
    )


@contextmanager
def packed(rows: DataFrame) -> Iterator[Blocks]:
    """Blocks of ``rows`` (x array of one length without missing values, y boolean, fold int), deleted at the end.

    If there are fewer blocks than cores, each is there several times, for another share of the keys each.
    """
    found = {(r["fold"], int(r["y"])): r["count"] for r in rows.groupBy("fold", "y").count().collect()}
    n_rows = sum(found.values())
    if not n_rows:
        raise ValueError("no rows to fit")
    width = len(rows.select("x").first()[0])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                values = matrix(part.column("x"), width)
                if np.isnan(values).any():
                    raise ValueError("missing values among the features")
                rest = [part.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (("y", np.uint8), ("fold", np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in (values, *rest)], ["x", "y", "fold"])

    spark, path = rows.sparkSession.newSession(), scratch_path(rows.sparkSession, "values")
    # Many small jobs over one table: there is nothing to plan anew while they run.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    n_parts = max(1, -(-n_rows // BLOCK_ROWS))
    dealt = rows.select("x", "y", "fold").repartition(n_parts)
    made = dealt.mapInArrow(pack, "x binary, y binary, fold binary")
    shares = max(1, spark.sparkContext.defaultParallelism // n_parts)
    try:
        made.write.parquet(path)
        stored = spark.read.schema(made.schema).parquet(path)
        stored = stored.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("shares", F.lit(shares))
        if shares > 1:
            stored = stored.repartition(n_parts * shares, "share")
        stored = stored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield Blocks(stored, width, found, stored.rdd.getNumPartitions())
        finally:
            stored.unpersist()
    finally:
        discard(spark, path)
