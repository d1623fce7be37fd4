"""Exact duplicates by merging sorted digest runs in binomial rounds and handing the winners down again.

Every input partition is a run of digests. In round ``k`` each run meets the run whose number differs in bit ``k``: the two
are dealt out by ranges of (merged run, digest), sorted, and merged in one pass over neighbours. Rows equal in digest and
length meet there, and only the best identifier and a count go on, as one row of the merged run. Every level is written
once, sorted. After ``log2(runs)`` rounds one run is left, split by ranges of digests over many tasks. The winners of texts
that occur more than once go down the same tree, so no task ever receives more than two rows of a digest per merged
run on the way, nor more than one partition's copies at the leaves, even if a third of all rows are copies of one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import lower_ascii, store_rows, write_once


def digest_runs(docs: DataFrame, id_col: str, text_col: str, uid_col: str | None = None) -> DataFrame:
    """One row per document: row_uid, doc_id, digest (of the text with A-Z lower-cased), octets, run; runs are sorted."""
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    uid = F.monotonically_increasing_id() if uid_col is None else F.col(uid_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), uid.alias("row_uid"), text.alias("__text")).select(
        "doc_id",
        "row_uid",
        F.unhex(F.sha2("__text", 256)).alias("digest"),
        F.octet_length("__text").cast("long").alias("octets"),
        F.spark_partition_id().alias("run"),
    )
    return write_once(rows.sortWithinPartitions("digest"), "digest-runs")


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan_in: int = 2,
    uid_col: str | None = None,
) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z.

    Returns one row per input row: row_uid (``uid_col``, or the position in the one scan), doc_id, digest (SHA-256, binary), keep_id,
    group_size, kept. ``keep`` says whether the ``largest`` or the ``smallest`` id of a group stays. Two texts count as
    equal only if digest and length in bytes agree. ``fan_in`` runs merge into one per round.

    Null texts count as empty, and all empty texts are one group. A null id ranks below every id. Among repeated rows
    with the kept id, the one that comes last (``largest``) or first in the scan stays, so exactly one row per group is
    kept. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    best = F.max if keep == "largest" else F.min
    leaves = digest_runs(docs, id_col, text_col, uid_col)
    same = ["digest", "octets"]
    # min() orders nulls first, and a null id must lose under either rule.
    rank = F.struct(F.col("doc_id").isNull() if keep == "smallest" else F.col("doc_id").isNotNull(), "doc_id", "row_uid")
    runs = (leaves.agg(F.max("run")).first()[0] or 0) + 1

    # Copies within a run become one row before anything moves.
    first = leaves.groupBy("run", *same).agg(best(rank).alias("best"), F.count("*").alias("copies"))
    levels = [write_once(first, "digest-level")]
    merged = F.floor(F.col("run") / fan_in).cast("int")
    while runs > 1:
        runs = -(-runs // fan_in)
        met = levels[-1].withColumn("run", merged).repartitionByRange("run", "digest").sortWithinPartitions("run", *same)
        level = met.groupBy("run", *same).agg(best("best").alias("best"), F.sum("copies").alias("copies"))
        levels.append(write_once(level, "digest-level"))

    # A text that occurs once is its own winner and needs no message.
    won = levels.pop().filter("copies > 1")
    for level in reversed(levels):
        members = level.select(*same, F.col("run").alias("own"), merged.alias("run"))
        won = members.join(won, [*same, "run"]).select(*same, F.col("own").alias("run"), "best", "copies")
    return leaves.join(won, [*same, "run"], "left").select(
        "row_uid",
        "doc_id",
        "digest",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row_uid") == F.col("best.row_uid"), F.lit(True)).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns. ``docs`` is scanned once."""
    rows, uid = store_rows(docs)
    decided = exact_duplicates(rows, id_col=id_col, text_col=text_col, keep=keep, uid_col=uid)
    # What stays grows with the input, so it is never broadcast.
    stay = decided.filter("kept").select(F.col("row_uid").alias(uid)).hint("merge")
    return rows.join(stay, uid, "left_semi").drop(uid)
