"""Importance resampling towards a target collection, with features counted once per distinct line.

Features are hashed runs of one to three words. A text is cut at its newlines, which always separate words: runs inside a line
are the same wherever the line stands, so they are counted once per distinct line and multiplied by its occurrences, and so is
the line's share of a weight. Runs that cross lines depend on their surroundings and are added per document.

Two tables come out of one pass each and serve both questions, how often a bucket occurs and what a document weighs: ``lines``
(key, n, n_words, buckets) and ``documents`` (uid, doc_id, keys of its lines, buckets of what crosses lines). No text is stored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import join_by_key, lower_ascii, write_once
from cardwatch.llm.spans import NOT_ALPHANUMERIC, chunks, folded_words

ORDER = 3
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42

_CHUNK = 1 << 20
_FULL = np.uint32(0xFFFFFFFF)
#: Words up to this many bytes are hashed side by side, longer ones one by one.
_SHORT = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_CRC = _crc_table()


def _fed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 states after the bytes of one span each."""
    state = state.copy()
    live = np.flatnonzero((lengths > 0) & (lengths <= _SHORT))
    step = 0
    while len(live):
        held = state[live]
        state[live] = (held >> np.uint32(8)) ^ _CRC[(held ^ data[starts[live] + step]) & np.uint32(0xFF)]
        step += 1
        live = live[lengths[live] > step]
    for i in np.flatnonzero(lengths > _SHORT).tolist():
        span = data[starts[i] : starts[i] + lengths[i]].tobytes()
        state[i] = zlib.crc32(span, int(state[i] ^ _FULL)) ^ 0xFFFFFFFF
    return state


def run_buckets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, wanted: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of the run of k + 1 words at each word where ``wanted[:, k]``, row by row.

    A run may only be wanted if all runs of two words and more at its word that it contains stay in the array.
    """
    n = len(starts)
    found = np.zeros((n, wanted.shape[1]), np.uint16)
    state = _fed(np.full(n, _FULL), data, starts, lengths)
    blank = np.full(1, ord(" "), np.uint8)
    for k in range(wanted.shape[1]):
        if k:
            # The run of one word more, at all words that have so many after them.
            state = state[: max(n - k, 0)]
            none = np.zeros(len(state), np.int64)
            state = _fed(_fed(state, blank, none, none + 1), data, starts[k:], lengths[k:])
        found[: len(state), k] = (state ^ _FULL) % np.uint32(buckets)
    return found[wanted]


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int16)))


def _in_lines(buckets: int):
    """Of every line all its runs of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("line"), _CHUNK):
                data, starts, lengths, bounds = folded_words(chunk, NOT_ALPHANUMERIC)
                left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(starts))
                wanted = left[:, None] > np.arange(ORDER)[None, :]
                found = run_buckets(data, starts, lengths, wanted, buckets)
                at = np.append(0, np.cumsum(wanted.sum(axis=1)))[bounds]
                own = batch.slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [own.column("key"), own.column("n"), pa.array(np.diff(bounds)), _lists(at, found)],
                    ["key", "n", "n_words", "buckets"],
                )

    return count


def _across_lines(buckets: int):
    """Of every text the runs of words which a newline interrupts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), _CHUNK):
                data, starts, lengths, bounds = folded_words(chunk, NOT_ALPHANUMERIC)
                line = np.cumsum(data[: chunk.size] == ord("\n"))[starts]
                wanted = np.zeros((len(starts), ORDER), bool)
                left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(starts))
                for k in range(1, ORDER):
                    wanted[: len(starts) - k, k] = (line[k:] != line[: len(starts) - k]) & (left[: len(starts) - k] > k)
                # Words far from any newline need no hash.
                found = _runs_near(data, starts, lengths, np.flatnonzero(wanted.any(axis=1)), wanted, buckets)
                at = np.append(0, np.cumsum(wanted.sum(axis=1)))[bounds]
                own = batch.slice(chunk.first, chunk.rows)
                names = ["uid", "doc_id", "keys"]
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in names], _lists(at, found)], [*names, "buckets"])

    return count


def _runs_near(data, starts, lengths, near, wanted, buckets) -> np.ndarray:
    """``run_buckets`` for the words ``near`` only: the words they reach are laid side by side."""
    reach = np.minimum(near[:, None] + np.arange(ORDER)[None, :], len(starts) - 1).reshape(-1)
    asked = np.zeros((len(reach), ORDER), bool)
    asked[::ORDER] = wanted[near]
    return run_buckets(data, starts[reach], lengths[reach], asked, buckets)


def _key(line: Column) -> Column:
    """16 bytes of a digest stand for a line."""
    return F.substring(F.unhex(F.sha2(line.cast("binary"), 256)), 1, 16)


class Segments:
    """The distinct lines of a table of texts, and each text as its lines and what crosses them; both written once."""

    def __init__(self, docs: DataFrame, buckets: int):
        """``docs``: (doc_id, text). It is scanned twice, but only the second scan numbers its rows, so their order may change."""
        text = lower_ascii(F.coalesce("text", F.lit("")))
        # A line without a word has no features and separates nothing that its newlines do not.
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"))
        distinct = docs.select(F.explode(lines).alias("line")).groupBy("line").agg(F.count("*").alias("n"))
        self.lines = write_once(
            distinct.select(_key(F.col("line")).alias("key"), "n", "line").mapInArrow(
                _in_lines(buckets), "key binary, n long, n_words long, buckets array<smallint>"
            ),
            "lines",
            "zstd",
        )
        rows = docs.select(
            F.monotonically_increasing_id().alias("uid"), "doc_id", F.transform(lines, _key).alias("keys"), F.coalesce("text", F.lit("")).alias("text")
        )
        kind = rows.schema["doc_id"].dataType.simpleString()
        self.documents = write_once(
            rows.mapInArrow(_across_lines(buckets), f"uid long, doc_id {kind}, keys array<binary>, buckets array<smallint>"), "texts", "zstd"
        )

    def bucket_counts(self) -> DataFrame:
        """(bucket, n): at most as many rows as there are buckets."""
        inside = self.lines.select("n", F.explode("buckets").alias("bucket"))
        across = self.documents.select(F.lit(1).cast("long").alias("n"), F.explode("buckets").alias("bucket"))
        return inside.unionAll(across).groupBy("bucket").agg(F.sum("n").alias("n"))

    def parts(self, gains: np.ndarray) -> DataFrame:
        """(uid, doc_id, n_words, n_features, weight): one row per line with a word, without an id, and one per text for what crosses
        its lines."""
        weighed = _weighed(self.lines, ["key", "n_words"], gains)
        places = self.documents.select("uid", F.explode("keys").alias("key"))
        lines = join_by_key(places, weighed, "key", self.lines.select("key", "n"), spread_by="uid")
        across = _weighed(self.documents, ["uid", "doc_id"], gains).withColumn("n_words", F.lit(0).cast("long"))
        return lines.drop("key").unionByName(across, allowMissingColumns=True)


def _weighed(df: DataFrame, keep: list[str], gains: np.ndarray) -> DataFrame:
    """``keep`` and the number and summed gains of each row's buckets."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            count = lists.value_lengths().to_numpy().astype(np.int64)
            sums = np.append(0, np.cumsum(gains[lists.flatten().to_numpy()]))
            ends = np.cumsum(count)
            weight = sums[ends] - sums[ends - count]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(count), pa.array(weight)], [*keep, "n_features", "weight"]
            )

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, "buckets").mapInArrow(add, f"{kinds}, n_features long, weight long")


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the source)) per bucket, both shares with one feature added per bucket.

    ``source`` and ``target``: (bucket, n). What reaches the driver is one number per bucket.
    """
    counts = np.zeros((2, buckets), np.int64)
    for held, table in zip(counts, (source, target)):
        for r in table.collect():
            held[r["bucket"]] = r["n"]
    s, t = counts.astype(float)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of a document by its id: floor(-1000 * ln(-ln(u))), u from the first 8 hex digits of a digest."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Draw documents without replacement in proportion to how much likelier the target makes them (Gumbel top-k).

    Returns one row per input row: doc_id, n_words, n_features, weight, score, rank. Words are runs of digits, letters and
    characters beyond ASCII, with A-Z lower-cased; features are all runs of one to three words. The ``percent`` per cent of the
    documents with at least ``min_words`` words that have the highest scores are drawn, ties by smaller id; their ranks count
    from 1, all others' are null.

    A null or empty text has no feature, weighs 0 and is never drawn. A null id takes the noise of the empty id and comes last
    among ties; repeated rows are rows of their own, all with the same score. An empty target leaves the gains of the
    source's shares; an empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    if not 0 < buckets <= 1 << 15:
        raise ValueError("buckets must fit 16 bits")
    source = Segments(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), buckets)
    aim = Segments(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")), buckets)
    gains = bucket_gains(source.bucket_counts(), aim.bucket_counts(), buckets)

    sums = [F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")]
    weighed = (
        source.parts(gains)
        .groupBy("uid")
        .agg(F.max("doc_id").alias("doc_id"), *sums)
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        .withColumn("eligible", F.col("n_words") >= min_words)
    )
    return ranked(weighed, percent).drop("uid", "eligible")


def ranked(rows: DataFrame, percent: int) -> DataFrame:
    """Add the place of each row among the eligible ones, down to the last that is drawn.

    Rows are dealt out by ranges of the order and written; how many rows lie in the ranges before one is all that a row has to learn.
    """
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    low = F.monotonically_increasing_id()
    placed = write_once(dealt.withColumns({"__range": F.shiftright(low, 33), "__at": low.bitwiseAND((1 << 33) - 1)}), "ranked")
    sizes = placed.groupBy("__range").agg(F.count("*").alias("n"), F.count_if("eligible").alias("eligible")).collect()
    drawn = sum(r["eligible"] for r in sizes) * percent // 100
    sizes.sort(key=lambda r: r["__range"])
    before = itertools.accumulate((r["n"] for r in sizes), initial=0)
    firsts = [(r["__range"], n) for r, n in zip(sizes, before)]
    # One row per range.
    first = rows.sparkSession.createDataFrame(firsts, "__range long, __before long")
    rank = F.col("__before") + F.col("__at") + 1
    return (
        placed.join(F.broadcast(first), "__range")
        .withColumn("rank", F.when(F.col("eligible") & (rank <= drawn), rank))
        .drop("__range", "__at", "__before")
    )
