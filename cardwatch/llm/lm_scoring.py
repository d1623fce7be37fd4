"""Stupid-backoff scores of all documents against the rest of the corpus.

Documents are dealt to chunks once, and stored with their chunk. N-grams are counted in tables partitioned by hash. Each chunk of documents counts its own n-grams first and sends every
bucket one sorted block; the bucket adds up all blocks and sends each chunk the totals of the n-grams it asked for, so a
frequent n-gram costs a bucket one entry per chunk. Totals meet the chunk's documents again by chunk, each document's own
counts are taken off, and scores are summed per document. What is exchanged grows with the corpus' n-grams; nothing is
collected but one number, the corpus' word count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import write_once
from cardwatch.llm.spans import Chunk, chunks, folded_words, hash_spans, mix, ranges

ORDER = 3
BACKOFF = 0.4
#: Log scores are whole multiples of 1/UNIT, so that sums do not depend on their order.
UNIT = 1_000_000
_CHUNK = 8 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngrams(chunk: Chunk, order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per n from 1 to ``order``: hashes of the n-grams by their first word, and those first words; then texts' bounds."""
    data, starts, lengths, bounds = folded_words(chunk)
    words = hash_spans(data, starts, lengths)
    hashes, places = [], []
    h = mix(words + _STEP)
    for n in range(1, order + 1):
        at = ranges(bounds[:-1], np.maximum(np.diff(bounds) - n + 1, 0))
        hashes.append(h[at])
        places.append(at)
        h = mix(h[:-1] * _STEP + words[n:]) if len(h) else h
    return hashes, places, bounds


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(values).reshape(-1, 1).view(np.uint8).T.tobytes(), 1)


def _unpack(raw: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(-1, n).T.copy().view(kind).reshape(-1)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted keys. A bucket is a range of hashes, so that steps within it are short."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))


def _numbered_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, Chunk]]:
    """Chunks with ids that no other task gives."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for chunk in chunks(batch.column(1), _CHUNK):
            yield number, batch, chunk
            number += 1


def _stored_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    """The stored chunks of a task. A chunk that is split between tasks comes in parts."""
    held, pieces = 0, []
    for batch in batches:
        ids = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1), len(ids)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if pieces and (a == b or ids[a] != held):
                yield held, *chunks(pa.concat_arrays(pieces), 1 << 62)
                pieces = []
            if a < b:
                held = int(ids[a])
                pieces.append(batch.column(1).slice(a, b - a))
    if pieces:
        yield held, *chunks(pa.concat_arrays(pieces), 1 << 62)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts over all parts of a chunk."""
    if len(parts) == 1:
        return parts[0]
    keys, kind = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(kind, np.concatenate([c for _, c in parts])).astype(np.int64)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """Mean log score of every document under the counts of all other documents.

    The score of a word after the up to ``order`` - 1 words before it in its document is the count of the whole n-gram over
    the count of the words before it, if other documents have the n-gram; else ``backoff`` times the score after one
    word less. A single word scores its count over the number of words, or 1 over that number plus 1 if no other document
    has it. Words stand between blanks, with A-Z lower-cased.

    Returns one row per input row: doc_id, n_words, n_by_order (array of long: words scored with an n-gram of 1, 2, ...
    words), n_unseen (words of the first kind that no other document has), log_sum (long, in units of 1/UNIT), score
    (mean natural logarithm, null without words). A null text counts as empty. A repeated row is another document. Null
    ids pass through; other columns are ignored, whatever their names; an empty table gives an empty result. ``docs``
    is scanned once and stored with each row's chunk.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, batch, chunk in _numbered_chunks(batches):
            own = batch.slice(chunk.first, chunk.rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(chunk.rows, at)), *own.columns], ["chunk", "doc_id", "text"])

    numbered = write_once(texts.mapInArrow(number, f"chunk long, doc_id {kind}, text string"), "chunks", "zstd")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _stored_chunks(batches):
            blocks = []
            for n, hashes in enumerate(ngrams(chunk, order)[0], 1):
                keys, counts = np.unique(hashes, return_counts=True)
                cuts = _cuts(keys, buckets)
                for b in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[b], cuts[b + 1])
                    steps = np.diff(keys[own], prepend=np.uint64(0))
                    blocks.append((number, int(b), n, len(steps), _pack(steps), _pack(counts[own].astype(np.uint32))))
            if blocks:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*blocks), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "n", "size", "steps", "counts"])

    def total(table: pa.Table) -> pa.Table:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for chunk, size, steps, counts in zip(*(table.column(c).to_pylist() for c in ("chunk", "size", "steps", "counts"))):
            own = np.cumsum(_unpack(steps, np.uint64, size)), _unpack(counts, np.uint32, size)
            parts.setdefault(chunk, []).append(own)
        keys, counts = zip(*map(_merged, parts.values()))
        sizes = [len(k) for k in keys]
        _, kind = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(kind, np.concatenate(counts)).astype(np.int64)[kind]
        cuts = np.cumsum([0, *sizes])
        return pa.table(
            {
                "chunk": pa.array(list(parts), pa.int64()),
                "bucket": table.column("bucket").slice(0, len(parts)),
                "n": table.column("n").slice(0, len(parts)),
                "size": pa.array(sizes, pa.int32()),
                "words": pa.array([int(c.sum()) for c in counts], pa.int64()),
                "totals": pa.array([_pack(sums[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
            }
        )

    blocks = numbered.select("chunk", "text").mapInArrow(count, "chunk long, bucket int, n int, size int, steps binary, counts binary")
    totals = blocks.groupBy("bucket", "n").applyInArrow(
        total, "chunk long, bucket int, n int, size int, words long, totals binary"
    )
    totals = write_once(totals, "ngram-totals")
    words = totals.filter("n = 1").agg(F.sum("words")).first()[0] or 0

    def others(hashes: np.ndarray, text: np.ndarray, held: list[dict]) -> np.ndarray:
        """How often other documents have each n-gram."""
        keys, kind, own = np.unique(hashes, return_inverse=True, return_counts=True)
        cuts = _cuts(keys, buckets)
        sums = np.zeros(len(keys), np.int64)
        for block in held:
            place = slice(cuts[block["bucket"]], cuts[block["bucket"] + 1])
            if place.stop - place.start != block["size"]:
                raise RuntimeError("a chunk's totals do not fit its n-grams")
            sums[place] = _unpack(block["totals"], np.int64, block["size"])
        _, pair, times = np.unique(text * len(keys) + kind, return_inverse=True, return_counts=True)
        return sums[kind] - times[pair]

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, blocks = left.num_rows, right.to_pylist()
        (chunk,) = chunks(left.column("text").combine_chunks(), 1 << 62)
        hashes, places, bounds = ngrams(chunk, order)
        text = np.repeat(np.arange(rows), np.diff(bounds))
        counts = []
        for n in range(1, order + 1):
            held = np.zeros(len(text), np.int64)
            held[places[n - 1]] = others(hashes[n - 1], text[places[n - 1]], [b for b in blocks if b["n"] == n])
            counts.append(held)
        depth = np.minimum(np.arange(len(text)) - bounds[:-1][text] + 1, order)
        rest = words - np.diff(bounds)[text]
        used = np.ones(len(text), np.int64)
        value = np.where(counts[0] > 0, counts[0] / np.maximum(rest, 1), 1 / (rest + 1))
        for n in range(2, order + 1):
            # The n-gram that ends at a word starts n - 1 words before it.
            whole = np.append(np.zeros(n - 1, np.int64), counts[n - 1])[: len(text)]
            before = np.append(np.zeros(n - 1, np.int64), counts[n - 2])[: len(text)]
            seen = (depth >= n) & (whole > 0)
            value = np.where(seen, whole / np.maximum(before, 1), np.where(depth >= n, backoff * value, value))
            used[seen] = n
        logs = np.rint(np.log(value) * UNIT).astype(np.int64)
        tally = np.bincount(text * order + used - 1, minlength=rows * order)[: rows * order]
        unseen = np.bincount(text[counts[0] == 0], minlength=rows)
        sums = np.append(0, np.cumsum(logs))[bounds]
        n_words, log_sum = np.diff(bounds), np.diff(sums)
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "n_words": pa.array(n_words),
                "n_by_order": pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * order), pa.array(tally)),
                "n_unseen": pa.array(unseen),
                "log_sum": pa.array(log_sum),
                "score": pa.array(log_sum / UNIT / np.maximum(n_words, 1), mask=n_words == 0),
            }
        )

    return (
        numbered.groupBy("chunk")
        .cogroup(totals.drop("words").groupBy("chunk"))
        .applyInArrow(
            rate, f"doc_id {kind}, n_words long, n_by_order array<long>, n_unseen long, log_sum long, score double"
        )
    )
