"""Repeated passages across a corpus by a logarithmic family of suffix arrays over sampled suffixes.

A window is a string of ``length`` bytes. Of the byte grams in a window the one with the smallest hash is its anchor, so
equal windows have equal anchors at equal places, and consecutive windows mostly share one: a stretch. The suffixes that
start at anchors are the sample. Batches of them, sorted by fingerprint, stream into one index per bucket of
fingerprints, where each is merge-scanned against the levels that are there:

* two stretches that are alike throughout are repeated as a whole,
* where anchors agree and stretches do not, a repeat begins or ends somewhere. These stretches' windows take longer anchors, almost as
  long as a window, and go through a second index: nearly all of them find no partner there and are clear. What is still unclear
  goes through a third one, one suffix per window, which finds the exact byte.

Before anything is shuffled, each chunk settles what it can by itself and sends one entry per fingerprint, so that a passage
in a third of all documents reaches a bucket once per chunk and not once per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.log_index import Entries, LogIndex
from cardwatch.llm.shared import store_texts, write_once
from cardwatch.llm.spans import PAD, Chunk, chunks, mix, ranges

LENGTH = 200
GRAM = 64
#: A longer anchor is this much shorter than a window.
_SLACK = 16
#: Bits that order equal anchor hashes in a window by place, the first one first.
_PLACE = 28
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1

# What a row of the exchange holds.
ENTRIES, REPEATED, UNCLEAR = range(3)
_BLOCK = "bucket int, kind int, n int, key binary, body binary, uid binary, at binary, count binary, told binary"
_NAMES = [f.split()[0] for f in _BLOCK.split(", ")]
_TYPES = (np.uint64, np.uint64, np.int64, np.int32, np.int32, np.int8)


@lru_cache(maxsize=1)
def _bytes_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n, kept by the worker for the largest n so far."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


class Prefixes:
    """Fingerprints of any substrings of a chunk, from sums over its prefixes."""

    def __init__(self, chunk: Chunk):
        power, self.inverse = _power_tables(chunk.size + 1)
        self.sums = np.zeros(chunk.size + 1, np.uint64)
        np.cumsum(_bytes_table()[chunk.data[: chunk.size]] * power[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        h = (self.sums[starts + lengths] - self.sums[starts]) * self.inverse[starts]
        return mix(h + np.asarray(lengths).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, n: int) -> np.ndarray:
        return mix((self.sums[n:] - self.sums[:-n]) * self.inverse[: len(self.sums) - n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, ~np.uint64(0))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def all_windows(chunk: Chunk, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a chunk as runs: (text, first window, windows)."""
    return np.arange(chunk.rows), np.zeros(chunk.rows, np.int64), np.maximum(np.diff(chunk.offsets) - length + 1, 0)


def stretches(
    chunk: Chunk, length: int, gram: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``runs`` (text, first window, windows), in order, cut where the anchor changes: (text, first window in it, windows,
    fingerprint of the anchor, of the whole stretch)."""
    none = np.zeros(0, np.int64)
    text, at, count = runs
    if chunk.size < length or not count.sum():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefixes = Prefixes(chunk)
    hashes = prefixes.grams(gram)
    place = np.arange(len(hashes), dtype=np.uint64) & np.uint64((1 << _PLACE) - 1)
    ordered = (hashes & ~np.uint64((1 << _PLACE) - 1)) | place
    least = sliding_least(ordered, length - gram + 1)
    at, text = ranges(chunk.offsets[text] + at, count), np.repeat(text, count)
    low = (least[at] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    anchor = at + ((low - at) & ((1 << _PLACE) - 1))
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, anchor, text = at[first], anchor[first], text[first]
    body = prefixes.of(start, count + length - 1)
    # Stretches are alike only if their anchors stand at the same place in them.
    body = mix(body + (anchor - start).astype(np.uint64))
    return text, start - chunk.offsets[text], count, hashes[anchor], body


def _planes(column: np.ndarray) -> bytes:
    """The bytes of an array, place by place, which compresses better."""
    return column.reshape(-1, 1).view(np.uint8).T.tobytes()


def _from_planes(raw: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(-1, n).T.copy().view(kind).reshape(-1) if n else np.zeros(0, kind)


def _blocks(entries: Entries, kind: int, buckets: int) -> Iterator[list]:
    """Rows of the exchange: entries dealt out by key, results by owner."""
    by = entries.key if kind == ENTRIES else mix(entries.uid.astype(np.uint64))
    bucket = (by % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        own = entries.take(order[cuts[b] : cuts[b + 1]])
        yield [int(b), kind, own.size, *[_planes(c.astype(t)) for c, t in zip(own, _TYPES)]]


def _rows(blocks: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
    columns = zip(*blocks) if blocks else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], _NAMES)


def _settled(entries: Entries) -> tuple[Entries, Entries, Entries]:
    """What a chunk knows by itself: (entries to send, repeated ones, unclear ones)."""
    index = LogIndex()
    like, unlike = index.add(entries)
    sent = [level for level in index.levels]
    return Entries.join([like.take(np.zeros(0, np.int64)), *sent]), like, unlike


def _through_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket range: entries stream into the index, results of chunks pass, all come out as runs of windows."""
    indexes: dict[int, LogIndex] = {}
    for part in (batch.slice(at, 64) for batch in batches for at in range(0, batch.num_rows, 64)):
        out: list[tuple[int, Entries]] = []
        for row in part.to_pylist():
            entries = Entries(*[_from_planes(row[c], t, row["n"]) for c, t in zip(_NAMES[3:], _TYPES)])
            if row["kind"] == ENTRIES:
                like, unlike = indexes.setdefault(row["bucket"], LogIndex()).add(entries)
                out += [(REPEATED, like), (UNCLEAR, unlike)]
            else:
                out.append((row["kind"], entries))
        for kind in (REPEATED, UNCLEAR):
            runs = Entries.join([e for k, e in out if k == kind]) if any(k == kind for k, _ in out) else None
            if runs is None or not runs.size:
                continue
            uid, at, count = _joined(runs.uid, runs.at.astype(np.int64), runs.count.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(uid), kind, np.int32)), pa.array(uid), pa.array(at), pa.array(count)],
                ["kind", "uid", "at", "count"],
            )


def _joined(uid: np.ndarray, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one owner that touch or overlap become one."""
    if not len(uid):
        return uid, at, count
    order = np.lexsort((at, uid))
    uid, at, end = uid[order], at[order], (at + count)[order]
    # Ends that never fall within an owner, and never reach the next owner's.
    owner = np.cumsum(np.append(0, uid[1:] != uid[:-1])) * (np.int64(1) << 40)
    reach = np.maximum.accumulate(end + owner)
    new = np.ones(len(uid), bool)
    new[1:] = (at + owner)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(uid)) - 1
    return uid[first], at[first], (reach - owner)[last] - at[first]


def _exchange(blocks: DataFrame, buckets: int) -> DataFrame:
    """Every bucket's blocks in one task each, through the index."""
    return blocks.repartition(buckets, "bucket").mapInArrow(_through_index, "kind int, uid long, at long, count long")


def _runs_of(chunk: Chunk, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A column of runs of windows, touching ones joined: (text, first window, windows)."""
    own = runs.slice(chunk.first, chunk.rows)
    text = np.repeat(np.arange(chunk.rows), pc.list_value_length(own).to_numpy())
    flat = own.flatten()
    return _joined(text, *(flat.field(k).to_numpy() for k in range(2)))


def repeated_windows(texts: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(uid, at, count): ``count`` windows of ``length`` bytes, from byte ``at`` on, that also start elsewhere.

    ``texts`` (uid, text) is read several times, so its uids must be stored. Rows may overlap each other, but none is missing.
    """
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.select("uid", "text")

    def anchors(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1), _CHUNK):
                runs = _runs_of(chunk, batch.column(2)) if batch.num_columns > 2 else all_windows(chunk, length)
                text, at, count, key, body = stretches(chunk, length, gram, runs)
                own = Entries(key, body, uids[chunk.first + text], at, count, np.zeros(len(key), np.int8))
                sent, like, unlike = _settled(own)
                yield _rows([*_blocks(sent, ENTRIES, buckets), *_blocks(like, REPEATED, buckets), *_blocks(unlike, UNCLEAR, buckets)])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1), _CHUNK):
                text, at, count = _runs_of(chunk, batch.column(2))
                place, text = ranges(at, count), np.repeat(text, count)
                key = Prefixes(chunk).of(place + chunk.offsets[text], length)
                none = np.zeros(len(key), np.uint64)
                made = Entries(key, none, uids[chunk.first + text], place, np.ones(len(key), np.int64), none.astype(np.int8))
                sent, like, _ = _settled(made)
                yield _rows([*_blocks(sent, ENTRIES, buckets), *_blocks(like, REPEATED, buckets)])

    def unclear(found: DataFrame, of: DataFrame) -> DataFrame:
        """Texts with their unclear runs. Written first, so that Spark knows its size when it plans the join."""
        listed = F.collect_list(F.struct("at", "count")).alias("runs")
        runs = write_once(found.filter(F.col("kind") == UNCLEAR).groupBy("uid").agg(listed), "unclear", "zstd")
        return of.join(runs, "uid").select("uid", "text", "runs")

    longer = max(gram, length - _SLACK)
    levels = [write_once(_exchange(texts.mapInArrow(lambda b: anchors(b, gram), _BLOCK), buckets), "stretches", "zstd")]
    again = unclear(levels[0], texts).mapInArrow(lambda b: anchors(b, longer), _BLOCK)
    levels.append(write_once(_exchange(again, buckets), "long-stretches", "zstd"))
    exact = unclear(levels[1], texts).mapInArrow(windows, _BLOCK)
    levels.append(write_once(_exchange(exact, buckets), "windows", "zstd"))
    return reduce(DataFrame.unionByName, [found.filter(F.col("kind") == REPEATED).drop("kind") for found in levels])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """Every text without the bytes that a string of ``length`` bytes covers which also starts anywhere else.

    Returns one row per input row: doc_id, n_bytes, removed (array of (start, end), bytes, end exclusive, maximal), kept
    (binary: the remaining bytes, which need not be valid UTF-8). Strings are judged on the input as it is, overlapping
    occurrences and occurrences in the same text count, and no string crosses texts.

    A null text counts as empty; texts shorter than ``length`` stay whole; a repeated row repeats every string of its own.
    Other columns are ignored, whatever their names; an empty table gives an empty result. ``docs`` is scanned
    once and stored with a uid per row.
    """
    texts = store_texts(docs, id_col, text_col)
    runs = repeated_windows(texts, length=length, gram=gram)
    listed = runs.groupBy("uid").agg(F.collect_list(F.struct("at", "count")).alias("runs"))
    rows = texts.join(listed, "uid", "left").select("doc_id", "text", "runs")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), _CHUNK):
                own = batch.column(2).slice(chunk.first, chunk.rows)
                text = np.repeat(np.arange(chunk.rows), pc.list_value_length(own).fill_null(0).to_numpy())
                flat = own.flatten()
                at, count = (flat.field(k).to_numpy() for k in range(2))
                # A run of windows covers its windows' bytes; runs less than a window apart cover one piece.
                text, start, size = _joined(text, at, count + length - 1)
                gone = np.zeros(chunk.size + 1, np.int32)
                np.add.at(gone, chunk.offsets[text] + start, 1)
                np.add.at(gone, chunk.offsets[text] + start + size, -1)
                kept = np.cumsum(gone[:-1]) == 0
                left = np.append(0, np.cumsum(kept))[chunk.offsets].astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(start), pa.array(start + size)], ["start", "end"])
                cuts = np.searchsorted(text, np.arange(chunk.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.rows),
                        pa.array(np.diff(chunk.offsets)),
                        pa.ListArray.from_arrays(pa.array(cuts), spans),
                        pa.Array.from_buffers(
                            pa.binary(), chunk.rows, [None, pa.py_buffer(left), pa.py_buffer(chunk.data[:-PAD][kept])]
                        ),
                    ],
                    ["doc_id", "n_bytes", "removed", "kept"],
                )

    return rows.mapInArrow(cut, f"doc_id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
