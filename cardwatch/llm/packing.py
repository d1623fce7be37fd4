"""Packing documents into sequences of a fixed number of tokens: large items matched in pairs, small ones best-fit.

Lengths are whole numbers up to the capacity, so the packing is decided on the histogram of lengths: items of one length
are interchangeable, and so are bins with one gap. The driver holds at most ``capacity`` counts and the resulting runs
(length, first rank, count -> first bin, offset), never items. Each piece then finds its place by its rank among the
pieces of its length; ranks come from counts per partition, so no length meets in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.bpe import encode_chunk
from cardwatch.llm.shared import write_once
from cardwatch.llm.spans import Chunk, chunks, ranges

#: How many encoded pre-tokens a worker remembers before it starts anew.
REMEMBERED = 400_000


class WordEncoder:
    """Ids of single pre-tokens by a tokenizer file, remembered per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens that depend on what stands around them are not supported")
        #: Tokens that stand for themselves wherever a text holds them; the longest one first.
        self.added = {t.content.encode(): i for i, t in added.items()}
        self.any_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        # Those are cut out before; a pre-token is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}

    def resolve(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> list[bytes]:
        raw = data.tobytes()
        pieces = [raw[s : s + n] for s, n in zip(starts.tolist(), lengths.tolist())]
        if len(self.known) + len(pieces) > REMEMBERED:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        coded = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
        self.known.update(zip(new, (np.array(c.ids, "<u4").tobytes() for c in coded)))
        return [self.known[p] for p in pieces]


    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """``encode_chunk`` with added tokens: ids of all texts, and where each text's ids start."""
        raw = chunk.data[: chunk.size].tobytes()
        if self.any_added is None or not self.any_added.search(raw):
            return encode_chunk(chunk, self.resolve)
        edges = chunk.offsets.tolist()
        found = [m for a, b in zip(edges, edges[1:]) for m in self.any_added.finditer(raw, a, b)]
        starts = np.array([m.start() for m in found], np.int64)
        bounds = np.unique(np.concatenate([chunk.offsets, starts, [m.end() for m in found]])).astype(np.int64)
        ids, at = encode_chunk(Chunk(chunk.first, chunk.data, bounds), self.resolve)
        whole = np.isin(bounds[:-1], starts)
        counts = np.diff(at)
        kept = np.repeat(~whole, counts)
        counts = np.where(whole, 1, counts)
        at = np.append(0, np.cumsum(counts))
        out = np.empty(at[-1], np.uint32)
        out[ranges(at[:-1][~whole], counts[~whole])] = ids[kept]
        out[at[:-1][whole]] = [self.added[m.group()] for m in found]
        return out, at[np.searchsorted(bounds, chunk.offsets)]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def token_pieces(
    docs: DataFrame,
    *,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise whole texts, add ``end_id`` to each, and cut those longer than ``capacity``.

    Returns per piece: doc_id, piece (from 0), start (tokens before it), length, ids_crc32 (of the ids as little-endian
    32-bit integers), part and rank (place among the pieces of this length in this partition), and ids if asked for. Of a
    document that is cut, the first piece is the shorter one. ``tokenizer`` is the path of a byte-level BPE file that
    every executor has; its added tokens have their own ids where a text holds them. A null or empty text is the ``end_id`` alone; null ids and repeated rows pass through; other
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found, ends = encoder.encode(chunk)
                ids = np.insert(found.astype("<u4"), ends[1:], end_id)
                ends = ends + np.arange(chunk.rows + 1)
                tokens = np.diff(ends)
                n = -(-tokens // capacity)
                row = np.repeat(np.arange(chunk.rows), n)
                piece = ranges(np.zeros(chunk.rows, np.int64), n)
                head = (tokens - (n - 1) * capacity)[row]
                length = np.where(piece == 0, head, capacity)
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                at = ends[row] + start
                check = [zlib.crc32(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                count = np.bincount(length, minlength=capacity + 1)
                rank = np.empty(len(order), np.int64)
                rank[order] = ranges(np.zeros(capacity + 1, np.int64), count)
                rank += seen[length]
                seen += count
                columns = [
                    batch.column(0).slice(chunk.first, chunk.rows).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array(check, pa.int64()),
                    pa.array(np.full(len(row), part, np.int32)),
                    pa.array(rank),
                ]
                if with_ids:
                    columns.append(
                        pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.view(np.int32)))
                    )
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", *["ids"] * with_ids]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long"
        + ", ids array<int>" * with_ids,
    )


class Bins:
    """Bins in bundles: consecutive numbers with the same gap. Keeps the runs that fill them."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self.bundles: dict[int, list[tuple[int, int]]] = {}
        self.gaps: list[int] = []
        #: length, first rank, pieces, pieces per bin, first bin, offset in the bin
        self.runs: list[tuple[int, int, int, int, int, int]] = []

    def leave(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.bundles:
                self.bundles[gap] = []
                insort(self.gaps, gap)
            self.bundles[gap].append((first, count))

    def best(self, length: int) -> tuple[int, int, int] | None:
        """A bundle with the smallest gap that holds ``length``: gap, first bin, count."""
        i = bisect_left(self.gaps, length)
        if i == len(self.gaps):
            return None
        gap = self.gaps[i]
        first, count = self.bundles[gap].pop()
        if not self.bundles[gap]:
            del self.bundles[gap], self.gaps[i]
        return gap, first, count

    def open(self, count: int) -> int:
        self.opened += count
        return self.opened - count

    def fill(self, length: int, rank: int, pieces: int, gap: int, first: int, count: int) -> int:
        """Put pieces of one length into a bundle, each bin as full as it gets before the next; returns how many fit."""
        per = gap // length
        full = min(count, pieces // per)
        rest = min(pieces - full * per, per - 1) if full < count else 0
        at = self.capacity - gap
        if full:
            self.runs.append((length, rank, full * per, per, first, at))
            self.leave(gap - per * length, first, full)
        if rest:
            self.runs.append((length, rank + full * per, rest, rest, first + full, at))
            self.leave(gap - rest * length, first + full, 1)
        self.leave(gap, first + full + bool(rest), count - full - bool(rest))
        return full * per + rest


def pack_lengths(counts: dict[int, int], capacity: int) -> Bins:
    """Decide the packing of ``counts`` (length -> pieces).

    Lengths above a third of the capacity: from the longest down, each takes the longest one left that fits beside it, so
    a bin holds two at most. Lengths up to a third: from the longest down, each goes to the smallest gap that holds it;
    after one piece that gap is still the smallest for the next, so a whole run is placed at once. New bins are opened
    only where no gap is large enough.
    """
    bins, left, placed = Bins(capacity), dict(counts), dict.fromkeys(counts, 0)
    large = sorted(x for x, n in counts.items() if 3 * x > capacity and n)

    def take(length: int, n: int, first: int, at: int, per: int = 1) -> None:
        bins.runs.append((length, placed[length], n, per, first, at))
        placed[length] += n
        left[length] -= n

    while large:
        x = large[-1]
        i = bisect_left(large, min(x, capacity - x) + 1) - 1
        if i >= 0 and large[i] == x and left[x] == 1:
            i -= 1
        if i < 0:  # nothing fits beside it
            n = left[x]
            first = bins.open(n)
            take(x, n, first, 0)
            bins.leave(capacity - x, first, n)
        elif (y := large[i]) == x:
            n = left[x] // 2
            first = bins.open(n)
            take(x, 2 * n, first, 0, 2)
            bins.leave(capacity - 2 * x, first, n)
        else:
            n = min(left[x], left[y])
            first = bins.open(n)
            take(x, n, first, 0)
            take(y, n, first, x)
            bins.leave(capacity - x - y, first, n)
            if not left[y]:
                large.remove(y)
        if not left[x]:
            large.remove(x)
    for x in sorted((x for x, n in counts.items() if 3 * x <= capacity and n), reverse=True):
        while left[x]:
            found = bins.best(x)
            if found is None:
                n = -(-left[x] // (capacity // x))
                found = capacity, bins.open(n), n
            n = bins.fill(x, placed[x], left[x], *found)
            placed[x] += n
            left[x] -= n
    return bins


def pack(pieces: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """Add sequence_id (from 0, without gaps) and offset to the rows of ``token_pieces``; part and rank go away.

    ``pieces`` should be a written table: it is read twice. Equal input gives equal packing. An empty table gives an
    empty result.
    """
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(pack_lengths(counts, capacity).runs), np.int64).reshape(-1, 6)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("__before"))
    ranked = ranked.select(*[c for c in pieces.columns if c != "part"])
    names = [c for c in ranked.columns if c != "rank"]
    keys = runs[:, 0] << 48 | runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run = runs[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            per = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(run[:, 4] + per // run[:, 3]),
                    pa.array(run[:, 5] + per % run[:, 3] * length),
                ],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{c} {ranked.schema[c].dataType.simpleString()}" for c in names)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, *, tokenizer: str, capacity: int = 2048, with_ids: bool = False, **columns) -> DataFrame:
    """``token_pieces`` written once, then ``pack``."""
    pieces = token_pieces(docs, tokenizer=tokenizer, capacity=capacity, with_ids=with_ids, **columns)
    return pack(write_once(pieces, "pieces"), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack_documents(with_ids=True)``: sequence_id, ids, doc_ids (by offset)."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return (
        packed.groupBy("sequence_id")
        .agg(inside.alias("__pieces"))
        .select("sequence_id", F.flatten("__pieces.ids").alias("ids"), F.col("__pieces.doc_id").alias("doc_ids"))
    )
