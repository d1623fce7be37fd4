"""Byte-level BPE over whole texts in two tiers.

A minimal perfect hash resolves every pre-token that is a vocabulary entry. All others are merged byte by byte: the
bytes are a linked list, and a heap holds the ranks of neighbouring pairs. Each distinct pre-token of a chunk is resolved
once; merged ones are also remembered by the Python worker, up to a fixed number.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.pretokens import pretoken_starts
from cardwatch.llm.spans import PAD, Chunk, chunks, distinct_spans, hash_spans, mix, ranges, words_at

#: How many merged pre-tokens a worker remembers before it starts anew.
REMEMBERED = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line. Ranks must be 0, 1, ..."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash(NamedTuple):
    """n keys in n slots. ``shift`` says per bucket which rehash its keys take, or, below 0, the slot of its only key."""

    shift: np.ndarray
    hashes: np.ndarray
    ids: np.ndarray

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """Place the largest buckets first, each under the first rehash that finds free slots; single keys take what is left."""
        n = len(hashes)
        buckets: dict[int, list[int]] = {}
        for key, b in enumerate((hashes % np.uint64(max(1, n))).tolist()):
            buckets.setdefault(b, []).append(key)
        shift, ids = np.zeros(max(1, n), np.int64), np.full(n, -1, np.int64)
        order = sorted(buckets, key=lambda b: -len(buckets[b]))
        many = [b for b in order if len(buckets[b]) > 1]
        for b in many:
            keys = hashes[buckets[b]]
            for s in range(1, 1 << 22):
                slots = cls.slots(keys, np.int64(s), n)
                if len(set(slots.tolist())) == len(slots) and (ids[slots] < 0).all():
                    shift[b], ids[slots] = s, buckets[b]
                    break
            else:
                raise ValueError("two keys share a hash")
        free = np.flatnonzero(ids < 0).tolist()
        for b, slot in zip(order[len(many) :], free):
            shift[b], ids[slot] = -slot - 1, buckets[b][0]
        return cls(shift, hashes[ids], ids)

    @staticmethod
    def slots(hashes: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
        return (mix(hashes + np.asarray(shift).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The key with each hash, or -1."""
        shift = self.shift[(hashes % np.uint64(len(self.shift))).astype(np.int64)]
        slot = np.where(shift < 0, -shift - 1, self.slots(hashes, shift, len(self.ids)))
        return np.where(self.hashes[slot] == hashes, self.ids[slot], -1)


class Vocabulary:
    """Tokens by rank, as bytes in one array, and the perfect hash over them."""

    def __init__(self, ranks: dict[bytes, int], perfect: PerfectHash | None = None):
        self.ranks = ranks
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        if [ranks[t] for t in self.tokens] != list(range(len(ranks))):
            raise ValueError("ranks must be 0, 1, ... without gaps")
        self.data = np.frombuffer(b"".join(self.tokens) + bytes(PAD), np.uint8)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.perfect = perfect or PerfectHash.build(hash_spans(self.data, self.starts, self.lengths))
        self.merged: dict[bytes, bytes] = {}

    def whole(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """First tier: the id of each span that is a token, else -1. Bytes are compared, not only hashes."""
        ids = self.perfect.find(hashes)
        hit = np.flatnonzero((ids >= 0) & (self.lengths[ids] == lengths))
        own, eight = words_at(self.data), words_at(data)
        at, to, left = starts[hit], self.starts[ids[hit]], lengths[hit]
        same = np.ones(len(hit), bool)
        for k in range(0, int(left.max(initial=0)), 8):
            mask = (np.uint64(1) << (np.clip(left - k, 0, 8).astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            mask[left - k >= 8] = np.uint64(2**64 - 1)
            over = left > k
            same[over] &= ((eight[at[over] + k] ^ own[to[over] + k]) & mask[over]) == 0
        found = np.full(len(ids), -1, np.int64)
        found[hit[same]] = ids[hit[same]]
        return found

    def merge(self, piece: bytes) -> list[int]:
        """Second tier: merge the neighbouring pair of lowest rank, leftmost first, until no pair is a token."""
        rank, n = self.ranks.get, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, e = heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != e:
                continue  # one of the two has been merged meanwhile
            end[i], end[middle] = e, 0
            if e < n:
                before[e] = i
                if (r := rank(piece[i : end[e]])) is not None:
                    heappush(heap, (r, i, end[e]))
            if (p := before[i]) >= 0 and (r := rank(piece[p:e])) is not None:
                heappush(heap, (r, p, e))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def packed(self, piece: bytes) -> bytes:
        """``merge`` as packed 32-bit ids, remembered."""
        found = self.merged.get(piece)
        if found is None:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            found = self.merged[piece] = array("I", self.merge(piece)).tobytes()
        return found

    def resolve(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> list[bytes]:
        """Packed ids of distinct pre-tokens."""
        whole = self.whole(data, starts, lengths, hashes)
        raw = data.tobytes()
        return [
            i.to_bytes(4, "little") if i >= 0 else self.packed(raw[s : s + n])
            for i, s, n in zip(whole.tolist(), starts.tolist(), lengths.tolist())
        ]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after the other, and how many each id gives."""
        lengths = self.lengths[ids]
        return self.data[ranges(self.starts[ids], lengths)], lengths


def encode_chunk(chunk: Chunk, resolve) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a chunk one after the other, and where each text's ids start (one more at the end)."""
    starts = pretoken_starts(chunk.data, chunk.offsets, PAD)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(chunk.rows + 1, np.int64)
    lengths = np.diff(np.append(starts, chunk.size))
    example, kind, hashes = distinct_spans(chunk.data, starts, lengths)
    packed = resolve(chunk.data, starts[example], lengths[example], hashes)
    counts = np.array([len(p) // 4 for p in packed], np.int64)
    flat = np.frombuffer(b"".join(packed), "<u4")
    before = np.cumsum(counts) - counts
    ids = flat[ranges(before[kind], counts[kind])]
    ends = np.append(0, np.cumsum(counts[kind]))
    return ids, ends[np.searchsorted(starts, chunk.offsets)]


@lru_cache(maxsize=2)
def _vocabulary(path: str, shift: bytes, hashes: bytes, ids: bytes) -> Vocabulary:
    perfect = PerfectHash(*[np.frombuffer(b, t) for b, t in ((shift, np.int64), (hashes, np.uint64), (ids, np.int64))])
    return Vocabulary(read_ranks(path), perfect)


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary: the bytes that decoding these ids gives) of every whole text.

    ``ranks`` is the path of a rank file that every executor has. Special tokens in a text are ordinary text. A null or
    empty text gives no ids and no bytes; a repeated row is encoded again; null ids pass through; other columns are
    ignored, whatever their names; an empty table gives an empty result. Any text length is allowed: a text is never cut,
    and memory is bounded by the longest text or a chunk of a few megabytes, whichever is more.
    """
    perfect = Vocabulary(read_ranks(ranks)).perfect
    parts = [a.tobytes() for a in perfect]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks, *parts)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ids, ends = encode_chunk(chunk, vocabulary.resolve)
                data, lengths = vocabulary.decode(ids)
                bytes_at = np.append(0, np.cumsum(lengths))[ends]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.rows),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view(np.int32))),
                        pa.Array.from_buffers(
                            pa.binary(), chunk.rows, [None, pa.py_buffer(bytes_at.astype(np.int32)), pa.py_buffer(data)]
                        ),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
