"""Array work on many byte spans at once: chunks of texts, hashes of spans, distinct spans."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Zero bytes behind every chunk, so that eight bytes can be read at each position.
PAD = 8
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Chunk(NamedTuple):
    """Some rows of a batch: their texts as one padded byte array, and where each text starts (one more at the end)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.data) - PAD

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(texts: pa.Array, most: int = 4 << 20) -> Iterator[Chunk]:
    """Cut a string column into runs of whole texts of about ``most`` bytes; a longer text is a chunk of its own."""
    texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        padded = np.zeros(at[last] - at[first] + PAD, np.uint8)
        padded[:-PAD] = data[at[first] : at[last]]
        yield Chunk(first, padded, at[first : last + 1] - at[first])
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K3
    return h ^ (h >> np.uint64(31))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one integer per position (a view)."""
    return np.ndarray((len(data) - PAD + 1,), "<u8", data, strides=(1,))


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span; spans may overlap and have any length."""
    eight = words_at(data)
    h = lengths.astype(np.uint64) * _K1 + np.uint64(seed)
    h = mix(h ^ (eight[starts] & _MASK[np.minimum(lengths, 8)]))
    live = np.flatnonzero(lengths > 8)
    at, left = starts[live] + 8, lengths[live] - 8
    while len(live):
        h[live] = mix(h[live] * _K1 + (eight[at] & _MASK[np.minimum(left, 8)]))
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    return h


def distinct_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct spans of a chunk: (a span of each kind, kind of each span, hash of each kind).

    Grouped by hash; the first and last eight bytes and the length are compared as well, and on any mismatch all spans
    are grouped by their bytes.
    """
    h = hash_spans(data, starts, lengths)
    hashes, example, kind = np.unique(h, return_index=True, return_inverse=True)
    eight, like = words_at(data), example[kind]
    last = starts + np.maximum(lengths - 8, 0)
    mask = _MASK[np.minimum(lengths, 8)]
    alike = (
        np.array_equal(lengths, lengths[like])
        and np.array_equal(eight[starts] & mask, (eight[starts] & mask)[like])
        and np.array_equal(eight[last] & mask, (eight[last] & mask)[like])
    )
    if not alike:
        raw, seen = data.tobytes(), {}
        kind = np.array([seen.setdefault(raw[s : s + n], len(seen)) for s, n in zip(starts.tolist(), lengths.tolist())])
        _, example = np.unique(kind, return_index=True)
        hashes = h[example]
    return example, kind, hashes


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


#: Every ASCII character but digits and letters.
NOT_ALPHANUMERIC = np.ones(256, bool)
NOT_ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def folded_words(chunk: Chunk, between: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between blanks (bytes marked in ``between``), with A-Z lower-cased: (folded bytes, starts, lengths, index of each
    text's first word)."""
    data = _FOLD[chunk.data]
    inside = ~between[data[: chunk.size]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = chunk.offsets[:-1]
    edge = edge[edge < chunk.size]
    first[edge] = inside[edge]
    last = np.zeros(len(inside), bool)
    last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
    last[-1:] = inside[-1:]
    starts = np.flatnonzero(first)
    return data, starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, chunk.offsets)


def gram_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of each text, and where each text's hashes start.

    A text with fewer words, but at least one, has one run: all its words.
    """
    count = np.diff(bounds)
    at = ranges(bounds[:-1], np.where(count >= n, count - n + 1, np.minimum(count, 1)))
    size = np.minimum(count, n)
    of = np.repeat(size, np.where(count >= n, count - n + 1, np.minimum(count, 1)))
    h = of.astype(np.uint64) * _K2
    for k in range(n):
        here = of > k
        h[here] = mix(h[here] * _K1 + words[at[here] + k])
    return h, np.append(0, np.cumsum(np.where(count >= n, count - n + 1, np.minimum(count, 1))))
