"""Cut texts into pre-tokens by the rule of the public byte-level tokenizers, on whole chunks at once.

The rule is ``public_tokenizers.PATTERN``: contractions, then runs of letters, of numbers or of other signs, each with
one space before it, and white space, of which the last character before a word is left to stand alone.
"""

from __future__ import annotations

import numpy as np
import regex

LETTER, NUMBER, SIGN, SPACE = range(4)
_KINDS = ((regex.compile(r"\p{L}"), LETTER), (regex.compile(r"\p{N}"), NUMBER), (regex.compile(r"\s"), SPACE))


def kind_of(code: int) -> int:
    character = chr(code)
    return next((kind for pattern, kind in _KINDS if pattern.match(character)), SIGN)


_ASCII = np.array([kind_of(c) if c < 128 else SIGN for c in range(256)], np.uint8)


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte belongs to. ``data`` is valid UTF-8 with padding behind it."""
    found = _ASCII[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = [data[lead + i].astype(np.int32) for i in range(4)]
        tail = [x & 0x3F for x in b]
        code = np.where(
            b[0] < 0xE0,
            (b[0] & 0x1F) << 6 | tail[1],
            np.where(
                b[0] < 0xF0,
                (b[0] & 0x0F) << 12 | tail[1] << 6 | tail[2],
                (b[0] & 0x07) << 18 | tail[1] << 12 | tail[2] << 6 | tail[3],
            ),
        )
        codes, at = np.unique(code, return_inverse=True)
        kind = np.array([kind_of(c) for c in codes.tolist()], np.uint8)[at]
        for i, least in enumerate((0, 0, 0xE0, 0xF0)):
            long_enough = b[0] >= least
            found[lead[long_enough] + i] = kind[long_enough]
    return found


def pretoken_starts(data: np.ndarray, offsets: np.ndarray, pad: int) -> np.ndarray:
    """Where each pre-token starts; each one ends where the next starts, the last at the end of the data."""
    n = len(data) - pad
    if n == 0:
        return np.zeros(0, np.int64)
    kind = kinds(data)[:n]
    new_text = np.zeros(n + 3, bool)
    new_text[offsets] = True
    new_text[n:] = True
    mark = new_text[:n].copy()
    mark[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(mark)
    ends = np.append(runs[1:], n)

    # White space before another run of the same text: its last character stands apart, a blank joins that run.
    inner = ends[(kind[runs] == SPACE) & ~new_text[ends]]
    last = inner - 1
    for _ in range(3):
        last = last - ((data[last] & 0xC0) == 0x80)
    mark[inner[data[last] == 0x20]] = False
    mark[last] = True

    # A lone apostrophe that starts a pre-token takes the letters of a contraction.
    lone = runs[(data[runs] == 0x27) & (ends - runs == 1) & mark[runs]]
    lone = lone[~new_text[lone + 1]]
    one, two = data[lone + 1], data[lone + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    size = np.where(short, 2, np.where(pairs & ~new_text[lone + 2], 3, 0))
    lone, size = lone[size > 0], size[size > 0]
    mark[lone + 1] = False
    after = lone + size
    mark[after[after < n]] = True
    return np.flatnonzero(mark)
