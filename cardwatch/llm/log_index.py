"""A family of sorted arrays that grow geometrically: each batch is sorted, merge-scanned against all levels, and joins them."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Entries(NamedTuple):
    """Suffixes by fingerprint: ``key`` is what brings two together, ``body`` tells whether they are alike throughout.

    ``uid``, ``at`` and ``count`` say whose suffixes these are: ``count`` of them, starting at ``at``. ``told`` remembers what
    has been reported of an entry: LIKE, UNLIKE or both.
    """

    key: np.ndarray
    body: np.ndarray
    uid: np.ndarray
    at: np.ndarray
    count: np.ndarray
    told: np.ndarray

    def take(self, rows: np.ndarray) -> Entries:
        return Entries(*[column[rows] for column in self])

    @property
    def size(self) -> int:
        return len(self.key)

    @classmethod
    def join(cls, parts: list[Entries]) -> Entries:
        return cls(*[np.concatenate(columns) for columns in zip(*parts)])


LIKE, UNLIKE = 1, 2


class LogIndex:
    """Reports, for entries that share their key with another one, whether the two are alike.

    Of each key one entry stays in the index. Sizes of levels at least double from one to the next, so an entry moves a
    logarithmic number of times, and there are logarithmically many levels to scan.
    """

    def __init__(self) -> None:
        self.levels: list[Entries] = []

    def add(self, batch: Entries) -> tuple[Entries, Entries]:
        """Returns the entries now known to have a like one, and those now known to have an unlike one."""
        like: list[Entries] = []
        unlike: list[Entries] = []

        def tell(entries: Entries, rows: np.ndarray, what: int, to: list[Entries]) -> None:
            rows = np.unique(rows[(entries.told[rows] & what) == 0])
            to.append(entries.take(rows))
            entries.told[rows] |= what

        def meet(held: Entries, of: np.ndarray, new: Entries, rows: np.ndarray) -> None:
            """Entries ``rows`` of ``new`` share their keys with the entries ``of`` of ``held``."""
            alike = held.body[of] == new.body[rows]
            tell(held, of[alike], LIKE, like)
            tell(new, rows[alike], LIKE, like)
            tell(held, of[~alike], UNLIKE, unlike)
            tell(new, rows[~alike], UNLIKE, unlike)

        order = np.argsort(batch.key, kind="stable")
        batch = batch.take(order)
        first = np.ones(batch.size, bool)
        first[1:] = batch.key[1:] != batch.key[:-1]
        lead = np.maximum.accumulate(np.where(first, np.arange(batch.size), 0))
        rest = np.flatnonzero(~first)
        meet(batch, lead[rest], batch, rest)
        batch = batch.take(np.flatnonzero(first))
        for level in self.levels:
            place = np.minimum(np.searchsorted(level.key, batch.key), level.size - 1)
            hit = level.key[place] == batch.key
            meet(level, place[hit], batch, np.flatnonzero(hit))
            batch = batch.take(np.flatnonzero(~hit))
        if batch.size:
            self.levels.append(batch)
        while len(self.levels) > 1 and self.levels[-2].size < 2 * self.levels[-1].size:
            last, before = self.levels.pop(), self.levels.pop()
            at = np.searchsorted(before.key, last.key)
            self.levels.append(Entries(*[np.insert(b, at, n) for b, n in zip(before, last)]))
        return Entries.join([batch.take(np.zeros(0, np.int64)), *like]), Entries.join(
            [batch.take(np.zeros(0, np.int64)), *unlike]
        )
