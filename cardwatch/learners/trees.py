"""Trees over binned features, grown from sums over rows: three ways to grow regression trees, and stumps for classes.

A tree asks for the sums of some of its nodes (``wanted``), takes them (``take``) and says when it is ``done``. Sums of a node are
an array (bins of all features, 3): gradient, hessian, rows. The driver holds such sums for the open nodes of a tree, so what
it holds is bounded by nodes times bins.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass, field

import numpy as np

from cardwatch.learners.binning import MISSING, Layout


@dataclass(frozen=True)
class Growth:
    """How a tree grows.

    ``kind``: ``stump`` (one split by classes), or ``level`` (all nodes of a level), ``leaf`` (the leaf of largest gain first, up to ``leaves``), ``symmetric`` (one split for
    all nodes of a level). ``gain``: ``newton`` (gradient and hessian with an L2 ``penalty``) or ``squares`` (squared error of
    the gradients), ``gini`` (impurity, for stumps). A missing value goes to the side where it helps more, or with ``missing_low`` always to the left.
    """

    kind: str = "level"
    gain: str = "newton"
    depth: int = 6
    leaves: int = 31
    penalty: float = 0.0
    least_rows: float = 1.0
    least_hessian: float = 0.0
    missing_low: bool = False

    @property
    def counts_jointly(self) -> bool:
        """Whether features may be summed together, which rounds otherwise. Best leaves first, the last digits choose among leaves of equal gain."""
        return self.kind != "leaf"


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool


def _score(sums: np.ndarray, growth: Growth) -> np.ndarray:
    g, h, n = sums[..., 0], sums[..., 1], sums[..., 2]
    below = n if growth.gain == "squares" else h + growth.penalty
    return np.where(below > 0, g * g / np.where(below > 0, below, 1.0), 0.0)


def split_gains(sums: np.ndarray, layout: Layout, growth: Growth) -> tuple[np.ndarray, np.ndarray]:
    """Gain of splitting each node at each bin, -inf where it may not, and whether missing values go left: (nodes, bins) each."""
    running = np.cumsum(sums, axis=1)
    first = layout.starts[:-1]
    ahead = running[:, first] - sums[:, first]
    missing = sums[:, first][:, layout.feature]
    whole = (running[:, layout.starts[1:] - 1] - ahead)[:, layout.feature]
    left = running - ahead[:, layout.feature]  # with missing values
    best = np.full(left.shape[:2], -np.inf)
    side = np.ones(best.shape, bool)
    for go_left in (True,) if growth.missing_low else (True, False):
        low = left if go_left else left - missing
        high = whole - low
        fits = layout.splits[None, :]
        for part in (low, high):
            fits = fits & (part[..., 2] >= max(growth.least_rows, 1e-12)) & (part[..., 1] >= growth.least_hessian)
        gain = np.where(fits, _score(low, growth) + _score(high, growth) - _score(whole, growth), -np.inf)
        better = gain > best + 1e-12 * np.abs(np.where(np.isfinite(best), best, 0.0))
        best, side = np.where(better, gain, best), np.where(better, go_left, side)
    return best, side


def best_split(gains: np.ndarray, side: np.ndarray, layout: Layout) -> Split | None:
    """The split of largest gain; of equals the one of the first feature and lowest bin. None if no split helps."""
    top = gains.max(initial=-np.inf)
    if not top > 1e-9:
        return None
    at = int(np.flatnonzero(gains >= top * (1 - 1e-12))[0])
    return Split(float(top), int(layout.feature[at]), int(layout.bin[at]), bool(side[at]))


def _parts(sums: np.ndarray, split: Split, layout: Layout) -> np.ndarray:
    """What goes left."""
    own = sums[layout.starts[split.feature] : layout.starts[split.feature + 1]]
    low = own[1 : split.cut + 1].sum(axis=0)
    return low + own[MISSING] if split.missing_left else low


@dataclass
class Tree:
    """Nodes in order of creation; a leaf has feature -1. ``sums`` are kept for the leaves' values while the tree grows."""

    growth: Growth
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def __post_init__(self) -> None:
        self.totals: dict[int, np.ndarray] = {}
        self.sums: dict[int, np.ndarray] = {}
        #: (node whose sums are needed, its sibling, their parent): the sibling's sums follow from the parent's.
        self.asked: list[tuple[int, int | None, int | None]] = [(0, None, None)]
        #: Of nodes whose sums are known, the split that helps most; and the nodes that are divided already.
        self.splits: dict[int, Split] = {}
        self.divided: set[int] = set()
        self.used: dict[int, Split] = {}

    @property
    def done(self) -> bool:
        return not self.asked

    def wanted(self) -> list[int]:
        return [node for node, _, _ in self.asked]

    def most_sums(self) -> int:
        """Nodes whose sums a tree may ask for, from here to its end, about."""
        return self.growth.leaves if self.growth.kind == "leaf" else 1 << min(self.growth.depth, 20) - 1 if self.growth.depth else 1

    def signature(self) -> str:
        """Equal for trees with the same splits, whose nodes then have the same numbers."""
        return hashlib.md5(repr((self.feature, self.cut, self.missing_left)).encode()).hexdigest()

    def take(self, found: dict[int, np.ndarray], layout: Layout) -> None:
        """Sums of the wanted nodes arrive: split what can be split, ask for what comes next."""
        fresh = []
        for node, sibling, parent in self.asked:
            self.sums[node] = found[node]
            fresh.append(node)
            if sibling is not None:
                self.sums[sibling] = self.sums.pop(parent) - found[node]
                fresh.append(sibling)
        self.asked = []
        end = layout.starts[1]
        for node in fresh:
            self.totals[node] = self.sums[node][:end].sum(axis=0)
        open_ = [n for n in fresh if self.depth[n] < self.growth.depth]
        if self.growth.kind == "symmetric":
            self._split_alike(open_, layout)
            return
        found = self._splits(open_, layout)
        if self.growth.kind == "leaf":
            self.splits |= found
            self._best_first(layout)
        else:
            for node, split in found.items():
                self._divide(node, split, layout)

    def _splits(self, nodes: list[int], layout: Layout) -> dict[int, Split]:
        if not nodes:
            return {}
        gains, side = split_gains(np.stack([self.sums[n] for n in nodes]), layout, self.growth)
        found = {n: best_split(g, s, layout) for n, g, s in zip(nodes, gains, side)}
        return {n: s for n, s in found.items() if s is not None}

    def _best_first(self, layout: Layout) -> None:
        """Divide the leaf of largest gain, again and again, as far as sums are known.

        Where they are not, the sums below all leaves that may come next are asked for at once. What was divided and is not
        among the chosen nodes in the end becomes a leaf again, so the tree is the one that grows leaf by leaf.
        """
        queue = [(-self.splits[0].gain, 0)] if 0 in self.splits else []
        chosen, unknown, leaves = [], [], 1
        while queue and leaves < self.growth.leaves:
            _, node = heapq.heappop(queue)
            leaves += 1
            if not unknown:
                chosen.append(node)
            if node in self.divided:
                for child in (self.left[node], self.right[node]):
                    if child in self.splits:
                        heapq.heappush(queue, (-self.splits[child].gain, child))
            elif leaves < self.growth.leaves and self.depth[node] + 1 < self.growth.depth:
                unknown.append(node)
        if unknown:
            for node in unknown:
                self._divide(node, self.splits[node], layout)
            return
        for node in chosen:
            if node not in self.divided:
                self._divide(node, self.splits[node], layout, ask=False)
        for node in self.divided - set(chosen):
            self.feature[node] = -1

    def _split_alike(self, nodes: list[int], layout: Layout) -> None:
        """One split for all nodes of the level, also where it leaves a side empty."""
        if not nodes:
            return
        loose = Growth(self.growth.kind, self.growth.gain, penalty=self.growth.penalty, least_rows=0.0, missing_low=True)
        sums = np.stack([self.sums[n] for n in nodes])
        gains, side = split_gains(np.where(sums[..., 2:] > 0, sums, 0.0), layout, loose)
        # A node of which nothing goes to one side gains nothing there.
        gains = np.where(np.isfinite(gains), gains, np.where(layout.splits, 0.0, -np.inf)[None, :])
        split = best_split(gains.sum(axis=0), side[0], layout)
        if split is not None:
            for node in nodes:
                self._divide(node, split, layout)

    def _divide(self, node: int, split: Split, layout: Layout, ask: bool = True) -> None:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node] = split.feature, split.cut, split.missing_left
        self.left[node], self.right[node], self.gain[node] = left, left + 1, split.gain
        for _ in range(2):
            for column, blank in (
                (self.feature, -1), (self.cut, 0), (self.missing_left, True), (self.left, 0), (self.right, 0), (self.value, 0.0),
                (self.gain, 0.0), (self.depth, self.depth[node] + 1),
            ):
                column.append(blank)
        self.divided.add(node)
        self.used[node] = split
        low = _parts(self.sums[node], split, layout)
        high = self.totals[node] - low
        self.totals[left], self.totals[left + 1] = low, high
        if ask and self.depth[left] < self.growth.depth:
            # The side of fewer rows is summed, the other one follows.
            small = left if low[2] <= high[2] else left + 1
            self.asked.append((small, left + 1 if small == left else left, node))
        else:
            self.sums.pop(node)

    def split_on(self, node: int) -> int:
        """The feature that divided a node, also where that was taken back."""
        return self.used[node].feature

    def goes_right(self, node: int, bins: np.ndarray) -> np.ndarray:
        """Which rows of a divided node go right, by their bins of its feature."""
        split = self.used[node]
        right = bins > split.cut
        return right if split.missing_left else right | (bins == MISSING)

    def finish(self, rate: float) -> None:
        """Newton steps as the leaves' values."""
        for node in range(len(self.feature)):
            if self.feature[node] < 0:
                g, h, _ = self.totals[node]
                below = h + self.growth.penalty
                self.value[node] = float(-rate * g / below) if below > 1e-150 else 0.0
        self.totals, self.sums, self.splits = {}, {}, {}

    #: Whether the tree is no use, and whether no other may follow it.
    useless = last = False

    def compact(self) -> SymmetricTree | BranchingTree:
        if self.growth.kind == "symmetric":
            # The leftmost path names every level's split; at each level the right side sets a bit.
            level, leaves, features, cuts = 0, np.zeros(1, np.int64), [], []
            left, right = np.array(self.left), np.array(self.right)
            while self.feature[level] >= 0:
                features.append(self.feature[level])
                cuts.append(self.cut[level])
                leaves = np.concatenate([left[leaves], right[leaves]])
                level = self.left[level]
            return SymmetricTree(features, cuts, leaves, np.array(self.value)[leaves])
        return BranchingTree(
            np.array(self.feature, np.int32),
            np.array(self.cut, np.uint8),
            np.array(self.missing_left, bool),
            np.array(self.left, np.int32),
            np.array(self.right, np.int32),
            np.array(self.value),
        )


def begun(growth: Growth) -> Tree:
    """A tree of one node."""
    return Stump(growth) if growth.kind == "stump" else Tree(growth)


class Stump(Tree):
    """One split that leaves the least impurity of two weighted classes, or none if no split helps.

    Sums are (weight of class 1, weight of class 0, rows). A side votes for its heavier class with 1 or -1 times its say, which is
    the larger the less weight is on the wrong side. A stump no better than chance is no use; after a perfect one nothing follows.
    """

    def take(self, found: dict[int, np.ndarray], layout: Layout) -> None:
        self.asked = []
        sums = found[0]
        running = np.cumsum(sums, axis=0)
        low = (running - (running - sums)[layout.starts[:-1]][layout.feature])[:, :2]
        whole = sums[: layout.starts[1], :2].sum(axis=0)
        left = np.where(layout.splits, _impurity(low) + _impurity(whole - low), np.inf)
        self.sides = [whole]
        if left.size and left.min() < _impurity(whole) * (1 - 1e-12):
            at = int(np.flatnonzero(left <= left.min() * (1 + 1e-12))[0])
            self.totals = {0: sums[: layout.starts[1]].sum(axis=0)}
            self.sums = {0: sums}
            self._divide(0, Split(float(_impurity(whole) - left[at]), int(layout.feature[at]), int(layout.bin[at]), True), layout, ask=False)
            self.sides = [low[at], whole - low[at]]

    def finish(self, rate: float) -> None:
        votes = [1.0 if side[0] > side[1] else -1.0 for side in self.sides]
        error = sum(side.min() for side in self.sides) / sum(side.sum() for side in self.sides)
        self.useless, self.last = error >= 0.5, error >= 0.5 or error <= 0
        say = 1.0 if error <= 0 else rate * math.log((1 - error) / error)
        if len(votes) == 1:
            self.value[0] = say * votes[0]
        else:
            self.value[self.left[0]], self.value[self.right[0]] = (say * v for v in votes)
        self.say, self.totals, self.sums = say, {}, {}


def _impurity(sides: np.ndarray) -> np.ndarray:
    n = sides.sum(axis=-1)
    return n - (sides**2).sum(axis=-1) / np.where(n > 0, n, 1.0)


@dataclass
class SymmetricTree:
    """One split per level: the path to a leaf is a string of bits, and the leaf one look-up. Missing values go left."""

    features: list[int]
    cuts: list[int]
    leaf_nodes: np.ndarray
    leaf_values: np.ndarray

    def _bits(self, bins: np.ndarray) -> np.ndarray:
        bits = np.zeros(bins.shape[1], np.int64)
        for level, (feature, cut) in enumerate(zip(self.features, self.cuts)):
            bits |= (bins[feature] > cut).astype(np.int64) << level
        return bits

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node each row has come to; ``bins`` is (features, rows)."""
        return self.leaf_nodes[self._bits(bins)]

    def located(self, bins: np.ndarray, rows: np.ndarray, wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` that have come to a wanted node, and its place among the wanted."""
        slots = np.full(self.leaf_nodes.max() + 1, -1)
        slots[wanted] = np.arange(len(wanted))
        slot = slots[self.nodes(bins)[rows]]
        there = np.flatnonzero(slot >= 0)
        return rows[there], slot[there]

    def values(self, bins: np.ndarray) -> np.ndarray:
        return self.leaf_values[self._bits(bins)]

    def to_lists(self) -> list:
        return [self.features, self.cuts, self.leaf_nodes.tolist(), self.leaf_values.tolist()]


@dataclass
class BranchingTree:
    """Nodes as arrays; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node each row has come to; ``bins`` is (features, rows)."""
        at = np.zeros(bins.shape[1], np.int64)
        # Rows are handed down node by node: a node looks at one feature of its own rows alone.
        open_ = [(0, np.arange(bins.shape[1]))]
        while open_:
            node, rows = open_.pop()
            feature = self.feature[node]
            if feature < 0:
                at[rows] = node
            elif len(rows):
                own = bins[feature][rows]
                right = own > self.cut[node]
                if not self.missing_left[node]:
                    right |= own == MISSING
                open_ += [(self.left[node], rows[~right]), (self.right[node], rows[right])]
        return at

    def located(self, bins: np.ndarray, rows: np.ndarray, wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` that have come to a wanted node, and its place among the wanted."""
        # Children come after their parents; only what leads to a wanted node is followed.
        leads = np.zeros(len(self.feature), bool)
        leads[wanted] = True
        for node in range(len(leads) - 1, -1, -1):
            if self.feature[node] >= 0:
                leads[node] |= leads[self.left[node]] | leads[self.right[node]]
        found, open_ = {}, [(0, rows)]
        while open_:
            node, rows = open_.pop()
            feature = self.feature[node]
            if feature < 0:
                found[node] = rows
                continue
            own = bins[feature][rows]
            right = own > self.cut[node]
            if not self.missing_left[node]:
                right |= own == MISSING
            if leads[self.left[node]]:
                open_.append((self.left[node], rows[~right]))
            if leads[self.right[node]]:
                open_.append((self.right[node], rows[right]))
        parts = [found[node] for node in wanted]
        return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])

    def values(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]

    def to_lists(self) -> list:
        columns = (self.feature, self.cut, self.missing_left.astype(int), self.left, self.right, self.value)
        return [c.tolist() for c in columns]


def tree_from_lists(raw: list) -> SymmetricTree | BranchingTree:
    if len(raw) == 4:
        features, cuts, nodes, values = raw
        return SymmetricTree(features, cuts, np.array(nodes, np.int64), np.array(values, float))
    kinds = (np.int32, np.uint8, bool, np.int32, np.int32, float)
    return BranchingTree(*[np.array(c, k) for c, k in zip(raw, kinds)])
