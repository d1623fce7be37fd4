"""Extremely random trees: every node draws one split point per feature between its own smallest and largest value.

All trees of all folds grow side by side, a level at a time, with two Spark jobs per level: one finds the range of each feature in
each open node, one counts the classes at or below the drawn points. Tasks reduce their blocks to ranges and counts per node, and other
tasks merge these per tree and group of nodes, so what travels depends on trees, nodes and features, never on rows. Draws are
hashes of (seed, tree, node, feature), ranges and counts are exact: the forest does not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.binning import matrix
from cardwatch.learners.raw_blocks import Block, Blocks, packed

#: Open nodes of all trees that grow at a time, at most; more trees grow one batch after the other.
NODES_AT_ONCE = 1 << 18
#: Nodes of one tree whose ranges or counts are merged by one task.
NODES_PER_PART = 256


@dataclass(frozen=True)
class Plan:
    """A forest to be grown on all rows but those of fold ``held_out``; classes are weighted."""

    trees: int
    depth: int
    seed: int = 42
    class_weights: tuple[float, float] = (1.0, 1.0)
    held_out: int | None = None
    #: Features a node looks at; 0: the square root of their number.
    looks_at: int = 0


def descended(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node each row comes to."""
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        rows = rows[feature[at[rows]] >= 0]
        here = at[rows]
        at[rows] = left[here] + (x[rows, feature[here]] > cut[here])
    return at


class RandomTree:
    """Nodes as arrays: a leaf has feature -1, the right child follows the left one; ``counts`` holds (negatives, positives)."""

    def __init__(self, counts: tuple[int, int]):
        self.feature = np.full(1, -1, np.int32)
        self.cut = np.zeros(1)
        self.left = np.zeros(1, np.int32)
        self.counts = np.array([counts], np.int64)
        self.open = np.zeros(1, np.int64)
        self._close()

    def _close(self) -> None:
        """Nodes of one class stay leaves."""
        self.open = self.open[(self.counts[self.open] > 0).all(axis=1)]

    def nodes(self, x: np.ndarray) -> np.ndarray:
        return descended(x, self.feature, self.cut, self.left)

    def split(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, below: np.ndarray) -> None:
        """Divide nodes, whose children become the open ones."""
        first, n = len(self.feature), len(nodes)
        self.feature[nodes], self.cut[nodes], self.left[nodes] = feature, cut, first + 2 * np.arange(n)
        pairs = np.stack([below, self.counts[nodes] - below], axis=1).reshape(2 * n, 2)
        self.feature = np.append(self.feature, np.full(2 * n, -1, np.int32))
        self.cut = np.append(self.cut, np.zeros(2 * n))
        self.left = np.append(self.left, np.zeros(2 * n, np.int32))
        self.counts = np.concatenate([self.counts, pairs])
        self.open = first + np.arange(2 * n)
        self._close()


@dataclass
class Forest:
    """Grown trees with the weights of the classes in their leaves."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    gains: list[float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, share in self.trees:
            total += share[descended(x, feature, cut, left)]
        return total / len(self.trees)

    def to_json(self) -> str:
        return json.dumps([[[c.tolist() for c in tree] for tree in self.trees], self.gains])

    @classmethod
    def from_json(cls, text: str) -> Forest:
        trees, gains = json.loads(text)
        kinds = (np.int32, float, np.int32, float)
        return cls([tuple(np.array(c, k) for c, k in zip(tree, kinds)) for tree in trees], gains)


def _mixed(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        z = z + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def uniform(seed: int, tree: int, nodes: np.ndarray, width: int, purpose: int) -> np.ndarray:
    """Numbers from 0 to below 1 for each node and feature: (nodes, width)."""
    state = np.zeros((len(nodes), width), np.uint64)
    for key in (np.array(seed), np.array(tree), nodes[:, None], np.arange(width)[None, :], np.array(purpose)):
        state = _mixed(state ^ key.astype(np.uint64))
    return (state >> np.uint64(11)) * 2.0**-53


def drawn(plan: Plan, tree: int, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features each node looks at, -1 where there is none, and their split points: (nodes, looks) each.

    A node looks at features in random order until it has seen enough of them and one that is not constant; constant ones are no split.
    """
    width = low.shape[1]
    looks = min(width, plan.looks_at or max(1, math.isqrt(width)))
    order = np.argsort(uniform(plan.seed, tree, nodes, width, 0), axis=1, kind="stable")
    varies = np.take_along_axis(low < high, order, axis=1)
    first = np.argmax(varies, axis=1)
    seen = order[:, :looks].astype(np.int32)
    seen[~varies[:, :looks]] = -1
    late = varies.any(axis=1) & (first >= looks)
    seen[late, 0] = order[late, first[late]]
    point = low + uniform(plan.seed, tree, nodes, width, 1) * (high - low)
    # Rounding may reach the largest value, which would leave the right side empty.
    point = np.where(point >= high, low, point)
    return seen, np.take_along_axis(point, np.maximum(seen, 0), axis=1)


def chosen(plan: Plan, seen: np.ndarray, below: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the look of least Gini impurity, of equals the first one, and how much impurity it takes away."""
    weights = np.array(plan.class_weights)
    whole = counts * weights
    left = below * weights
    right = whole[:, None, :] - left
    kept = _purity(left) + _purity(right)
    gain = np.where(seen >= 0, kept - _purity(whole)[:, None], -np.inf)
    best = np.argmax(gain, axis=1)
    return best, np.take_along_axis(gain, best[:, None], axis=1)[:, 0]


def _purity(sides: np.ndarray) -> np.ndarray:
    n = sides.sum(axis=-1)
    return (sides**2).sum(axis=-1) / np.where(n > 0, n, 1.0)


def _parts(n: int, size: int) -> Iterator[tuple[int, slice]]:
    for part, at in enumerate(range(0, n, size)):
        yield part, slice(at, min(n, at + size))


def _in_open_nodes(block: Block, plan: Plan, tree: RandomTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, classes, position of the node among the open ones) of the tree's rows in open nodes."""
    own = block.rows_without(plan.held_out)
    x, y = block.x[own], block.y[own]
    slots = np.full(len(tree.feature), -1)
    slots[tree.open] = np.arange(len(tree.open))
    slot = slots[tree.nodes(x)]
    at = np.flatnonzero(slot >= 0)
    return x[at], y[at], slot[at]


def _wider(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [np.minimum(a[0], b[0]), np.maximum(a[1], b[1])]


def _ranges(blocks: list[Block], own_key: Callable[[int], bool], growing: dict[int, tuple[Plan, int, RandomTree]], size: int, width: int) -> Iterator[tuple]:
    """(tree, part, smallest and largest value by open node and feature)."""
    for m, (plan, _, tree) in ((m, g) for m, g in growing.items() if own_key(m)):
        low, high = np.full((len(tree.open), width), np.inf), np.full((len(tree.open), width), -np.inf)
        for block in blocks:
            x, _, slot = _in_open_nodes(block, plan, tree)
            if len(slot):
                order = np.argsort(slot, kind="stable")
                there, starts = np.unique(slot[order], return_index=True)
                low[there] = np.minimum(low[there], np.minimum.reduceat(x[order], starts, axis=0))
                high[there] = np.maximum(high[there], np.maximum.reduceat(x[order], starts, axis=0))
        for part, own in _parts(len(tree.open), size):
            yield m, part, [low[own].ravel(), high[own].ravel()]


def _below(
    blocks: list[Block], own_key: Callable[[int], bool], growing: dict[int, tuple[Plan, int, RandomTree]], size: int, looks: dict[int, tuple]
) -> Iterator[tuple]:
    """(tree, part, rows at or below each look's point by open node and class)."""
    for m, (plan, _, tree) in ((m, g) for m, g in growing.items() if own_key(m)):
        seen, point = looks[m]
        total = np.zeros((len(tree.open), seen.shape[1], 2), np.int64)
        for block in blocks:
            x, y, slot = _in_open_nodes(block, plan, tree)
            rows = np.arange(len(x))
            for k in range(seen.shape[1]):
                low = x[rows, seen[slot, k]] <= point[slot, k]
                found = np.bincount(2 * slot[low] + y[low], minlength=2 * len(tree.open))
                total[:, k] += found.reshape(-1, 2)
        for part, own in _parts(len(tree.open), size):
            yield m, part, [total[own].ravel()]


def _joined(found: dict[tuple, list[np.ndarray]], m: int, n: int, size: int) -> list[np.ndarray]:
    """The arrays of one tree, part after part."""
    parts = [found[m, part] for part, _ in _parts(n, size)]
    return [np.concatenate(c) for c in zip(*parts)]


def _grow_level(blocks: Blocks, growing: dict[int, tuple[Plan, int, RandomTree]], gains: dict[int, np.ndarray]) -> None:
    width, size = blocks.width, NODES_PER_PART
    opened = {m: tree.open for m, (_, _, tree) in growing.items()}
    plans = {m: (plan, number) for m, (plan, number, _) in growing.items()}

    def look(m: int, part: int, arrays: list[np.ndarray]) -> list[np.ndarray]:
        nodes = opened[m][part * size : (part + 1) * size]
        seen, point = drawn(*plans[m], nodes, *[a.reshape(len(nodes), width) for a in arrays])
        return [seen.ravel(), point.ravel()]

    found = blocks.summed(lambda held, own: _ranges(held, own, growing, size, width), _wider, look)
    looks = {m: tuple(a.reshape(len(nodes), -1) for a in _joined(found, m, len(nodes), size)) for m, nodes in opened.items()}
    counted = blocks.summed(lambda held, own: _below(held, own, growing, size, looks), lambda a, b: [a[0] + b[0]])
    for m, (plan, _, tree) in growing.items():
        seen, point = looks[m]
        below = _joined(counted, m, len(tree.open), size)[0].reshape(*seen.shape, 2)
        best, gain = chosen(plan, seen, below, tree.counts[tree.open])
        at = np.arange(len(best))
        split = np.flatnonzero(seen[at, best] >= 0)
        at, best = at[split], best[split]
        np.add.at(gains[m], seen[at, best], gain[split])
        tree.split(tree.open[at], seen[at, best], point[at, best], below[at, best])


def grow_side_by_side(rows: DataFrame, plans: list[Plan]) -> list[Forest]:
    """Grow all forests on ``rows`` (x array without missing values, y boolean, fold int)."""
    with packed(rows) as blocks:
        wanted = [(plan, number) for plan in plans for number in range(plan.trees)]
        made: list[RandomTree] = []
        gains = {m: np.zeros(blocks.width) for m in range(len(wanted))}
        most = max(1, min(2 ** max(0, max(p.depth for p in plans) - 1), sum(blocks.counts.values()) // 2))
        batch = max(1, NODES_AT_ONCE // most)
        for start in range(0, len(wanted), batch):
            growing = {}
            for m, (plan, number) in enumerate(wanted[start : start + batch], start):
                made.append(RandomTree(blocks.sizes(plan.held_out)))
                growing[m] = (plan, number, made[-1])
            level = 0
            while growing := {m: g for m, g in growing.items() if len(g[2].open) and level < g[0].depth}:
                _grow_level(blocks, growing, gains)
                level += 1
    forests, trees = [], iter(enumerate(made))
    for plan in plans:
        own, gained = [], np.zeros(len(gains[0]))
        for m, tree in (next(trees) for _ in range(plan.trees)):
            weighted = tree.counts * np.array(plan.class_weights)
            own.append((tree.feature, tree.cut, tree.left, weighted[:, 1] / weighted.sum(axis=1)))
            whole = gains[m].sum()
            gained += gains[m] / whole if whole > 0 else 0.0
        forests.append(Forest(own, gained.tolist()))
    return forests


def as_rows(dataset: DataFrame, features: str, label: str, fold) -> DataFrame:
    return dataset.select(vector_to_array(features).alias("x"), (F.col(label) == 1).alias("y"), fold.cast("int").alias("fold"))


def out_of_fold(
    params: dict, rows: DataFrame, features: str, label: str, keep: list[str], weights: dict[int, tuple[float, float]]
) -> DataFrame:
    """``keep`` and ``score``: the forests of all folds grow side by side."""
    plans = {fold: Plan(params["n_estimators"], params["max_depth"], class_weights=w, held_out=fold) for fold, w in weights.items()}
    forests = dict(zip(plans, grow_side_by_side(as_rows(rows, features, label, F.col("fold")), list(plans.values()))))
    return rows.select(*keep, score_by_fold(forests)(vector_to_array(features), "fold").alias("score"))


def score_by_fold(models: dict[int, object]):
    """A function of (x array, fold): each row's probability by the model that was fitted without its fold."""

    @F.arrow_udf("double")
    def score(lists: pa.Array, folds: pa.Array) -> pa.Array:
        fold, out = folds.to_numpy(zero_copy_only=False), np.full(len(folds), np.nan)
        values = matrix(lists, len(lists[0])) if len(lists) else None
        for held_out, model in models.items():
            own = np.flatnonzero(fold == held_out)
            if len(own):
                out[own] = model.probability(values[own])
        return pa.array(out)

    return score


class _ForestParams(HasFeaturesCol, HasLabelCol):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    classWeights = Param(Params._dummy(), "classWeights", "weights of classes 0 and 1", TypeConverters.toListFloat)
    looksAt = Param(Params._dummy(), "looksAt", "features a node looks at; 0: square root", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "decides every draw", TypeConverters.toInt)


class ExtremelyRandomTrees(Estimator, _ForestParams):
    """One forest of ``grow_side_by_side`` as a pipeline stage. Labels must hold both classes."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", trees=100, maxDepth=10, classWeights=(1.0, 1.0), looksAt=0, seed=42):
        super().__init__()
        self._setDefault(trees=100, maxDepth=10, classWeights=[1.0, 1.0], looksAt=0, seed=42)
        self._set(**(self._input_kwargs | {"classWeights": list(classWeights)}))

    def _fit(self, dataset: DataFrame) -> ExtremelyRandomTreesModel:
        features, label, get = self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault
        weights = tuple(get(self.classWeights))
        plan = Plan(get(self.trees), get(self.maxDepth), get(self.seed), weights, None, get(self.looksAt))
        forest = grow_side_by_side(as_rows(dataset, features, label, F.lit(-1)), [plan])[0]
        return ExtremelyRandomTreesModel(featuresCol=features, labelCol=label, forest=forest.to_json())


class ExtremelyRandomTreesModel(Model, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    forest = Param(Params._dummy(), "forest", "trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", forest=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def importances(self, n_features: int) -> list[float]:
        """Share of each feature in the impurity its splits take away, averaged over trees."""
        gains = Forest.from_json(self.getOrDefault(self.forest)).gains
        whole = sum(gains)
        return [g / whole if whole > 0 else 0.0 for g in gains]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_probability(dataset, self.getFeaturesCol(), Forest.from_json(self.getOrDefault(self.forest)))


def with_probability(dataset: DataFrame, features: str, model) -> DataFrame:
    """Probability and prediction by a model that scores a matrix."""

    @F.arrow_udf("double")
    def positive(lists: pa.Array) -> pa.Array:
        return pa.array(model.probability(matrix(lists, len(lists[0]))) if len(lists) else [], pa.float64())

    return (
        dataset.withColumn("__p", positive(vector_to_array(features)))
        .withColumns(
            {
                "probability": array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p"))),
                "prediction": F.when(F.col("__p") > 0.5, 1.0).otherwise(0.0),
            }
        )
        .drop("__p")
    )
