"""Boosting of trees over one binned table, any number of models side by side.

Features are cut into bins once and rows are packed into blocks, which all models share: folds and parameters differ per model, not
the table. One Spark job serves the open nodes of the current tree of every model: each task sums gradient, hessian and rows by
(model, node, feature, bin) over its blocks; the sums of all tasks are added, and only they reach the driver, which chooses the
splits. Their number depends on models, nodes and bins, never on rows. Tasks also look ahead: each grows the tree by its own sums, and
as far as all of them choose the splits that the driver then chooses by the whole sums, no further job is needed for that tree.

A table of few blocks (``WHOLE``) is not summed up in this way: each model grows in a task of its own that holds all rows, and all rounds
are one job (see ``whole``).

A block's scores are part of the table, which is written anew every few rounds with the trees since then worked in, so a round costs
the same however many came before it. In between, a worker process keeps the scores it has come to, as far as they fit ``HELD``, and applies
the trees that are new to it; another worker starts from the table. A lost executor costs a read.
"""

from __future__ import annotations

import json
import math
import pickle
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from cardwatch.learners.binning import Layout, alone, binned, blocks, cut_points, matrix, picked, rows_without_copies, sums_by_bin, unpacked_joints
from cardwatch.learners.trees import BranchingTree, Growth, SymmetricTree, Tree, begun, tree_from_lists
from cardwatch.learners.whole import Round, boost_whole, counted_splits
from cardwatch.session import discard, scratch_path

Fitted = SymmetricTree | BranchingTree

#: With at most so many blocks, a task holds them all and fits a model by itself.
WHOLE = 15
#: The table of scores is written anew after so many rounds.
EVERY = 32
#: Partitions stop growing trees ahead after so many rounds in which it saved no job.
TRIES = 3
#: With more bytes of sums than this, tasks' sums are added by other tasks before they reach the driver.
ADDED_BY_DRIVER = 1 << 25
#: Blocks of one task, where there are more blocks than cores.
TASK_BLOCKS = 4
#: Bytes of scores that a worker process keeps from one job to the next, at most.
HELD = 1 << 29

# What the libraries behind the presets do when nothing is said.
PRESETS = {
    "gradient_boosting": Growth(kind="level", gain="squares", depth=3),
    "xgboost": Growth(kind="level", gain="newton", depth=6, penalty=1.0, least_hessian=1.0),
    "lightgbm": Growth(kind="leaf", gain="newton", depth=2**30, leaves=31, least_rows=20, least_hessian=1e-3),
    "catboost": Growth(kind="symmetric", gain="newton", depth=6, penalty=3.0, missing_low=True),
    "adaboost": Growth(kind="stump", gain="gini", depth=1, missing_low=True),
}
#: Presets whose scores start at the log odds of the classes; the others start at 0.
STARTS_AT_ODDS = {"gradient_boosting", "xgboost", "lightgbm"}


@dataclass(frozen=True)
class Fit:
    """One of the models that are fitted side by side: on all rows but those of fold ``held_out``, weighted by class."""

    growth: Growth
    rounds: int
    rate: float
    class_weights: tuple[float, float] = (1.0, 1.0)
    held_out: int | None = None
    from_odds: bool = True


@dataclass
class Ensemble:
    """A fitted model: cut points, the score all rows start from, the trees, and the part of the score that is a log odds."""

    cuts: list[list[float]]
    start: float
    trees: list[Fitted]
    gains: list[float]
    scale: float = 1.0

    def margin(self, values: np.ndarray) -> np.ndarray:
        bins = binned(values, self.cuts)
        total = np.full(len(values), self.start)
        for tree in self.trees:
            total += tree.values(bins)
        return total

    def probability(self, values: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(values) * self.scale))

    def to_json(self) -> str:
        return json.dumps([self.cuts, self.start, [t.to_lists() for t in self.trees], self.gains, self.scale])

    @classmethod
    def from_json(cls, text: str) -> Ensemble:
        cuts, start, trees, gains, scale = json.loads(text)
        return cls(cuts, start, [tree_from_lists(t) for t in trees], gains, scale)


class _Scored:
    """The blocks with every model's scores, written anew every ``EVERY`` rounds.

    If there are fewer blocks than cores, each is there several times, for another share of the models each.
    """

    def __init__(self, packed: DataFrame, starts: list[float]):
        # Thousands of small jobs over one table: there is nothing to plan anew while they run.
        self.spark, self.path, self.stored = packed.sparkSession.newSession(), None, None
        self.spark.conf.set("spark.sql.adaptive.enabled", "false")
        # Every file is read by a task of its own.
        self.spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
        self.recent: list[list[Fitted]] = [[] for _ in starts]
        #: Trees per model that the table's scores hold already.
        self.worked_in = [0] * len(starts)
        first = np.array(starts)
        self.n_blocks = max(packed.count(), 1)
        shares = max(1, min(self.spark.sparkContext.defaultParallelism // self.n_blocks, len(starts)))
        rows = packed.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("shares", F.lit(shares))

        def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = zip(batch.column("n").to_pylist(), batch.column("share").to_pylist())
                scores = [np.repeat(first[share::shares], n).tobytes() for n, share in own]
                yield batch.append_column("scores", pa.array(scores, pa.binary()))

        # Dealt evenly by names of their own; at random some tasks would get several and others none.
        n_rows = self.n_blocks * shares
        rows = rows.repartitionByRange(min(n_rows, max(self.spark.sparkContext.defaultParallelism, -(-n_rows // TASK_BLOCKS))), "name", "share")
        self._write(rows.mapInArrow(begin, _schema(rows) + ", scores binary"))

    def _write(self, table: DataFrame) -> None:
        path = scratch_path(self.spark, "boosting")
        table.write.parquet(path)
        self.release()
        self.path = path
        self.stored = self.spark.read.schema(table.schema).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = self.stored.rdd.getNumPartitions()

    def renew(self) -> None:
        """Work the recent trees into the scores."""
        recent, worked_in = self.recent, self.worked_in

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = batch.schema.names
                scores = [_scores(row, recent, worked_in).tobytes() for row in rows_without_copies(batch)]
                yield batch.set_column(names.index("scores"), "scores", pa.array(scores, pa.binary()))

        self._write(self.stored.mapInArrow(add, self.stored.schema))
        self.worked_in = [n + len(trees) for n, trees in zip(worked_in, recent)]
        self.recent = [[] for _ in recent]

    def grow(self, fits: list[Fit], growing: dict[int, Tree], layout: Layout, ahead: bool) -> dict[int, dict[tuple, dict] | Tree]:
        """Per model, step and tree the sums of the nodes that are wanted then, and the number of partitions they come from.

        With ``ahead``, every partition goes on after the first step and grows the tree by its own sums alone, down to the end. Where
        all partitions come to the same tree as the driver does by everybody's sums, the next sums are there already. If there is one
        block, there is nobody to agree with, and what comes back is the tree itself.
        """
        asked = {m: (fits[m], None if ahead else (t.compact(), t.wanted(), len(t.feature)), t.signature()) for m, t in growing.items()}
        recent, worked_in, names = self.recent, self.worked_in, ["model", "step", "tree", "node", "parts", "sums"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary()]

        alone = ahead and self.n_blocks == 1

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [_Block(row, recent, worked_in, layout) for batch in batches for row in rows_without_copies(batch)]
            rows = [(m, *found) for m, what in asked.items() for found in _grow_here(m, *what, held, layout, alone)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list] = {}
            for batch in batches:
                for *key, parts, raw in zip(*[c.to_pylist() for c in batch.columns]):
                    _add_to(held, tuple(key), parts, np.frombuffer(raw))
            rows = [(*key, parts, sums.tobytes()) for key, (parts, sums) in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

        schema = "model int, step int, tree string, node int, parts int, sums binary"
        parts = self.stored.mapInArrow(count, schema)
        nodes = sum(t.most_sums() if ahead else len(t.wanted()) for t in growing.values())
        if not alone and self.parts * nodes * layout.total * 24 > ADDED_BY_DRIVER:
            # As many tasks as run at a time: each is a job's overhead.
            adders = self.spark.sparkContext.defaultParallelism
            parts = parts.repartition(adders, "model", "step", "tree", "node").mapInArrow(add, schema)
        if alone:
            return {r["model"]: pickle.loads(r["sums"]) for r in parts.collect()}
        held: dict[tuple, list] = {}
        for r in parts.collect():
            _add_to(held, tuple(r[:4]), r["parts"], np.frombuffer(r["sums"]))
        found: dict[int, dict[tuple, dict]] = {m: {} for m in growing}
        for (model, step, tree, node), (n, sums) in held.items():
            found[model].setdefault((step, tree), {})[node] = (n, sums.reshape(layout.total, 3))
        return found

    def release(self) -> None:
        if self.path:
            self.stored.unpersist()
            discard(self.spark, self.path)
            self.path = None


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _add_to(held: dict[tuple, list], key: tuple, parts: int, sums: np.ndarray) -> None:
    if key in held:
        held[key] = [held[key][0] + parts, held[key][1] + sums]
    else:
        held[key] = [parts, sums]


#: By block and share: trees per model that are worked in, and the scores. The block used last comes last; only one fit's blocks are kept.
_kept: OrderedDict[tuple, tuple[list[int], np.ndarray]] = OrderedDict()


def _scores(row: dict, recent: list[list[Fitted]], worked_in: list[int]) -> np.ndarray:
    """Scores of the block's models, (models, rows), with the recent trees."""
    own = slice(row["share"], None, row["shares"])
    before, trees = worked_in[own], recent[own]
    name = (row["name"], row["share"], row["shares"])
    done, scores = _kept.pop(name, (None, None))
    if done is None or any(not n <= d <= n + len(t) for d, n, t in zip(done, before, trees)):
        done, scores = before, np.frombuffer(row["scores"]).reshape(-1, row["n"]).copy()
    bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])
    for total, d, n, new in zip(scores, done, before, trees):
        for tree in new[d - n :]:
            total += tree.values(bins)
    for other in [k for k in _kept if k[0][:32] != row["name"][:32]]:
        del _kept[other]
    _kept[name] = [n + len(t) for n, t in zip(before, trees)], scores
    while len(_kept) > 1 and sum(s.nbytes for _, s in _kept.values()) > HELD:
        _kept.popitem(last=False)
    return scores


class _Block:
    """One block as arrays."""

    def __init__(self, row: dict, recent: list[list[Fitted]], worked_in: list[int], layout: Layout):
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])
        self.joints = unpacked_joints(row["joints"], self.bins, layout)
        self.y = np.frombuffer(row["y"], np.uint8)
        self.fold = np.frombuffer(row["fold"], np.int32)
        self.weight = np.frombuffer(row["weight"]) if len(row["weight"]) else np.ones(len(self.y))
        self.share, self.shares = row["share"], row["shares"]
        self.scores = _scores(row, recent, worked_in)

    def holds(self, model: int) -> bool:
        return model % self.shares == self.share

    def summands(self, model: int, fit: Fit, often: bool) -> tuple[_Block, np.ndarray, tuple | Callable[[np.ndarray], tuple]]:
        """(the block, which rows are the model's, what each row adds, or, unless that is asked for ``often``, what some rows add)."""
        weight = self.weight * np.where(self.y == 1, fit.class_weights[1], fit.class_weights[0])
        own = weight > 0
        if fit.held_out is not None:
            own &= self.fold != fit.held_out
        score = self.scores[model // self.shares]
        if often:
            return self, own, _summands(weight, self.y, score, fit.growth.gain)
        return self, own, lambda at: _summands(weight[at], self.y[at], score[at], fit.growth.gain)


def _grow_here(
    model: int, fit: Fit, start: tuple | None, signature: str, held: list[_Block], layout: Layout, alone: bool
) -> Iterator[tuple[int, str, int, int, bytes]]:
    """(step, tree, node, 1, sums) of the blocks at hand: one step of a tree that is given, or all steps of a new one.

    ``alone``: the grown tree in place of the sums of its steps.
    """
    own = [b.summands(model, fit, often=start is None) for b in held if b.holds(model)]
    if not own:
        return
    if start is not None:
        flat, nodes, n_nodes = start
        for node, sums in zip(nodes, _sums(own, flat, nodes, n_nodes, layout, fit.growth.counts_jointly)):
            yield 0, signature, node, 1, sums.tobytes()
        return
    tree, step = begun(fit.growth), 0
    while not tree.done:
        nodes, signature = tree.wanted(), tree.signature()
        found = _sums(own, tree.compact(), nodes, len(tree.feature), layout, fit.growth.counts_jointly)
        if not alone:
            for node, sums in zip(nodes, found):
                yield step, signature, node, 1, sums.tobytes()
        tree.take(dict(zip(nodes, found)), layout)
        step += 1
    if alone:
        tree.sums = {}
        yield step, "", 0, 1, pickle.dumps(tree)


def _sums(own: list[tuple], flat: Fitted, nodes: list[int], n_nodes: int, layout: Layout, jointly: bool = False) -> np.ndarray:
    """Sums by bin of each wanted node: (nodes, bins, 3)."""
    total = np.zeros((len(nodes), layout.total, 3))
    for block, rows, values in own:
        at, slot = flat.located(block.bins, np.flatnonzero(rows), nodes)
        joints = block.joints if jointly else alone(block.bins, layout)
        total += sums_by_bin(joints, at, slot, len(nodes), values(at) if callable(values) else picked(values, at), layout)
    return total


def _summands(weight: np.ndarray, y: np.ndarray, score: np.ndarray, gain: str) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """What a row adds to the sums of its node; None is 1."""
    if gain == "gini":
        # Rows that the stumps so far get wrong weigh more: the product of all rounds' factors.
        grown = weight * np.exp(np.where(y == 1, -score, score) / 2)
        return grown * y, grown * (1 - y), None
    p = 1.0 / (1.0 + np.exp(-score))
    return weight * (p - y), weight * p * (1 - p), weight if gain == "squares" and (weight != 1).any() else None


def fit_side_by_side(rows: DataFrame, fits: list[Fit], *, most_cuts: int = 128, cuts: list[list[float]] | None = None) -> list[Ensemble]:
    """Fit all models on ``rows`` (x array, y boolean, fold int, weight double)."""
    if cuts is None:
        cuts = cut_points(rows, "x", most_cuts)
    layout = Layout(cuts)
    packed_path = scratch_path(rows.sparkSession, "blocks")
    try:
        starts, n_rows = _starts(rows, fits)
        packed = blocks(rows, cuts, n_rows)
        packed.write.parquet(packed_path)
        packed = rows.sparkSession.read.schema(packed.schema).parquet(packed_path)
        if packed.count() <= WHOLE:
            made = boost_whole(rows.sparkSession, packed_path, packed.schema, fits, starts, layout, _summands)
            return _scaled([_ensemble(cuts, start, own) for start, own in zip(starts, made)], fits)
        return _boost(packed, fits, starts, cuts, layout)
    finally:
        discard(rows.sparkSession, packed_path)


def _starts(rows: DataFrame, fits: list[Fit]) -> tuple[list[float], int]:
    """Log odds of the weighted classes in each model's rows, or 0; and the number of all rows."""
    found = rows.groupBy("fold", "y").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    sums = {(r["fold"], r["y"]): r["w"] for r in found}
    starts = []
    for fit in fits:
        by_class = [fit.class_weights[y] * sum(w for (fold, own), w in sums.items() if own == bool(y) and fold != fit.held_out) for y in (0, 1)]
        if min(by_class) <= 0 and fit.from_odds:
            raise ValueError("boosting needs rows of both classes")
        starts.append(math.log(by_class[1] / by_class[0]) if fit.from_odds else 0.0)
    return starts, sum(r["n"] for r in found)


def _boost(packed: DataFrame, fits: list[Fit], starts: list[float], cuts: list[list[float]], layout: Layout) -> list[Ensemble]:
    found = [Ensemble(cuts, start, [], [0.0] * len(cuts)) for start in starts]
    ended: set[int] = set()
    in_vain = 0
    scored = _Scored(packed, starts)
    try:
        for done in range(max(f.rounds for f in fits)):
            trees = {m: begun(fit.growth) for m, fit in enumerate(fits) if done < fit.rounds and m not in ended}
            if not trees:
                break
            saved = 0
            if in_vain < TRIES:
                for m, known in scored.grow(fits, trees, layout, ahead=True).items():
                    if isinstance(known, Tree):
                        trees[m], saved = known, saved + 1
                    else:
                        saved += _agreed(trees[m], known, layout) - 1
                in_vain = 0 if saved else in_vain + 1
            while growing := {m: t for m, t in trees.items() if not t.done}:
                for m, known in scored.grow(fits, growing, layout, ahead=False).items():
                    _agreed(growing[m], known, layout)
            for m, tree in trees.items():
                tree.finish(fits[m].rate)
                if tree.last:
                    ended.add(m)
                if tree.useless:
                    continue
                flat = tree.compact()
                found[m].trees.append(flat)
                scored.recent[m].append(flat)
                for feature, gain in counted_splits(tree):
                    found[m].gains[feature] += gain
            if done % EVERY == EVERY - 1:
                scored.renew()
    finally:
        scored.release()
    return _scaled(found, fits)


def _ensemble(cuts: list[list[float]], start: float, made: list[Round]) -> Ensemble:
    found = Ensemble(cuts, start, [tree for tree, _ in made], [0.0] * len(cuts))
    for _, splits in made:
        for feature, gain in splits:
            found.gains[feature] += gain
    return found


def _scaled(found: list[Ensemble], fits: list[Fit]) -> list[Ensemble]:
    for fit, ensemble in zip(fits, found):
        if fit.growth.kind == "stump":
            whole = sum(np.abs(t.value).max() for t in ensemble.trees)
            ensemble.scale = 1.0 / whole if whole else 1.0
    return found


def _agreed(tree: Tree, known: dict[tuple, dict], layout: Layout) -> int:
    """Grow a tree as far as the sums of all partitions are known; the number of steps."""
    parts = max(n for (step, _), nodes in known.items() if step == 0 for n, _ in nodes.values())
    step = 0
    while not tree.done:
        sums = known.get((step, tree.signature()), {})
        if any(sums.get(node, (0, None))[0] < parts for node in tree.wanted()):
            break
        tree.take({node: sums[node][1] for node in tree.wanted()}, layout)
        step += 1
    return step


def class_weighted(params: dict, preset: str, class_weights: tuple[float, float] = (1.0, 1.0), held_out: int | None = None) -> Fit:
    """A preset with a learner's parameters: rounds, rate, depth."""
    growth = PRESETS[preset]
    depth = params.get("max_depth", params.get("depth", growth.depth))
    rounds = params.get("n_estimators", params.get("iterations", 1000 if preset == "catboost" else 100))
    return Fit(replace(growth, depth=depth), rounds, params["learning_rate"], class_weights, held_out, preset in STARTS_AT_ODDS)


class _BoosterParams(HasFeaturesCol, HasLabelCol, HasWeightCol):
    preset = Param(Params._dummy(), "preset", "gradient_boosting, xgboost, lightgbm or catboost", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinks every tree", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    maxCuts = Param(Params._dummy(), "maxCuts", "candidate splits per feature", TypeConverters.toInt)


class HistogramBooster(Estimator, _BoosterParams):
    """One model of ``fit_side_by_side`` as a pipeline stage."""

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", weightCol=None, preset="gradient_boosting", rounds=100, learningRate=0.1,
        maxDepth=3, maxCuts=128,
    ):
        super().__init__()
        self._setDefault(maxCuts=128)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> HistogramBoosterModel:
        features, label = self.getFeaturesCol(), self.getLabelCol()
        get = self.getOrDefault
        fit = class_weighted({"learning_rate": get(self.learningRate), "n_estimators": get(self.rounds), "max_depth": get(self.maxDepth)}, get(self.preset))
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        rows = as_rows(dataset, features, label, fold=F.lit(-1), weight=weight)
        found = fit_side_by_side(rows, [fit], most_cuts=get(self.maxCuts))[0]
        return HistogramBoosterModel(featuresCol=features, labelCol=label, ensemble=found.to_json())


def as_rows(dataset: DataFrame, features: str, label: str, *, fold=None, weight=None) -> DataFrame:
    """The columns ``fit_side_by_side`` reads."""
    return dataset.select(
        vector_to_array(features).alias("x"),
        (F.col(label) == 1).alias("y"),
        (F.col("fold") if fold is None else fold).cast("int").alias("fold"),
        (F.lit(1.0) if weight is None else weight).alias("weight"),
    )


class HistogramBoosterModel(Model, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    ensemble = Param(Params._dummy(), "ensemble", "cut points, start and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", ensemble=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitted(self) -> Ensemble:
        return Ensemble.from_json(self.getOrDefault(self.ensemble))

    def importances(self, n_features: int) -> list[float]:
        """Share of the total gain each feature's splits hold."""
        gains = self.fitted().gains
        whole = sum(gains)
        return [g / whole if whole > 0 else 0.0 for g in gains]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.fitted()

        @F.arrow_udf("double")
        def positive(lists: pa.Array) -> pa.Array:
            return pa.array(found.probability(matrix(lists, len(found.cuts))))

        return (
            dataset.withColumn("__p", positive(vector_to_array(self.getFeaturesCol())))
            .withColumns(
                {
                    "probability": array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p"))),
                    "prediction": F.when(F.col("__p") > 0.5, 1.0).otherwise(0.0),
                }
            )
            .drop("__p")
        )


def held_out_scores(trials: list[dict[int, Ensemble]]):
    """A function of (x array, fold): per trial each row's probability by the model that was fitted without its fold."""

    @F.arrow_udf("array<double>")
    def score(lists: pa.Array, folds: pa.Array) -> pa.Array:
        fold = folds.to_numpy(zero_copy_only=False)
        out = np.full((len(fold), len(trials)), np.nan)
        if len(fold):
            values = matrix(lists, len(lists[0]))
            for held_out in trials[0]:
                rows = np.flatnonzero(fold == held_out)
                for k, models in enumerate(trials):
                    out[rows, k] = models[held_out].probability(values[rows])
        ends = np.arange(len(fold) + 1, dtype=np.int32) * len(trials)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return score


@dataclass(frozen=True)
class Trial:
    """A preset with parameters, and the weights of the two classes when a fold is held out."""

    preset: str
    params: dict
    weights: dict[int, tuple[float, float]]


def out_of_fold(rows: DataFrame, features: str, label: str, keep: list[str], trials: list[Trial]) -> DataFrame:
    """``keep`` and ``scores``, one per trial: models of all trials and folds are fitted side by side, and score in one scan."""
    fits = [class_weighted(t.params, t.preset, by_class, fold) for t in trials for fold, by_class in sorted(t.weights.items())]
    found = iter(fit_side_by_side(as_rows(rows, features, label), fits))
    models = [{fold: next(found) for fold in sorted(t.weights)} for t in trials]
    return rows.select(*keep, held_out_scores(models)(vector_to_array(features), "fold").alias("scores"))
