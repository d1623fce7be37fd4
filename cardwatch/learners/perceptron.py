"""A perceptron with hidden layers, an L2 penalty and Adam steps.

Each step is one Spark job: tasks sum the gradients of their blocks, other tasks add them where there are many, and the driver takes
the step. What travels is one gradient per model and task, whatever the number of rows. The models of all folds take
their steps in the same jobs. Steps use all rows, so the order of rows and their place do not matter but for rounding.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.extra_trees import as_rows, score_by_fold, with_probability
from cardwatch.learners.raw_blocks import Block, packed

# Fixed values of Adam: decay of both means, and what keeps the divisor from zero.
DECAY, SQUARE_DECAY, TINY = 0.9, 0.999, 1e-8
#: A fit ends after so many steps in a row that lower the loss by less than ``TOLERANCE``.
PATIENCE, TOLERANCE = 10, 1e-5
#: Rate of steps over all rows, if none is given.
RATE = 0.01


@dataclass(frozen=True)
class Net:
    """What is to be fitted: hidden layers, penalty per weight, rate, most steps; on all rows but those of fold ``held_out``."""

    hidden: tuple[int, ...]
    alpha: float = 1e-4
    rate: float = RATE
    steps: int = 500
    seed: int = 42
    held_out: int | None = None


@dataclass
class Layers:
    """Weights (inputs, outputs) and biases of each layer; inputs are shifted and divided first. One output: the log odds."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]
    shift: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """Inputs of each layer, and the log odds as the last entry."""
        held = [(x - self.shift) / self.scale]
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            z = held[-1] @ w + b
            held.append(np.maximum(z, 0.0) if i < len(self.weights) - 1 else z)
        return held

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.forward(x)[-1][:, 0])

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (*self.weights, *self.biases)])

    def replaced(self, flat: np.ndarray) -> Layers:
        arrays, at = [], 0
        for a in (*self.weights, *self.biases):
            arrays.append(flat[at : at + a.size].reshape(a.shape))
            at += a.size
        n = len(self.weights)
        return Layers(arrays[:n], arrays[n:], self.shift, self.scale)

    def to_json(self) -> str:
        parts = (*self.weights, *self.biases, self.shift, self.scale)
        return json.dumps([a.tolist() for a in parts])

    @classmethod
    def from_json(cls, text: str) -> Layers:
        *arrays, shift, scale = [np.array(a, float) for a in json.loads(text)]
        n = len(arrays) // 2
        return cls(arrays[:n], arrays[n:], shift, scale)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(z / 2))


def begun(net: Net, width: int, shift: np.ndarray, scale: np.ndarray) -> Layers:
    """Uniform weights whose range falls with the layer's inputs and outputs, by seed."""
    rng, sizes = np.random.default_rng(net.seed), [width, *net.hidden, 1]
    weights, biases = [], []
    for i, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
        bound = math.sqrt((2.0 if i == len(sizes) - 2 else 6.0) / (fan_in + fan_out))
        weights.append(rng.uniform(-bound, bound, (fan_in, fan_out)))
        biases.append(rng.uniform(-bound, bound, fan_out))
    return Layers(weights, biases, shift, scale)


def gradient(layers: Layers, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Sum of the rows' gradients, laid out as ``flat``, and of their log losses."""
    held = layers.forward(x)
    z = held[-1][:, 0]
    loss = float((np.logaddexp(0.0, z) - y * z).sum())
    back = (sigmoid(z) - y)[:, None]
    weights, biases = [], []
    for i in range(len(layers.weights) - 1, -1, -1):
        weights.append(held[i].T @ back)
        biases.append(back.sum(axis=0))
        if i:
            back = (back @ layers.weights[i].T) * (held[i] > 0)
    return np.concatenate([a.ravel() for a in (*weights[::-1], *biases[::-1])]), loss


@dataclass
class Descent:
    """A model on its way: Adam's two means, the best loss, and for how long it has not got better."""

    net: Net
    layers: Layers
    n_rows: int
    steps: int = 0
    best: float = math.inf
    idle: int = 0
    losses: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.means = np.zeros((2, len(self.layers.flat())))

    @property
    def done(self) -> bool:
        return self.steps >= self.net.steps or self.idle >= PATIENCE

    def step(self, summed: np.ndarray, loss: float) -> None:
        flat = self.layers.flat()
        n_weights = sum(w.size for w in self.layers.weights)
        # Biases are not penalised.
        pull = np.where(np.arange(len(flat)) < n_weights, self.net.alpha * flat, 0.0)
        mean_gradient = (summed + pull) / self.n_rows
        loss = (loss + 0.5 * float(pull @ flat)) / self.n_rows
        self.losses.append(loss)
        self.idle = self.idle + 1 if loss > self.best - TOLERANCE else 0
        self.best = min(self.best, loss)
        self.steps += 1
        self.means[0] = DECAY * self.means[0] + (1 - DECAY) * mean_gradient
        self.means[1] = SQUARE_DECAY * self.means[1] + (1 - SQUARE_DECAY) * mean_gradient**2
        rate = self.net.rate * math.sqrt(1 - SQUARE_DECAY**self.steps) / (1 - DECAY**self.steps)
        self.layers = self.layers.replaced(flat - rate * self.means[0] / (np.sqrt(self.means[1]) + TINY))


def _gradients(blocks: list[Block], own_key: Callable[[int], bool], growing: dict[int, tuple[Net, Layers]]) -> Iterator[tuple]:
    for m, (net, layers) in ((m, g) for m, g in growing.items() if own_key(m)):
        total, loss = 0.0, 0.0
        for block in blocks:
            own = block.rows_without(net.held_out)
            g, l = gradient(layers, block.x[own], block.y[own].astype(float))
            total, loss = total + g, loss + l
        yield m, 0, [total, np.array([loss])]


def descend_side_by_side(rows: DataFrame, nets: list[Net], scales: list[tuple[np.ndarray, np.ndarray]] | None = None) -> list[Descent]:
    """Fit all nets on ``rows`` (x array without missing values, y boolean, fold int), each with its own (shift, scale)."""
    with packed(rows) as blocks:
        plain = (np.zeros(blocks.width), np.ones(blocks.width))
        found = []
        for m, net in enumerate(nets):
            n_rows = sum(blocks.sizes(net.held_out))
            if not n_rows:
                raise ValueError("a fold holds all rows")
            found.append(Descent(net, begun(net, blocks.width, *(scales[m] if scales else plain)), n_rows))
        while growing := {m: (d.net, d.layers) for m, d in enumerate(found) if not d.done}:
            add = lambda a, b: [p + q for p, q in zip(a, b)]
            sent = sum(8 * (len(layers.flat()) + 1) for _, layers in growing.values())
            counted = blocks.summed(lambda held, own, g=growing: _gradients(held, own, g), add, task_bytes=sent)
            for (m, _), (summed, loss) in counted.items():
                found[m].step(summed, float(loss[0]))
    return found


def scales_without(rows: DataFrame, folds: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and population deviation of each position of ``x`` outside each fold; a constant position keeps a deviation of 1."""
    spread = rows.select("fold", F.posexplode("x").alias("at", "v")).groupBy("fold", "at")
    parts = spread.agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var")).orderBy("at").collect()
    out = []
    for fold in folds:
        n, mean, var = (np.array([[r[c] for r in parts if r["fold"] == f] for f in {r["fold"] for r in parts} - {fold}]) for c in ("n", "mean", "var"))
        whole = n.sum(axis=0)
        centre = (n * mean).sum(axis=0) / whole
        deviation = np.sqrt((n * (var + (mean - centre) ** 2)).sum(axis=0) / whole)
        out.append((centre, np.where(deviation > 0, deviation, 1.0)))
    return out


def net_of(params: dict, held_out: int | None = None) -> Net:
    """A learner's parameters: ``hidden_layer_sizes``, ``alpha``, ``learning_rate_init``, ``max_iter``."""
    return Net(
        tuple(params["hidden_layer_sizes"]), params.get("alpha", 1e-4), params.get("learning_rate_init", RATE), params.get("max_iter", 500),
        held_out=held_out,
    )


def out_of_fold(params: dict, rows: DataFrame, features: str, label: str, keep: list[str], weights: dict, scaled: bool = True) -> DataFrame:
    """``keep`` and ``score``: the models of all folds descend side by side, each with the scale of its own training rows."""
    folds = sorted(weights)
    table = as_rows(rows, features, label, F.col("fold"))
    scales = scales_without(table, folds) if scaled else None
    found = descend_side_by_side(table, [net_of(params, fold) for fold in folds], scales)
    models = {fold: d.layers for fold, d in zip(folds, found)}
    return rows.select(*keep, score_by_fold(models)(vector_to_array(features), "fold").alias("score"))


class _PerceptronParams(HasFeaturesCol, HasLabelCol, HasMaxIter):
    layers = Param(Params._dummy(), "layers", "sizes of the hidden layers", TypeConverters.toListInt)
    alpha = Param(Params._dummy(), "alpha", "L2 penalty", TypeConverters.toFloat)
    stepSize = Param(Params._dummy(), "stepSize", "rate of the steps", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "decides the first weights", TypeConverters.toInt)


class PenalisedPerceptron(Estimator, _PerceptronParams):
    """One model of ``descend_side_by_side`` as a pipeline stage."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", layers=None, alpha=1e-4, stepSize=RATE, maxIter=500, seed=42):
        super().__init__()
        self._setDefault(layers=[50], alpha=1e-4, stepSize=RATE, maxIter=500, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PerceptronModel:
        features, label, get = self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault
        net = Net(tuple(get(self.layers)), get(self.alpha), get(self.stepSize), self.getMaxIter(), get(self.seed))
        found = descend_side_by_side(as_rows(dataset, features, label, F.lit(-1)), [net])[0]
        return PerceptronModel(featuresCol=features, labelCol=label, fitted=found.layers.to_json())


class PerceptronModel(Model, _PerceptronParams, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "weights and biases as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", fitted=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_probability(dataset, self.getFeaturesCol(), Layers.from_json(self.getOrDefault(self.fitted)))
