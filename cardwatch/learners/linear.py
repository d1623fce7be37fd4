"""Logistic regressions with an L2 penalty, any number of models side by side.

All models descend over one packed table. Each of their evaluations is one Spark job: tasks multiply their blocks by the coefficients of
all models at once and sum losses and gradients, and only these reach the driver, which takes the steps. What travels depends on models
and features, never on rows. Objective, inner scaling, L-BFGS steps and tolerance are those of Spark's own estimator, so the models are
the same but for rounding.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.learners.boosting import held_out_scores
from cardwatch.learners.extra_trees import as_rows
from cardwatch.learners.perceptron import sigmoid
from cardwatch.learners.raw_blocks import Block, Blocks, packed

#: Fixed values of the descent: steps it remembers, values it compares, tolerance.
MEMORY, VALUES, TOLERANCE = 10, 20, 1e-6
#: A column that spreads less than this, for its mean, is constant.
CONSTANT = 1e-12


@dataclass(frozen=True)
class LinearFit:
    """A model to be fitted. ``penalty`` is per unit of weight and, with ``scaled``, on coefficients of z-scored columns.

    ``without``: (divisor, modulus, value) of the folds' numbers that are left out, any of them; a number may hold several digits.
    """

    penalty: float
    steps: int
    class_weights: tuple[float, float] = (1.0, 1.0)
    scaled: bool = True
    without: tuple[tuple[int, int, int], ...] = ()

    def __post_init__(self) -> None:
        if not self.penalty >= 0:
            raise ValueError("a penalty may not be negative")

    def takes(self, fold: np.ndarray) -> np.ndarray:
        own = np.ones(np.shape(fold), bool)
        for divisor, modulus, value in self.without:
            own &= fold // divisor % modulus != value
        return own


@dataclass(frozen=True)
class Line:
    coefficients: np.ndarray
    intercept: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coefficients + self.intercept

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


@dataclass(frozen=True)
class Scale:
    """A model's inner columns are (x - centre) / spread, 0 where constant; ``penalty`` is that of each inner coefficient."""

    centre: np.ndarray
    spread: np.ndarray
    penalty: np.ndarray
    weight: float
    odds: float

    def line(self, inner: np.ndarray) -> Line:
        coefficients = np.where(self.spread > 0, inner[:-1] / np.where(self.spread > 0, self.spread, 1.0), 0.0)
        return Line(coefficients, float(inner[-1] - self.centre @ coefficients))

    def objective(self, inner: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray]:
        """Value and gradient at inner coefficients and intercept, given sums over rows (see ``_sums``)."""
        *by_column, slope, loss = sums
        steep = np.array(by_column) - self.centre * slope
        gradient = np.append(np.where(self.spread > 0, steep / np.where(self.spread > 0, self.spread, 1.0), 0.0), slope) / self.weight
        gradient[:-1] += self.penalty * inner[:-1]
        return loss / self.weight + 0.5 * float(self.penalty @ inner[:-1] ** 2), gradient


# --- the descent --------------------------------------------------------------------------------


class SearchFailed(Exception):
    pass


#: Yields points, is sent (value, gradient) there.
Evaluations = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def descent(start: np.ndarray, steps: int) -> Evaluations:
    """Limited-memory quasi-Newton steps; returns the last point."""
    x = start
    value, gradient = yield x
    first, past, history, failed, done = value, [math.inf], [], False, 0
    while done < steps and np.linalg.norm(gradient) > max(TOLERANCE * value, 1e-8):
        if len(past) > 1 and abs(value - max(past)) <= TOLERANCE * first:
            break
        try:
            direction = _direction(history, gradient)
            found = yield from _wolfe(x, value, gradient, direction, done)
        except SearchFailed:
            if failed:
                break
            failed, history = True, []
            continue
        history = [(found[0] - x, found[2] - gradient), *history][:MEMORY]
        x, value, gradient = found
        past, failed, done = [*past, value][-VALUES:], False, done + 1
    return x


def _direction(history: list[tuple[np.ndarray, np.ndarray]], gradient: np.ndarray) -> np.ndarray:
    out, shares = gradient.copy(), []
    for step, change in history:
        shares.append((step @ out) / (step @ change))
        out -= shares[-1] * change
    if history:
        step, change = history[0]
        if not step @ change >= 0:
            raise SearchFailed
        out *= (step @ change) / (change @ change)
    for (step, change), share in zip(history[::-1], shares[::-1]):
        out += (share - (change @ out) / (step @ change)) * step
    if not np.isfinite(out).all():
        raise SearchFailed
    return -out


def _wolfe(x: np.ndarray, value: float, gradient: np.ndarray, direction: np.ndarray, done: int) -> Evaluations:
    """The point along the direction that meets the strong Wolfe conditions: (point, value, gradient)."""
    slope = float(direction @ gradient)
    if slope > 0:
        raise SearchFailed

    def at(t: float) -> Generator:
        point = x + direction * t
        v, g = yield point
        return t, v, float(direction @ g), (point, v, g)

    def accepted(found: tuple) -> tuple:
        if found[0] * np.linalg.norm(gradient) < 1e-10:
            raise SearchFailed
        return found[3]

    def between(low: tuple, high: tuple) -> Generator:
        for _ in range(10):
            c = yield from at(_cubic(*sorted((low, high), key=lambda b: b[0])))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return accepted(c)
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed

    low, t = (0.0, value, slope, None), 1.0 if done else 1.0 / np.linalg.norm(direction)
    for i in range(10):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (i and c[1] >= low[1]):
            return (yield from between(low, c))
        if abs(c[2]) <= 0.9 * abs(slope):
            return accepted(c)
        if c[2] >= 0:
            return (yield from between(c, low))
        low, t = c, t * 1.5
    raise SearchFailed


def _cubic(left: tuple, right: tuple) -> float:
    """Where a cubic through both ends is least, not too near to an end."""
    (a, fa, da, _), (b, fb, db, _) = left, right
    bend = da + db - 3 * (fa - fb) / (a - b)
    root = math.sqrt(max(bend * bend - da * db, 0.0))
    below = db - da + 2 * root
    t = b - (b - a) * (db + root - bend) / below if below else a
    return min(max(t, a + 0.1 * (b - a)), a + 0.9 * (b - a))


# --- jobs ---------------------------------------------------------------------------------------


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [p + q for p, q in zip(a, b)]


def _groups(blocks: list[Block], fits: list[LinearFit]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(values, class, weight in each model) of the rows of one fold and class, which weigh the same; 0 where they are left out."""
    known: dict[tuple[int, int], np.ndarray] = {}
    for block in blocks:
        kind = 2 * block.fold.astype(np.int64) + block.y
        order = np.argsort(kind, kind="stable")
        kinds, starts = np.unique(kind[order], return_index=True)
        for own, rows in zip(kinds.tolist(), np.split(order, starts[1:])):
            fold, y = divmod(own, 2)
            if own not in known:
                known[own] = np.array([f.class_weights[y] if f.takes(np.array(fold)) else 0.0 for f in fits])
            yield block.x[rows], y, known[own]


def _moments(blocks: list[Block], own_key: Callable[[int], bool], fits: dict[int, LinearFit], centre: np.ndarray) -> Iterator[tuple]:
    """(model, part, weighted and plain sums of the columns' values and squares around ``centre``)."""
    own = {m: f for m, f in fits.items() if own_key(m)}
    if not own:
        return
    total = np.zeros((len(own), 2, 2 * len(centre)))
    for x, _, weights in _groups(blocks, list(own.values())):
        x = x - centre
        values = np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])
        total += np.stack([weights, weights > 0], axis=1)[:, :, None] * values
    for sums, m in zip(total, own):
        yield m, 0, [sums.ravel()]


#: Rows whose losses are taken at once: a product of so many factors of at most 2 is a number.
SLICE = 512


def _sums(blocks: list[Block], own_key: Callable[[int], bool], asked: dict[int, tuple[LinearFit, Line]]) -> Iterator[tuple]:
    """(model, part, by column the sum of slope times value; the sum of slopes, of losses). A slope is the loss's, by margin."""
    own = {m: a for m, a in asked.items() if own_key(m)}
    if not own:
        return
    fits, lines = [f for f, _ in own.values()], [line for _, line in own.values()]
    coefficients, intercepts = np.stack([line.coefficients for line in lines], axis=1), np.array([line.intercept for line in lines])
    total = np.zeros((len(coefficients) + 2, len(own)))
    for x, y, weights in _groups(blocks, fits):
        side = 1.0 if y else -1.0
        at = np.flatnonzero(weights > 0)
        turned, offset = -side * coefficients[:, at], -side * intercepts[at]
        found = np.zeros((len(total), len(at)))
        for start in range(0, len(x), SLICE):
            part = x[start : start + SLICE]
            against = part @ turned
            against += offset
            steep = np.exp(-np.abs(against))
            factors = 1.0 + steep
            found[-1] += np.maximum(against, 0.0).sum(axis=0) + np.log(factors.prod(axis=0))
            steep[against > 0] = 1.0
            steep /= factors
            found[:-2] += part.T @ steep
            found[-2] += steep.sum(axis=0)
        found[:-1] *= -side
        total[:, at] += found * weights[at]
    for k, m in enumerate(own):
        yield m, 0, [total[:, k].copy()]


def _scales(blocks: Blocks, fits: list[LinearFit]) -> list[Scale]:
    """Each model's own centre and spread: weighted, as the estimators have them inside, and plain for the penalty."""
    width, by_number = blocks.width, dict(enumerate(fits))
    every = LinearFit(0.0, 0)
    whole = blocks.summed(lambda held, own: _moments(held, own, {0: every}, np.zeros(width)), _added, task_bytes=32 * width)
    middle = whole[0, 0][0][:width] / sum(blocks.counts.values())
    found = blocks.summed(lambda held, own: _moments(held, own, by_number, middle), _added, task_bytes=32 * width * len(fits))
    out = []
    for m, fit in by_number.items():
        n0, n1 = (sum(n for (fold, y), n in blocks.counts.items() if y == c and fit.takes(np.array(fold))) for c in (0, 1))
        if not n0 or not n1:
            raise ValueError("a linear model needs rows of both classes")
        w0, w1 = fit.class_weights
        weight, squares = n0 * w0 + n1 * w1, n0 * w0 * w0 + n1 * w1 * w1
        (sums, sums_2), (plain, plain_2) = found[m, 0][0].reshape(2, 2, width)
        centre = sums / weight
        inside = np.maximum(sums_2 - weight * centre**2, 0.0)
        spread = np.sqrt(inside / max(weight - squares / weight, 1e-300))
        deviation = np.sqrt(np.maximum(plain_2 / (n0 + n1) - (plain / (n0 + n1)) ** 2, 0.0)) if fit.scaled else np.ones(width)
        spread = np.where(spread > CONSTANT * np.abs(middle + centre), spread, 0.0)
        inner = spread / np.where(deviation > 0, deviation, 1.0)
        penalty = np.where(spread > 0, fit.penalty / np.where(spread > 0, inner, 1.0) ** 2, 0.0)
        out.append(Scale(middle + centre, spread, penalty, weight, math.log(n1 * w1 / (n0 * w0))))
    return out


def fit_on(blocks: Blocks, fits: list[LinearFit]) -> list[Line]:
    scales = _scales(blocks, fits)
    running, points, ended = {}, {}, {}
    for m, (fit, scale) in enumerate(zip(fits, scales)):
        start = np.append(np.zeros(blocks.width), scale.odds)
        running[m] = descent(start, fit.steps)
        points[m] = next(running[m])
    while points:
        asked = {m: (fits[m], scales[m].line(point)) for m, point in points.items()}
        sums = blocks.summed(lambda held, own, a=asked: _sums(held, own, a), _added, task_bytes=8 * (blocks.width + 2) * len(asked))
        for m in list(points):
            try:
                points[m] = running[m].send(scales[m].objective(points[m], sums[m, 0][0]))
            except StopIteration as end:
                ended[m] = end.value
                del points[m]
    return [scales[m].line(ended[m]) for m in range(len(fits))]


def fit_side_by_side(rows: DataFrame, fits: list[LinearFit]) -> list[Line]:
    """Fit all models on ``rows`` (x array without missing values, y boolean, fold int)."""
    with packed(rows) as blocks:
        return fit_on(blocks, fits)


# --- out of fold --------------------------------------------------------------------------------


def leaving_out(fold: int) -> tuple[int, int, int]:
    """For ``LinearFit.without``: one fold, where the number is the fold."""
    return 1, 1 << 30, fold


def logistic_out_of_fold(
    trials: list[dict], rows: DataFrame, features: str, label: str, keep: list[str], weights: dict[int, tuple[float, float, float]], scaled: bool
) -> DataFrame:
    """``keep`` and ``scores``, one per trial: models of all trials and folds descend side by side, and score in one scan.

    ``weights``: by fold that is held out, the weights of the two classes and of all rows.
    """
    fits = [
        LinearFit(1.0 / (p["C"] * whole), p.get("max_iter", 1000), (w0, w1), scaled, (leaving_out(fold),))
        for p in trials
        for fold, (w0, w1, whole) in sorted(weights.items())
    ]
    found = iter(fit_side_by_side(as_rows(rows, features, label, F.col("fold")), fits))
    models = [{fold: next(found) for fold in sorted(weights)} for _ in trials]
    return rows.select(*keep, held_out_scores(models)(vector_to_array(features), "fold").alias("scores"))
