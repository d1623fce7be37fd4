"""Exact k-nearest-neighbour join and the classifier on top of it.

Rows are grouped around pivots. A query row first searches its own cell, which bounds how far its
k-th neighbour can be; then it visits only the cells that can hold anything nearer. Big cells are
cut into blocks, and a task searches one block of neighbours for one block of queries, keeping k
per query. Nothing is dropped: a cell is skipped only when the triangle inequality, or the box around its rows, rules it out.
Within a block the rows are cut again into small leaves with boxes, which are skipped in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.schema import ID
from cardwatch.session import settle

# Squared distances are compared at this many digits; equal ones go to the lower neighbour id.
DIGITS = 9
_SLACK = 1e-6

MOST_PIVOTS = 4096
ROWS_PER_PIVOT = 2_000

#: Rows of a leaf of the search inside one block.
LEAF_ROWS = 256
#: Distances that are held at a time; what a worker needs does not depend on batches, cells or blocks.
HELD = 1 << 20
#: Pairs of a query and a cell that leave a worker at a time.
VISITS = 1 << 15

_FOUND = f"{ID} long, neighbor_id long, d2 double, neighbor_label double"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


def _near_boxes(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from each row to each box, 0 inside."""
    total = np.zeros((len(x), len(low)))
    for start in range(0, len(x), 256):
        part = slice(start, start + 256)
        for column, under, over in zip(x[part].T, low.T, high.T):
            beyond = np.maximum(under[None, :] - column[:, None], column[:, None] - over[None, :])
            np.maximum(beyond, 0.0, out=beyond)
            beyond *= beyond
            total[part] += beyond
    return total


def _with_room(d2: np.ndarray) -> np.ndarray:
    """A bound below which everything is kept that may round to ``d2``."""
    return d2 + 1e-8 * (1.0 + d2)


def _leaves(points: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the points, halved along the widest column until leaves are small. Of equal points the k lowest ids are enough."""
    found, held = [], [np.arange(len(points))]
    while held:
        at = held.pop()
        if len(at) <= LEAF_ROWS:
            found.append(at)
            continue
        own = points[at]
        widest = np.ptp(own, axis=0).argmax()
        column = own[:, widest]
        low, high = column.min(), column.max()
        if low == high:
            found.append(at[np.argsort(ids[at], kind="stable")[:k]])
            continue
        middle = np.partition(column, len(at) // 2)[len(at) // 2]
        left = column < middle if middle > low else column <= low
        held += [at[left], at[~left]]
    return found


def _nearest(x: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``points``, squared distances) of the k nearest points of each row, nearest first, ties by lower id.

    Each row looks into the leaf it is nearest to, then into those whose box is not farther away than its k-th point so far.
    """
    k = min(k, len(points))
    if not k or len(x) < 16 or len(points) <= 2 * LEAF_ROWS:
        return _nearest_of_all(x, points, ids, k)
    leaves = _leaves(points, ids, k)
    low, high = (np.stack([f(points[at], axis=0) for at in leaves]) for f in (np.min, np.max))
    step = max(1, HELD // len(leaves))
    parts = [_nearest_by_leaves(x[i : i + step], points, ids, k, leaves, low, high) for i in range(0, len(x), step)]
    return tuple(np.concatenate(p) for p in zip(*parts))


def _nearest_by_leaves(
    x: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, leaves: list[np.ndarray], low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    best, distances = np.zeros((len(x), k), np.int64), np.full((len(x), k), np.inf)

    def look(rows: np.ndarray, leaf: int) -> None:
        at = leaves[leaf]
        near, d2 = _nearest_of_all(x[rows], points[at], ids[at], k)
        near, d2 = np.hstack([best[rows], at[near]]), np.hstack([distances[rows], d2])
        order = np.lexsort((ids[near], d2), axis=1)[:, :k]
        best[rows], distances[rows] = np.take_along_axis(near, order, 1), np.take_along_axis(d2, order, 1)

    away = _near_boxes(x, low, high)
    home = away.argmin(1)
    for leaf in np.unique(home):
        look(np.flatnonzero(home == leaf), leaf)
    for leaf, at in enumerate(leaves):
        rows = np.flatnonzero((away[:, leaf] <= _with_room(distances[:, -1])) & (home != leaf))
        rows = rows[_may_hold(x[rows], points[at], distances[rows, -1])]
        if len(rows):
            look(rows, leaf)
    return best, distances


def _may_hold(x: np.ndarray, points: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Whether any of a leaf's points may be as near to a row as its limit."""
    middle = points.mean(0)
    own, moved = x - middle, points - middle
    own2, moved2 = (own * own).sum(1), (moved * moved).sum(1)
    # Only the part of the squared distances that differs between points, in one product.
    least = np.concatenate(
        [(own[i : i + HELD // len(points)] @ (-2.0 * moved.T) + moved2).min(1) for i in range(0, len(x), HELD // len(points))] or [own2]
    )
    return least + own2 <= _with_room(limits) + _SLACK * (1.0 + moved2.max() + own2)


def _nearest_of_all(x: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_nearest``, by comparing each row with each point."""
    k = min(k, len(points))
    wide = min(len(points), k + 8)
    step = max(256, HELD // max(1, len(points)))
    places, distances = [np.zeros((0, k), np.int64)], [np.zeros((0, k))]
    # Around their middle the numbers are smaller, and so is what the fast formula rounds off.
    middle = points.mean(0) if len(points) else 0.0
    moved = points - middle
    scale = float((moved * moved).sum(1).max()) if len(points) else 0.0
    for start in range(0, len(x), step):
        part = x[start : start + step]
        own = part - middle
        rough = _squared(own, moved)
        # The fast formula only preselects; a few more than k take up its rounding errors.
        near = np.argpartition(rough, wide - 1, axis=1)[:, :wide]
        exact = np.round(((points[near] - part[:, None, :]) ** 2).sum(2), DIGITS)
        order = np.lexsort((ids[near], exact), axis=1)
        near, exact = np.take_along_axis(near, order, 1), np.take_along_axis(exact, order, 1)
        if wide < len(points):
            # Where the last preselected one is as near as the k-th, points of equal distance may have been left out.
            slack = _SLACK * (1.0 + scale + (own * own).sum(1))
            for i in np.flatnonzero(exact[:, -1] <= exact[:, k - 1] + slack):
                every = np.flatnonzero(rough[i] <= exact[i, k - 1] + slack[i])
                d2 = np.round(((points[every] - part[i]) ** 2).sum(1), DIGITS)
                best = np.lexsort((ids[every], d2))[:k]
                near[i, :k], exact[i, :k] = every[best], d2[best]
        places.append(near[:, :k])
        distances.append(exact[:, :k])
    return np.concatenate(places), np.concatenate(distances)


def _nearest_in_block(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of one block for each query of one block."""
    if not len(queries) or not len(block):
        return pd.DataFrame({ID: [], "neighbor_id": [], "d2": [], "neighbor_label": []})
    ids = block["id"].to_numpy()
    places, d2 = _nearest(_matrix(queries["x"]), _matrix(block["x"]), ids, k)
    return pd.DataFrame(
        {
            ID: np.repeat(queries["id"].to_numpy(), places.shape[1]),
            "neighbor_id": ids[places].ravel(),
            "d2": d2.ravel(),
            "neighbor_label": block["label"].to_numpy()[places].ravel(),
        }
    )


def _lookup(numbers: dict[int, float], key: str, kind: str, missing: float) -> Column:
    if not numbers:
        return F.lit(missing).cast(kind)
    pairs = F.map_from_arrays(F.lit(list(numbers)), F.lit([float(v) for v in numbers.values()]))
    return F.coalesce(F.try_element_at(pairs, F.col(key)), F.lit(float(missing))).cast(kind)


def _slices(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """The rows in slices that may be held against ``width`` others."""
    step = max(1, HELD // max(1, width))
    for batch in batches:
        for start in range(0, len(batch), step):
            yield batch.iloc[start : start + step]


def _with_cells(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(batches, len(pivots)):
            d2 = _squared(_matrix(part["x"]), pivots)
            cell = d2.argmin(1)
            yield part.assign(cell=cell.astype("int32"), radius=np.sqrt(d2[np.arange(len(part)), cell]))

    return df.mapInPandas(assign, f"{df.schema.simpleString()[7:-1]}, cell: int, radius: double")


def _search(visits: DataFrame, train: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The k nearest trained rows of each visited (query, cell) pair's blocks."""
    t_counts = {r["cell"]: r["n"] for r in train.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    q_counts = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    t_parts = {c: math.ceil(n / block_rows) for c, n in t_counts.items()}
    q_parts = {c: math.ceil(n / block_rows) for c, n in q_counts.items()}

    def spread(df: DataFrame, own: str, own_parts: dict, other: str, other_parts: dict) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), _lookup(own_parts, "cell", "long", 1))
        others = F.sequence(F.lit(0).cast("long"), _lookup(other_parts, "cell", "long", 1) - 1)
        return df.withColumn(own, mine).withColumn(other, F.explode(others))

    keys = ["cell", "q_part", "t_part"]
    queries = spread(visits.select("id", "x", "cell"), "q_part", q_parts, "t_part", t_parts)
    blocks = spread(train.select("id", "x", "label", "cell"), "t_part", t_parts, "q_part", q_parts)
    return queries.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(
        lambda q, t: _nearest_in_block(q, t, k), _FOUND
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy(ID).orderBy("d2", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_neighbors(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    *,
    features: str = "features",
    label: str = "label",
    pivots: int | None = None,
    block_rows: int = 20_000,
) -> DataFrame:
    """(id, rank, neighbor_id, d2, neighbor_label): the k nearest trained rows of every query row.

    ``pivots`` bounds everything the driver holds: that many points, counts, radii and boxes. By default
    it follows the size of the trained table, up to ``MOST_PIVOTS``.
    """
    x = vector_to_array(features)
    learned = train.select(F.col(ID).alias("id"), x.alias("x"), F.col(label).cast("double").alias("label"))
    asked = queries.select(F.col(ID).alias("id"), x.alias("x"))

    if pivots is None:
        pivots = max(1, min(MOST_PIVOTS, learned.count() // ROWS_PER_PIVOT))
    drawn = learned.orderBy(F.md5(F.concat(F.lit("pivot:"), F.col("id").cast("string"))), "id").limit(pivots)
    points = np.array([r["x"] for r in drawn.select("x").collect()], dtype=float)
    if not len(points):
        raise ValueError("no rows to search")

    placed = settle(_with_cells(learned, points))
    homes = settle(_with_cells(asked, points))
    ends = [f(F.col("x")[i]) for f in (F.min, F.max) for i in range(points.shape[1])]
    edges = [F.array(*e).alias(n) for n, e in (("low", ends[: points.shape[1]]), ("high", ends[points.shape[1] :]))]
    cells = placed.groupBy("cell").agg(F.max("radius").alias("radius"), *edges).orderBy("cell").collect()
    known = np.array([r["cell"] for r in cells], dtype="int32")
    reachable, low, high = (np.array([r[n] for r in cells], dtype=float) for n in ("radius", "low", "high"))

    at_home = settle(_search(homes, placed, k, block_rows))
    reach = _best(at_home, k).groupBy(ID).agg(F.max("d2").alias("d2"), F.count(F.lit(1)).alias("n"))
    # As many rows on both sides: a table that grows with the queries does not go through the driver.
    bounded = homes.join(reach.withColumnRenamed(ID, "id").hint("merge"), "id", "left").withColumn(
        "limit", F.when(F.col("n") >= k, F.sqrt("d2")).otherwise(F.lit(float("inf")))
    )

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(batches, len(known)):
            x, limit = _matrix(part["x"]), part["limit"].to_numpy()
            to_pivot = np.sqrt(_squared(x, points[known]))
            # Distances carry a little rounding, so a cell is ruled out only with room to spare.
            room = 1e-4 * (1.0 + to_pivot + reachable[None, :])
            needed = to_pivot - reachable[None, :] <= limit[:, None] + room
            needed &= known[None, :] != part["cell"].to_numpy()[:, None]
            rows, columns = np.nonzero(needed)
            for start in range(0, len(rows), VISITS):
                row, column = rows[start : start + VISITS], columns[start : start + VISITS]
                outside = np.maximum(np.maximum(low[column] - x[row], x[row] - high[column]), 0.0)
                near = (outside * outside).sum(1) <= _with_room(limit[row] ** 2)
                row, column = row[near], column[near]
                yield pd.DataFrame({"id": part["id"].to_numpy()[row], "x": part["x"].to_numpy()[row], "cell": known[column]})

    away = settle(
        bounded.select("id", "x", "cell", "limit").mapInPandas(visit, "id long, x array<double>, cell int")
    )
    return _best(at_home.unionByName(_search(away, placed, k, block_rows)), k)


def vote(neighbors: DataFrame, weights: str) -> DataFrame:
    """Share of positive neighbours: plain, or by inverse distance, where exact hits decide alone."""
    distance = F.sqrt("d2")
    if weights == "uniform":
        share = F.avg("neighbor_label")
    else:
        hits = F.count_if(F.col("d2") == 0)
        hit_label = F.avg(F.when(F.col("d2") == 0, F.col("neighbor_label")))
        weight = F.when(F.col("d2") > 0, F.lit(1.0) / distance).otherwise(0.0)
        share = F.when(hits > 0, hit_label).otherwise(
            F.try_divide(F.sum(weight * F.col("neighbor_label")), F.sum(weight))
        )
    return neighbors.groupBy(ID).agg(share.alias("score"))


class _Neighbours(HasFeaturesCol, HasLabelCol):
    k = Param(Params._dummy(), "k", "neighbours that vote", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)
    maxTrainRows = Param(
        Params._dummy(), "maxTrainRows", "most labelled rows the model keeps; 0 keeps all", TypeConverters.toInt
    )


class NearestNeighbors(Estimator, _Neighbours):
    """k nearest neighbours. With ``maxTrainRows`` the model is that many labelled rows, drawn per class by a seeded hash of
    the id, and scoring is one pass over the queries, linear in their number. With 0 all rows stay, and scoring is the exact join.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", k=5, weights="uniform", maxTrainRows=0):
        super().__init__()
        self._setDefault(maxTrainRows=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NearestNeighborsModel:
        kept = dataset.select(ID, self.getFeaturesCol(), self.getLabelCol())
        most = self.getOrDefault(self.maxTrainRows)
        if most:
            kept = drawn_per_class(kept, self.getLabelCol(), most)
        model = NearestNeighborsModel(settle(kept))
        return self._copyValues(model)


def drawn_per_class(rows: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` rows, each class in its share, those whose seeded hash of the id is smallest."""
    sizes = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    total = sum(sizes.values())
    if total <= most:
        return rows
    key = F.md5(F.concat(F.lit("neighbour:"), F.col(ID).cast("string")))
    parts = [
        rows.filter(F.col(label) == c).orderBy(key, ID).limit(max(1, most * n // total)) for c, n in sorted(sizes.items())
    ]
    return reduce(DataFrame.unionAll, parts)


def _shares(d2: np.ndarray, labels: np.ndarray, weights: str) -> np.ndarray:
    """``vote`` for rows of neighbours."""
    if weights == "uniform":
        return labels.mean(1)
    hit = d2 == 0
    weight = np.where(hit.any(1)[:, None], hit, 1.0 / np.sqrt(np.where(hit, 1.0, d2)))
    return (weight * labels).sum(1) / weight.sum(1)


class _ModelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:  # noqa: N802
        super().saveImpl(path)
        self.instance.train.write.parquet(f"{path}/rows")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str) -> NearestNeighborsModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NearestNeighborsModel(self.sparkSession.read.parquet(f"{path}/rows"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class NearestNeighborsModel(Model, _Neighbours, MLWritable, MLReadable):
    """The rows it was fitted on, as a table in the shared folder or where it was saved."""

    def __init__(self, train: DataFrame):
        super().__init__()
        self._setDefault(maxTrainRows=0)
        self.train = train

    def write(self) -> _ModelWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> _ModelReader:
        return _ModelReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score = self._scored_in_place if self.getOrDefault(self.maxTrainRows) else self._scored_by_join
        return (
            score(dataset)
            .withColumns(
                {
                    "probability": array_to_vector(F.array(F.lit(1.0) - F.col("__share"), F.col("__share"))),
                    "prediction": F.when(F.col("__share") > 0.5, 1.0).otherwise(0.0),
                }
            )
            .drop("__share")
        )

    def _scored_by_join(self, dataset: DataFrame) -> DataFrame:
        # Rows are searched by a number of their own: ids may repeat or be missing.
        rows = settle(dataset.withColumn("__row", F.monotonically_increasing_id()))
        asked = rows.select(F.col("__row").alias(ID), self.getFeaturesCol())
        found = nearest_neighbors(
            asked, self.train, self.getOrDefault(self.k), features=self.getFeaturesCol(), label=self.getLabelCol()
        )
        shares = vote(found, self.getOrDefault(self.weights)).select(F.col(ID).alias("__row"), F.col("score").alias("__share"))
        return rows.join(shares.hint("merge"), "__row").drop("__row")

    def _scored_in_place(self, dataset: DataFrame) -> DataFrame:
        """``maxTrainRows`` bounds what is collected and sent to every executor."""
        k, weights = self.getOrDefault(self.k), self.getOrDefault(self.weights)
        columns = [F.col(ID), vector_to_array(self.getFeaturesCol()), F.col(self.getLabelCol()).cast("double")]
        rows = self.train.select(*columns).orderBy(ID).collect()
        points, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
        held = dataset.sparkSession.sparkContext.broadcast((points, ids, np.array([r[2] for r in rows])))

        @F.pandas_udf("double")
        def share(x: pd.Series) -> pd.Series:
            points, ids, labels = held.value
            if not len(x):
                return pd.Series([], dtype=float)
            places, d2 = _nearest(_matrix(x), points, ids, k)
            return pd.Series(_shares(d2, labels[places], weights))

        return dataset.withColumn("__share", share(vector_to_array(self.getFeaturesCol())))
