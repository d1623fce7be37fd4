"""Features as small bin numbers: cut points from the data, and rows packed into blocks of bytes."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bin of a missing value; the others count from 1.
MISSING = 0
#: Rows of one block, about.
BLOCK_ROWS = 1 << 17
#: Most values that features counted together may have together.
JOINT_VALUES = 1024


def cut_points(rows: DataFrame, vector: str, most: int) -> list[list[float]]:
    """Per position of an array column the values at or below which a split may send rows to the left.

    Up to ``most`` quantiles that the data hold, without the largest value, so that no side of a split is empty. NaN is missing.
    """
    if not 1 <= most <= 254:
        raise ValueError("cut points must fit a byte next to the bin of missing values")
    first = rows.select(F.size(vector)).first()
    if first is None:
        raise ValueError("no rows to fit")
    names = [f"f{i}" for i in range(first[0])]
    wide = rows.select(*[F.nanvl(F.col(vector)[i].cast("double"), F.lit(None)).alias(n) for i, n in enumerate(names)])
    found = wide.approxQuantile(names, [i / most for i in range(most + 1)], 0.25 / most)
    highest = wide.agg(*[F.max(n) for n in names]).first()
    return [sorted({v for v in values if v < top}) for values, top in zip(found, highest, strict=True)]


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bins of a (rows, features) matrix, feature by feature."""
    out = np.empty((values.shape[1], values.shape[0]), np.uint8)
    for f, own in enumerate(cuts):
        column = values[:, f]
        out[f] = np.where(np.isnan(column), MISSING, 1 + np.searchsorted(np.asarray(own), column, "left"))
    return out


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A (rows, features) matrix of an array column; a null value is NaN."""
    return lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width).astype(float)


def rows_without_copies(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows whose bytes are not copied."""
    for i in range(batch.num_rows):
        cells = {name: column[i] for name, column in zip(batch.schema.names, batch.columns)}
        yield {name: c.as_buffer() if pa.types.is_binary(c.type) else c.as_py() for name, c in cells.items()}


class Layout:
    """Where each feature's bins lie when all features' bins stand in one row."""

    def __init__(self, cuts: list[list[float]]):
        sizes = np.array([len(c) + 2 for c in cuts])
        self.starts = np.append(0, np.cumsum(sizes))
        self.total = int(self.starts[-1])
        self.feature = np.repeat(np.arange(len(cuts)), sizes)
        self.bin = np.arange(self.total) - self.starts[self.feature]
        #: Where a split may be: not at the bin of missing values and not at a feature's last bin.
        self.splits = (self.bin != MISSING) & (self.bin != (sizes - 1)[self.feature])


@dataclass
class Joint:
    """Features that are counted together: ``codes`` number the joint values of each row, of which there are ``size``.

    ``bins`` says where the features' bins lie in the layout, and ``within`` (codes, bins) which of them a code holds. One feature
    alone has its bins as codes, and no ``within``.
    """

    codes: np.ndarray
    size: int
    bins: np.ndarray
    within: np.ndarray | None = None


def joined(bins: np.ndarray, layout: Layout, most: int | None = None) -> list[Joint]:
    """The features of (features, rows) bins in groups of few joint values: rows are counted once per group, not once per feature."""
    most = most or JOINT_VALUES
    groups: list[list] = []  # features, codes, bins of each code by feature
    for f in sorted(range(len(bins)), key=lambda f: layout.starts[f + 1] - layout.starts[f]):
        for group in groups:
            joint = group[1].astype(np.int64) * 256 + bins[f]
            there = np.zeros(len(group[2]) * 256, bool)
            there[joint] = True
            if there.sum() <= most:
                found = np.flatnonzero(there)
                numbers = np.cumsum(there) - 1
                group[0].append(f)
                group[1] = numbers[joint].astype(np.uint16)
                group[2] = np.column_stack([group[2][found // 256], found % 256])
                break
        else:
            groups.append([[f], bins[f], np.arange(256)[:, None]])
    return [_joint(*group, layout) for group in groups]


def alone(bins: np.ndarray, layout: Layout) -> list[Joint]:
    """Every feature by itself."""
    return [_joint([f], own, np.arange(256)[:, None], layout) for f, own in enumerate(bins)]


def packed_joints(joints: list[Joint]) -> bytes:
    """Without the codes of features that are alone: they are their bins."""
    return pickle.dumps([(j.codes if j.within is not None else None, j.size, j.bins, None if j.within is None else j.within.astype(bool)) for j in joints])


def unpacked_joints(raw, bins: np.ndarray, layout: Layout) -> list[Joint]:
    own = lambda places: bins[layout.feature[places[0]]]
    return [
        Joint(own(places) if codes is None else codes, size, places, None if within is None else within.astype(float))
        for codes, size, places, within in pickle.loads(raw)
    ]


def _joint(features: list[int], codes: np.ndarray, kinds: np.ndarray, layout: Layout) -> Joint:
    if len(features) == 1:
        first, end = layout.starts[features[0]], layout.starts[features[0] + 1]
        return Joint(codes, int(end - first), np.arange(first, end))
    places = [np.arange(layout.starts[f], layout.starts[f + 1]) for f in features]
    within = np.concatenate([kinds[:, k, None] == np.arange(len(p)) for k, p in enumerate(places)], axis=1)
    return Joint(codes, len(kinds), np.concatenate(places), within.astype(float))


def picked(values: tuple, at: np.ndarray) -> tuple:
    """What some rows add."""
    return tuple(None if v is None else v[at] for v in values)


def sums_by_bin(
    joints: list[Joint], at: np.ndarray | None, slot: np.ndarray | None, n_slots: int, values: tuple, layout: Layout
) -> np.ndarray:
    """(slots, bins, values): per slot and bin the sums of each value over the rows ``at``, which are in ``slot``; a value of None is 1.

    ``values`` are those of ``at``. Without ``at`` all rows are in slot 0.
    """
    total = np.zeros((n_slots, layout.total, len(values)))
    for joint in joints:
        key = joint.codes if at is None else joint.codes[at]
        key = key.astype(np.intp) if n_slots == 1 else slot * joint.size + key
        for k, v in enumerate(values):
            found = np.bincount(key, v, n_slots * joint.size).reshape(n_slots, -1)
            total[:, joint.bins, k] = found if joint.within is None else found @ joint.within
    return total


def blocks(rows: DataFrame, cuts: list[list[float]], n_rows: int) -> DataFrame:
    """``n_rows`` rows (x array, y boolean, fold int, weight double; no weights if all are 1), dealt evenly into blocks: n, a name (32 characters for all and 32 for each), and the rest as bytes."""
    run, layout = uuid.uuid4().hex, Layout(cuts)
    names = ["n", "name", "bins", "y", "fold", "weight", "joints"]

    def packed(part: pa.Table) -> pa.RecordBatch:
        own = binned(matrix(part.column("x").combine_chunks(), len(cuts)), cuts)
        rest = [part.column(c).to_numpy().astype(t) for c, t in (("y", np.uint8), ("fold", np.int32), ("weight", float))]
        if (rest[2] == 1).all():
            rest[2] = rest[2][:0]
        columns = [pa.array([part.num_rows], pa.int32()), pa.array([run + uuid.uuid4().hex])]
        columns += [pa.array([c.tobytes()], pa.binary()) for c in (own, *rest)]
        columns.append(pa.array([packed_joints(joined(own, layout))], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if held and sum(b.num_rows for b in held) + batch.num_rows > 2 * BLOCK_ROWS:
                yield packed(pa.Table.from_batches(held))
                held = []
            held.append(batch)
        if sum(b.num_rows for b in held):
            yield packed(pa.Table.from_batches(held))

    dealt = rows.select("x", "y", F.col("fold").cast("int").alias("fold"), F.col("weight").cast("double").alias("weight"))
    dealt = dealt.repartition(max(1, -(-n_rows // BLOCK_ROWS)))
    return dealt.mapInArrow(pack, "n int, name string, bins binary, y binary, fold binary, weight binary, joints binary")
