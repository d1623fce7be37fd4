"""Extremely random trees, the perceptron and the radial kernel against plain forms of the same."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cardwatch.learners import extra_trees, perceptron, raw_blocks
from cardwatch.learners.calibrated_svc import CalibratedSVC
from cardwatch.learners.extra_trees import ExtremelyRandomTrees, Plan, grow_side_by_side
from cardwatch.learners.kernel_map import RadialKernelMap, mapped, waves
from cardwatch.learners.perceptron import Net, PenalisedPerceptron, descend_side_by_side
from cardwatch.learners.zoo import LEARNERS
from cardwatch.plans import training
from cardwatch.schema import ID, LABEL

N = 300


def sample():
    pick = np.random.default_rng(3)
    x = np.column_stack([pick.integers(0, 2, N), pick.normal(size=N), pick.integers(0, 9, N), np.ones(N), pick.normal(size=N)]).astype(float)
    y = pick.random(N) < 1 / (1 + np.exp(-(x[:, 1] * 2 + x[:, 0] - (x[:, 2] > 5))))
    return x, y, pick.integers(0, 3, N)


def table(spark, x, y, fold, parts=3):
    rows = [(list(map(float, a)), bool(b), int(f)) for a, b, f in zip(x, y, fold)]
    return spark.createDataFrame(rows, "x array<double>, y boolean, fold int").repartition(parts)


# --- trees ---------------------------------------------------------------------------------------


def plain_tree(plan, number, x, y):
    """The same draws, node by node, on all rows at once: the share of class 1 each row comes to."""
    weights = np.where(y, plan.class_weights[1], plan.class_weights[0])
    out = np.zeros(len(x))
    level, made = [(0, np.arange(len(x)))], 1
    for depth in range(plan.depth + 1):
        below = []
        for node, rows in level:
            w1 = weights[rows][y[rows]].sum()
            out[rows] = w1 / weights[rows].sum()
            if depth == plan.depth or len(set(y[rows])) == 1:
                continue
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            order = np.argsort(extra_trees.uniform(plan.seed, number, np.array([node]), x.shape[1], 0)[0], kind="stable")
            share = extra_trees.uniform(plan.seed, number, np.array([node]), x.shape[1], 1)[0]
            looks = plan.looks_at or int(math.sqrt(x.shape[1]))
            seen = [f for f in order[:looks] if low[f] < high[f]] or [f for f in order if low[f] < high[f]][:1]
            best = None
            for f in seen:
                cut = low[f] + share[f] * (high[f] - low[f])
                left = x[rows, f] <= cut
                kept = 0.0
                for side in (rows[left], rows[~left]):
                    a, b = (weights[side][y[side] == c].sum() for c in (False, True))
                    kept += (a * a + b * b) / (a + b)
                if best is None or kept > best[0] + 1e-9:
                    best = (kept, rows[left], rows[~left])
            if best is not None:
                below += [(made, best[1]), (made + 1, best[2])]
                made += 2
        level = below
    return out


@pytest.mark.parametrize("block", [40, 1 << 14])
def test_forest_equals_plain_one(spark, monkeypatch, block):
    monkeypatch.setattr(raw_blocks, "BLOCK_ROWS", block)
    monkeypatch.setattr(extra_trees, "NODES_PER_PART", 3)
    monkeypatch.setattr(extra_trees, "NODES_AT_ONCE", 40)
    x, y, fold = sample()
    plans = [Plan(4, 5, 7, (1.0, 2.5), 0), Plan(3, 9, 8), Plan(2, 3, 9, (0.5, 1.5), 2, looks_at=5)]
    for plan, forest in zip(plans, grow_side_by_side(table(spark, x, y, fold), plans)):
        own = fold != plan.held_out if plan.held_out is not None else np.ones(N, bool)
        plain = sum(plain_tree(plan, m, x[own], y[own]) for m in range(plan.trees)) / plan.trees
        assert np.allclose(forest.probability(x[own]), plain, atol=1e-12)
        assert forest.gains[3] == 0 and max(forest.gains) > 0


def test_split_points_are_drawn_evenly():
    nodes = np.arange(4000)
    low, high = np.zeros((4000, 1)), np.full((4000, 1), 10.0)
    _, point = extra_trees.drawn(Plan(1, 1), 0, nodes, low, high)
    assert np.histogram(point, 10, (0, 10))[0].min() > 330
    other = extra_trees.drawn(Plan(1, 1, 43), 0, nodes, low, high)[1]
    assert abs(np.corrcoef(point[:, 0], other[:, 0])[0, 1]) < 0.06


def test_split_points_stay_below_the_largest_value():
    low = np.full((50, 2), 1.0)
    high = np.nextafter(low, 2.0)
    seen, point = extra_trees.drawn(Plan(1, 1, looks_at=2), 0, np.arange(50), low, high)
    assert (seen >= 0).all() and (point < 1.0 + 1e-15).all() and (point == 1.0).all()


def test_forest_does_not_depend_on_the_tasks(spark):
    x, y, fold = sample()
    plan = Plan(5, 6)
    one, two = (grow_side_by_side(table(spark, x[o], y[o], fold[o], parts), [plan])[0] for o, parts in ((np.arange(N), 1), (np.arange(N)[::-1], 7)))
    assert one.to_json() == two.to_json()


def test_constant_features_and_one_class(spark):
    flat = grow_side_by_side(table(spark, np.ones((6, 2)), [True, False] * 3, [0] * 6), [Plan(2, 4)])[0]
    assert flat.probability(np.ones((1, 2)))[0] == 0.5 and sum(flat.gains) == 0
    pure = grow_side_by_side(table(spark, np.arange(6.0)[:, None], [True] * 6, [0] * 6), [Plan(2, 4)])[0]
    assert pure.probability(np.ones((1, 1)))[0] == 1.0
    with pytest.raises(ValueError):
        grow_side_by_side(table(spark, np.ones((1, 1)), [True], [0]).limit(0), [Plan(1, 1)])


def labelled(spark, x, y):
    data = [(i, Vectors.dense(a), int(b), 1.0) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, [ID, "features", "label", "weight"])


@pytest.mark.parametrize("name", ["trees", "net"])
def test_stages_save_and_score(spark, tmp_path, name):
    x, y, _ = sample()
    df = labelled(spark, x, y)
    stage = {"trees": ExtremelyRandomTrees(trees=3, maxDepth=4), "net": PenalisedPerceptron(layers=[4, 3], maxIter=15)}[name]
    model = Pipeline(stages=[stage]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    pairs = [m.transform(df).select("probability", "prediction").collect() for m in (model, again)]
    assert pairs[0] == pairs[1] and all((r["probability"][1] > 0.5) == (r["prediction"] == 1) for r in pairs[0])
    assert model.transform(df.limit(0)).count() == 0


# --- perceptron ----------------------------------------------------------------------------------


def test_gradient_equals_differences():
    x, y, _ = sample()
    layers = perceptron.begun(Net((4, 3), seed=5), x.shape[1], x.mean(axis=0), np.full(x.shape[1], 2.0))
    found, _ = perceptron.gradient(layers, x, y.astype(float))
    flat, tiny = layers.flat(), 1e-6
    for i in range(0, len(flat), 5):
        losses = []
        for sign in (1, -1):
            moved = flat.copy()
            moved[i] += sign * tiny
            losses.append(perceptron.gradient(layers.replaced(moved), x, y.astype(float))[1])
        assert abs((losses[0] - losses[1]) / (2 * tiny) - found[i]) < 1e-4


@pytest.mark.parametrize("block", [40, 1 << 14])
def test_one_step_equals_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(raw_blocks, "BLOCK_ROWS", block)
    monkeypatch.setattr(raw_blocks, "MERGED_BY_DRIVER", 2)
    x, y, fold = sample()
    net = Net((4,), alpha=3.0, rate=0.1, steps=1, held_out=1)
    found = descend_side_by_side(table(spark, x, y, fold, 5), [net])[0]
    own = fold != 1
    start = perceptron.begun(net, x.shape[1], np.zeros(5), np.ones(5))
    (w1, w2), (b1, b2) = start.weights, start.biases
    hidden = np.maximum(x[own] @ w1 + b1, 0)
    error = 1 / (1 + np.exp(-(hidden @ w2 + b2)[:, 0])) - y[own]
    to_hidden = error[:, None] * w2.T * (hidden > 0)
    n = own.sum()
    grads = [(x[own].T @ to_hidden + 3 * w1) / n, (hidden.T @ error[:, None] + 3 * w2) / n, to_hidden.sum(0) / n, error.sum(keepdims=True) / n]
    # The first step of Adam goes by the sign of the gradient.
    for before, after, g in zip((w1, w2, b1, b2), (*found.layers.weights, *found.layers.biases), grads):
        assert np.allclose(after, before - 0.1 * g / (np.abs(g) + 1e-8 / math.sqrt(0.001)), atol=1e-9)


def test_penalty_and_rate_change_the_fit(spark):
    x, y, fold = sample()
    nets = [Net((6,), alpha=a, rate=r, steps=60) for a, r in ((0.0, 0.02), (300.0, 0.02), (0.0, 0.002))]
    plain, penalised, slow = descend_side_by_side(table(spark, x, y, fold), nets)
    size = lambda d: sum((w**2).sum() for w in d.layers.weights)
    assert size(penalised) < 0.7 * size(plain)
    assert plain.losses[-1] < slow.losses[-1] < slow.losses[0]


def test_fold_scales_equal_those_of_the_rows(spark):
    x, y, fold = sample()
    for held_out, (centre, deviation) in zip((0, 2), perceptron.scales_without(table(spark, x, y, fold), [0, 2])):
        own = x[fold != held_out]
        spread = own.std(axis=0)
        assert np.allclose(centre, own.mean(axis=0)) and np.allclose(deviation, np.where(spread > 0, spread, 1.0))


@pytest.mark.parametrize("name, params", [("ExtraTrees", {"n_estimators": 4, "max_depth": 4}), ("MLPClassifier", {"hidden_layer_sizes": [5], "alpha": 0.1, "max_iter": 12})])
def test_folds_at_once_equal_one_fold_at_a_time(spark, name, params):
    x, y, fold = sample()
    names = [f"f{i}" for i in range(5)]
    folded = spark.createDataFrame([(i, int(b), int(f), *map(float, a)) for i, (a, b, f) in enumerate(zip(x, y, fold))], [ID, LABEL, "fold", *names])
    learner = LEARNERS[name]
    together = {r[ID]: r["score"] for r in training.oof_predict(learner, params, folded, names).collect()}
    apart = {r[ID]: r["score"] for r in training.oof_predict(learner, params, folded, names, resample=lambda rows: rows).collect()}
    assert together.keys() == apart.keys() and len(together) == N
    assert max(abs(together[i] - apart[i]) for i in together) < 1e-8


# --- radial kernel -------------------------------------------------------------------------------


def test_cosines_stand_for_the_kernel():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(40, 6))
    z = mapped(x, *waves(6, 4096, 0.15, 42))
    exact = np.exp(-0.15 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_width_of_the_kernel_follows_the_variance(spark):
    x, y, _ = sample()
    model = RadialKernelMap(size=8).fit(labelled(spark, x, y))
    assert math.isclose(model.getOrDefault("gamma"), 1 / (5 * x.var()), rel_tol=1e-9)


def test_a_ring_needs_the_kernel(spark, tmp_path):
    pick = np.random.default_rng(2)
    x = pick.uniform(-2, 2, (240, 2))
    y = (x**2).sum(axis=1) < 1.6
    df = labelled(spark, x, y)

    def right(model):
        return model.transform(df).filter(F.col("prediction") == F.col("label")).count() / len(x)

    made = dict(regParam=1e-3, maxIter=40, folds=3)
    radial = CalibratedSVC(**made, waves=128).fit(df)
    assert right(radial) > 0.95 > 0.85 > right(CalibratedSVC(**made).fit(df))
    radial.write().overwrite().save(str(tmp_path / "svc"))
    assert right(PipelineModel.load(str(tmp_path / "svc"))) == right(radial)


@pytest.mark.parametrize("task_bytes, merged", [(None, True), (1 << 10, False), (1 << 24, True)])
def test_results_are_merged_by_as_many_tasks_as_run_at_a_time(task_bytes, merged):
    class Table:
        """Notes how it is dealt, whatever the session's number of shuffle partitions."""

        dealt = None
        sparkSession = type("S", (), {"sparkContext": type("C", (), {"defaultParallelism": 7})})

        def mapInArrow(self, *_):
            return self

        def repartition(self, *by):
            self.dealt = by
            return self

        def collect(self):
            return []

    table = Table()
    assert raw_blocks.Blocks(table, 3, {}, 30).summed(None, None, task_bytes=task_bytes) == {}
    assert table.dealt == ((7, "key", "part") if merged else None)
