"""The boosters against plain recursive ones, and what tells the presets apart."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cardwatch.learners import binning, boosting
from cardwatch.learners.binning import binned, cut_points
from cardwatch.learners.boosting import Fit, HistogramBooster, HistogramBoosterModel, fit_side_by_side
from cardwatch.learners.trees import Growth

N = 400


def sample(missing=True):
    pick = np.random.default_rng(4)
    x = np.column_stack([pick.integers(0, 6, N), pick.normal(size=N).round(1), pick.integers(0, 2, N), pick.integers(0, 30, N)]).astype(float)
    odds = x[:, 1] + (x[:, 0] > 3) * x[:, 2] * 2 - 1 + (x[:, 3] > 20) * (1 - x[:, 2])
    if missing:
        x[pick.random(N) < 0.1, 1] = np.nan
        odds = odds + np.isnan(x[:, 1]) * 2
    y = pick.random(N) < 1 / (1 + np.exp(-odds))
    return x, y, pick.integers(0, 3, N)


def table(spark, x, y, fold, parts=3):
    rows = [(list(map(float, a)), bool(b), int(f), 1.0) for a, b, f in zip(x, y, fold)]
    return spark.createDataFrame(rows, "x array<double>, y boolean, fold int, weight double").repartition(parts)


# --- a plain booster over the values themselves ------------------------------------------------------


def gain_of(g, h, n, growth):
    below = n if growth.gain == "squares" else h + growth.penalty
    return g * g / below if below > 0 else 0.0


def sides(values, cut, missing_left):
    low = values <= cut
    return low | np.isnan(values) if missing_left else low


def plain_best(x, rows_of, g, h, n, cuts, growth):
    """(gain, feature, cut, missing_left) for nodes that share a split."""
    best = None
    for f, own in enumerate(cuts):
        for cut in own:
            for missing_left in (True,) if growth.missing_low else (True, False):
                total, bad = 0.0, False
                for rows in rows_of:
                    low = rows[sides(x[rows, f], cut, missing_left)]
                    high = np.setdiff1d(rows, low)
                    few = min(n[low].sum(), n[high].sum()) < growth.least_rows or min(h[low].sum(), h[high].sum()) < growth.least_hessian
                    if not len(low) or not len(high) or few:
                        bad = True
                        continue
                    total += sum(gain_of(g[r].sum(), h[r].sum(), n[r].sum(), growth) for r in (low, high))
                    total -= gain_of(g[rows].sum(), h[rows].sum(), n[rows].sum(), growth)
                if bad and (growth.kind != "symmetric" or total == 0):
                    continue
                if total > 1e-9 and (best is None or total > best[0] * (1 + 1e-9)):
                    best = (total, f, cut, missing_left)
    return best


def plain_tree(x, g, h, n, cuts, growth):
    """Rows of each leaf."""
    leaves = [(np.arange(len(x)), 0)]
    divide = lambda rows, s: (rows[sides(x[rows, s[1]], *s[2:])], rows[~sides(x[rows, s[1]], *s[2:])])
    if growth.kind == "symmetric":
        level = [leaves[0][0]]
        for _ in range(growth.depth):
            split = plain_best(x, [r for r in level if len(r)], g, h, n, cuts, growth)
            if split is None:
                break
            level = [part for rows in level for part in divide(rows, split)]
        return level
    done, most = [], growth.leaves if growth.kind == "leaf" else 10**9
    open_ = [(plain_best(x, [r], g, h, n, cuts, growth), r, d) for r, d in leaves]
    while open_:
        at = max(range(len(open_)), key=lambda i: (open_[i][0][0] if open_[i][0] and open_[i][2] < growth.depth else -1, -i))
        split, rows, depth = open_.pop(at)
        if split is None or depth >= growth.depth or len(done) + len(open_) + 1 >= most:
            done.append(rows)
            continue
        open_ += [(plain_best(x, [part], g, h, n, cuts, growth), part, depth + 1) for part in divide(rows, split)]
    return done


def plain_boost(x, y, keep, fit, cuts):
    weight = np.where(y, fit.class_weights[1], fit.class_weights[0])
    own = np.flatnonzero(keep)
    start = math.log(weight[own][y[own]].sum() / weight[own][~y[own]].sum()) if fit.from_odds else 0.0
    score = np.full(len(own), start)
    for _ in range(fit.rounds):
        p = 1 / (1 + np.exp(-score))
        w = weight[own]
        g, h = w * (p - y[own]), w * p * (1 - p)
        n = w if fit.growth.gain == "squares" else np.ones(len(own))
        for rows in plain_tree(x[own], g, h, n, cuts, fit.growth):
            if len(rows):
                score[rows] += -fit.rate * g[rows].sum() / (h[rows].sum() + fit.growth.penalty)
    return own, score


GROWTHS = {
    "gradient_boosting": Growth(kind="level", gain="squares", depth=3),
    "xgboost": Growth(kind="level", gain="newton", depth=4, penalty=1.0, least_hessian=1.0),
    "lightgbm": Growth(kind="leaf", gain="newton", depth=2**30, leaves=9, least_rows=10, least_hessian=1e-3),
    "shallow_leaves": Growth(kind="leaf", gain="newton", depth=3, leaves=6, least_rows=5),
    "catboost": Growth(kind="symmetric", gain="newton", depth=3, penalty=3.0, missing_low=True),
}


@pytest.mark.parametrize("block", [60, 1 << 16])
@pytest.mark.parametrize("name", GROWTHS)
def test_booster_equals_plain_one(spark, monkeypatch, name, block):
    monkeypatch.setattr(binning, "BLOCK_ROWS", block)
    monkeypatch.setattr(boosting, "EVERY", 2)
    monkeypatch.setattr(boosting, "ADDED_BY_DRIVER", 2)
    x, y, fold = sample()
    rows = table(spark, x, y, fold)
    cuts = cut_points(rows, "x", 16)
    growth = GROWTHS[name]
    fits = [Fit(growth, 5, 0.3, (1.0, 2.5), 0, name != "catboost"), Fit(growth, 3, 0.5, (1.0, 1.0), None, True), Fit(growth, 4, 0.2, (0.5, 1.5), 2, False)]
    for fit, found in zip(fits, fit_side_by_side(rows, fits, cuts=cuts)):
        own, score = plain_boost(x, y, fold != (fit.held_out if fit.held_out is not None else -1), fit, cuts)
        assert len(found.trees) == fit.rounds
        assert np.allclose(found.margin(x)[own], score, rtol=0, atol=1e-9)


@pytest.mark.parametrize("name", GROWTHS)
def test_one_task_per_model_equals_many(spark, monkeypatch, name):
    """A model grown by one task that holds all blocks, in one job, is the one that is grown from the sums of many tasks."""
    monkeypatch.setattr(binning, "BLOCK_ROWS", 90)
    monkeypatch.setattr(binning, "JOINT_VALUES", 40)
    x, y, fold = sample()
    rows = table(spark, x, y, fold)
    cuts = cut_points(rows, "x", 16)
    growth = GROWTHS[name]
    fits = [Fit(growth, 5, 0.3, (1.0, 2.5), 0, name != "catboost"), Fit(growth, 3, 0.5, (1.0, 1.0), None, True)]
    whole = fit_side_by_side(rows, fits, cuts=cuts)
    monkeypatch.setattr(boosting, "WHOLE", 0)
    many = fit_side_by_side(rows, fits, cuts=cuts)
    for one, other in zip(whole, many):
        assert len(one.trees) == len(other.trees) and np.allclose(one.gains, other.gains)
        assert np.allclose(one.margin(x), other.margin(x), rtol=0, atol=1e-9)
    own, score = plain_boost(x, y, fold != 0, fits[0], cuts)
    assert np.allclose(many[0].margin(x)[own], score, rtol=0, atol=1e-9)


def test_small_tables_need_no_job_per_round(spark, monkeypatch):
    """Blocks that disagree, where every round took a job per level."""
    monkeypatch.setattr(binning, "BLOCK_ROWS", 60)
    x, y, fold = sample()
    rows = table(spark, x, y, fold)
    group = "boosting-jobs"
    spark.sparkContext.setJobGroup(group, "jobs of one fit")
    try:
        fit_side_by_side(rows, [Fit(GROWTHS["xgboost"], 30, 0.3), Fit(GROWTHS["catboost"], 30, 0.3, held_out=1)])
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_joint_sums_are_those_of_single_features():
    rng = np.random.default_rng(8)
    bins = np.concatenate([rng.integers(0, 3, (6, 2000)), rng.integers(0, 60, (2, 2000))]).astype(np.uint8)
    bins[5] = bins[4]
    layout = binning.Layout([[0.0]] * 6 + [list(map(float, range(59)))] * 2)
    joints = binning.joined(bins, layout, 300)
    assert len(joints) < 6 and sorted(np.concatenate([j.bins for j in joints])) == list(range(layout.total))
    again = binning.unpacked_joints(binning.packed_joints(joints), bins, layout)
    at, value = np.flatnonzero(rng.random(2000) < 0.6), rng.normal(size=2000)
    slot = rng.integers(0, 3, len(at))
    single, *other = (binning.sums_by_bin(j, at, slot, 3, (value[at], None), layout) for j in (binning.alone(bins, layout), joints, again))
    for found in other:
        assert np.allclose(found, single) and np.array_equal(found[..., 1], single[..., 1])


def test_presets_grow_different_trees(spark):
    x, y, fold = sample(missing=False)
    rows = table(spark, x, y, fold)
    fits = [boosting.class_weighted({"learning_rate": 0.3, "n_estimators": 2, "max_depth": 6}, p) for p in boosting.PRESETS]
    found = dict(zip(boosting.PRESETS, fit_side_by_side(rows, fits)))
    bins = binned(x, found["xgboost"].cuts)
    leaves = {p: len(set(e.trees[0].nodes(bins))) for p, e in found.items()}
    tree = found["catboost"].trees[0]
    assert len(tree.leaf_values) == 2 ** len(tree.cuts) == 64
    assert leaves["lightgbm"] <= 31 and max(leaves.values()) <= 64
    scores = {p: tuple(e.margin(x).round(9)) for p, e in found.items()}
    assert len(set(scores.values())) == len(scores)


def test_blocks_that_agree_save_jobs(spark, monkeypatch):
    """Blocks with the same rows grow the same trees, so that one job per round is enough; the trees are those of one block."""
    monkeypatch.setattr(binning, "BLOCK_ROWS", N // 4)
    x, y, _ = sample()
    four = table(spark, np.tile(x, (4, 1)), np.tile(y, 4), np.zeros(4 * N))
    fits = [Fit(GROWTHS[name], 2, 0.3) for name in ("xgboost", "catboost")]
    jobs, grow = [], boosting._Scored.grow
    monkeypatch.setattr(boosting._Scored, "grow", lambda self, *a, ahead: jobs.append(ahead) or grow(self, *a, ahead=ahead))
    found = fit_side_by_side(four, fits)
    assert jobs.count(True) == 2 and jobs.count(False) <= 2 * max(f.growth.depth for f in fits)
    for fit, ensemble in zip(fits, found):
        own, score = plain_boost(np.tile(x, (4, 1)), np.tile(y, 4), np.ones(4 * N, bool), fit, ensemble.cuts)
        assert np.allclose(ensemble.margin(x), score[:N], atol=1e-9)


def test_missing_values_have_a_side(spark):
    x = np.array([[np.nan], [np.nan], [1.0], [1.0], [2.0], [2.0]] * 20)
    y = np.array([True, True, False, False, True, True] * 20)
    rows = table(spark, x, y, np.zeros(len(x)))
    fit = Fit(Growth(depth=1, penalty=1.0), 1, 1.0)
    found = fit_side_by_side(rows, [fit])[0]
    assert not found.trees[0].missing_left[0] and found.margin(x)[0] == found.margin(x)[4] > found.margin(x)[2]
    low = fit_side_by_side(rows, [Fit(Growth(depth=1, missing_low=True), 1, 1.0)])[0]
    assert low.margin(x)[0] == low.margin(x)[2]


def test_stage_saves_and_scores(spark, tmp_path):
    x, y, fold = sample(missing=False)
    data = [(Vectors.dense(a), int(b), 1.0 + int(f)) for a, b, f in zip(x, y, fold)]
    df = spark.createDataFrame(data, ["features", "label", "w"])
    model = HistogramBooster(weightCol="w", rounds=4, learningRate=0.3, maxDepth=2, preset="xgboost").fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = HistogramBoosterModel.load(str(tmp_path / "m"))
    pairs = [
        m.transform(df).select("probability", "prediction").collect() for m in (model, again)
    ]
    assert pairs[0] == pairs[1]
    assert all((r["probability"][1] > 0.5) == (r["prediction"] == 1) for r in pairs[0])
    assert abs(sum(model.importances(4)) - 1) < 1e-9 and max(model.importances(4)) < 1
    assert again.transform(df.limit(0)).count() == 0


def test_weights_count_as_rows(spark):
    x, y, fold = sample(missing=False)
    once = table(spark, x, y, fold).withColumn("weight", F.col("fold") + 1.0)
    twice = table(spark, *(np.repeat(v, fold + 1, axis=0) for v in (x, y, fold)))
    cuts = cut_points(once, "x", 20)
    fit = Fit(Growth(gain="squares", depth=3), 4, 0.3)
    one, two = (fit_side_by_side(t, [fit], cuts=cuts)[0].margin(x) for t in (once, twice))
    assert np.allclose(one, two, atol=1e-9)


def test_one_class_cannot_be_fitted(spark):
    rows = table(spark, np.ones((4, 1)), [True] * 4, [0] * 4)
    with pytest.raises(ValueError):
        fit_side_by_side(rows, [Fit(Growth(), 1, 0.1)])


def test_bins_follow_the_cuts():
    cuts = [[0.0, 1.0], []]
    assert binned(np.array([[0.0, 5.0], [0.5, np.nan], [1.1, 5.0], [np.nan, 5.0]]), cuts).tolist() == [[1, 2, 3, 0], [1, 0, 1, 1]]


# --- what a job moves and computes -------------------------------------------------------------------


def test_sums_of_nodes_and_of_rows_that_count():
    rng = np.random.default_rng(6)
    bins = np.concatenate([rng.integers(1, 3, (3, 3000)), rng.integers(0, 60, (2, 3000))]).astype(np.uint8)
    layout = binning.Layout([[0.0]] * 3 + [list(map(float, range(59)))] * 2)

    class Held:
        pass

    Held.bins = bins
    rows, value = rng.random(3000) < 0.7, rng.normal(size=3000)
    flat = boosting.BranchingTree(*map(np.array, ([0, -1, -1], [1, 0, 0], [True] * 3, [1, 0, 0], [2, 0, 0], [0.0] * 3)))
    found = boosting._sums([(Held, rows, (value, value**2, None))], flat, [2, 1], 3, layout)
    for own, there in zip(found, (rows & (bins[0] > 1), rows & (bins[0] <= 1))):
        for f in range(len(bins)):
            for k, v in enumerate((value, value**2, np.ones(3000))):
                part = own[layout.starts[f] : layout.starts[f + 1], k]
                assert np.array_equal(part, np.bincount(bins[f][there], v[there], len(part)))


def test_a_worker_applies_only_the_trees_that_are_new():
    class Once:
        def __init__(self, value):
            self.value, self.used = value, 0

        def values(self, bins):
            self.used += 1
            return np.full(bins.shape[1], self.value)

    row = {"n": 4, "name": "a" * 64, "share": 0, "shares": 1, "bins": np.ones((2, 4), np.uint8).tobytes()}
    row["scores"] = np.zeros((1, 4)).tobytes()
    one, two, three = Once(1.0), Once(2.0), Once(4.0)
    assert (boosting._scores(row, [[one]], [0]) == 1).all()
    assert (boosting._scores(row, [[one, two]], [0]) == 3).all()
    # The table was written anew with two trees.
    later = row | {"scores": np.full((1, 4), 3.0).tobytes()}
    assert (boosting._scores(later, [[three]], [2]) == 7).all()
    assert [t.used for t in (one, two, three)] == [1, 1, 1]
    # Another worker, or one that is ahead of a job that runs again, starts from the table.
    assert (boosting._scores(later, [[]], [2]) == 3).all()
    boosting._kept.clear()
    assert (boosting._scores(later, [[three]], [2]) == 7).all()


def test_blocks_are_dealt_evenly_and_sums_need_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(binning, "BLOCK_ROWS", 60)
    x, y, fold = sample()
    rows = table(spark, x, y, fold)
    cuts = cut_points(rows, "x", 16)
    packed = boosting.blocks(rows, cuts, N).localCheckpoint()
    scored = boosting._Scored(packed, [0.0] * 3)
    try:
        held = scored.stored.rdd.glom().map(len).collect()
        assert sum(held) == packed.count() and max(held) == 1
    finally:
        scored.release()
