"""Linear models that are fitted side by side against Spark's own estimators, one fit at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.learners import linear, raw_blocks
from cardwatch.learners.zoo import LEARNERS
from cardwatch.plans import training
from cardwatch.schema import ID, LABEL

N = 400
NAMES = [f"f{i}" for i in range(5)]


@pytest.fixture(scope="module")
def folded(spark):
    pick = np.random.default_rng(3)
    x = np.column_stack([pick.integers(0, 2, N), 900 + 300 * pick.normal(size=N), pick.integers(0, 9, N), np.ones(N), pick.normal(size=N)])
    y = pick.random(N) < 1 / (1 + np.exp(-((x[:, 1] - 1200) / 150 + x[:, 0] - (x[:, 2] > 5))))
    rows = [(i, int(b), int(f), *map(float, a)) for i, (a, b, f) in enumerate(zip(x, y, pick.integers(0, 3, N)))]
    return spark.createDataFrame(rows, [ID, LABEL, "fold", *NAMES]).repartition(3).persist()


def scores(df):
    return {r[ID]: r["score"] for r in df.collect()}


@pytest.mark.parametrize("block, scaled", [(150, True), (1 << 14, False)])
def test_folds_at_once_equal_one_fold_at_a_time(folded, monkeypatch, block, scaled):
    monkeypatch.setattr(raw_blocks, "BLOCK_ROWS", block)
    learner, params = training.learner("LogisticRegression", "script" if scaled else "notebook"), {"C": 0.3, "max_iter": 8}
    together = scores(training.oof_predict(learner, params, folded, NAMES))
    apart = scores(training.oof_predict(learner, params, folded, NAMES, resample=lambda rows: rows))
    assert together.keys() == apart.keys() and len(together) == N
    assert max(abs(together[i] - apart[i]) for i in together) < 1e-7


def test_trials_of_a_search_share_their_jobs(folded, monkeypatch):
    """The number of jobs is that of the longest fit, not of all trials and folds."""
    jobs, plain = [], raw_blocks.Blocks.summed
    monkeypatch.setattr(raw_blocks.Blocks, "summed", lambda self, *a, **k: jobs.append(1) or plain(self, *a, **k))
    learner = LEARNERS["LogisticRegression"]
    few = dict(fixed={"max_iter": 4}, sampler="random")
    training.tune(learner, folded, NAMES, n_trials=1, **few).collect()
    alone = len(jobs)
    found = training.tune(learner, folded, NAMES, n_trials=3, **few).collect()
    assert 0 < len(jobs) - alone < 2 * alone
    params = training.json.loads(found[2]["params"])
    apart = training.oof_predict(learner, params, folded, NAMES, resample=lambda rows: rows)
    tp, fp, fn = (F.count_if((F.col("prediction") == p) & (F.col(LABEL) == y)) for p, y in ((1, 1), (1, 0), (0, 1)))
    f1 = apart.groupBy("fold").agg((2 * tp / (2 * tp + fp + fn)).alias("f1")).agg(F.avg("f1")).first()[0]
    assert found[2]["error"] is None and found[2]["mean_f1"] == pytest.approx(f1, abs=1e-12)


def test_one_class_is_an_error(spark):
    rows = spark.createDataFrame([([1.0], True, 0), ([2.0], True, 1)], "x array<double>, y boolean, fold int")
    with pytest.raises(ValueError):
        linear.fit_side_by_side(rows, [linear.LinearFit(0.1, 5)])
