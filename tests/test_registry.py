"""Registered learner queries run the whole job."""

from cardwatch.learners.zoo import LEARNERS
from cardwatch.plans.run import STACK_MEMBERS, RunConfig
from cardwatch.registry import learner_queries as lq


def test_run_is_registered_whole(spark, small, monkeypatch):
    seen = []
    monkeypatch.setattr(lq, "run", lambda train, test, config: seen.append(config) or type("R", (), {"submission": None}))
    lq.r01_run(spark, small)
    (config,), full = seen, RunConfig()
    assert config.params == {} and config.tuning_trials == full.tuning_trials
    assert (config.vote_members, config.stack_members) == (full.vote_members, full.stack_members)


def test_published_rounds_and_members(spark, small, monkeypatch):
    assert lq.BUDGETS == {n: learner.defaults for n, learner in LEARNERS.items()}
    seen = []

    def member_oof(members, *_):
        seen.append(members)
        raise InterruptedError

    monkeypatch.setattr(lq.ensemble, "member_oof", member_oof)
    try:
        lq.m11_stack(spark, small)
    except InterruptedError:
        pass
    assert list(seen[0]) == STACK_MEMBERS and seen[0]["CatBoost"]["iterations"] == 1000


def test_neighbours_by_all_features(spark, small, monkeypatch):
    sizes = []
    nearest = lq.nearest_neighbors

    def spy(test, train, k, **kw):
        sizes.append(len(train.first()["features"]))
        return nearest(test, train, k, **kw)

    monkeypatch.setattr(lq, "nearest_neighbors", spy)
    found = lq.learner_queries()["m29_knn_join_all_features"](spark, small)
    assert found.groupBy("transaction_id").count().filter("count <> 5").count() == 0
    assert found.count() == 5 * lq.raw_split(spark, small)[1].count() and sizes == [len(lq.FEATURES)]
