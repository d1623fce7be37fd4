"""Invariants of everything that fits a model, and exact checks where brute force is possible."""

import math
import pathlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cardwatch.learners.adaboost import AdaBoostStumps
from cardwatch.learners.gaussian_nb import GaussianNaiveBayes
from cardwatch.learners.knn import NearestNeighbors, nearest_neighbors, vote
from cardwatch.learners.zoo import LEARNERS, Setting
from cardwatch.operators import encode
from cardwatch.plans import ensemble, training
from cardwatch.plans.run import STACKED_NAME, RunConfig, run
from cardwatch.registry import learner_queries as lq
from cardwatch.sources import artifacts, results_log, standin, tables


# Few rounds: what is tested here does not depend on how long a learner is trained.
SMALL_BUDGETS = {
    "LogisticRegression": {"C": 1.0, "max_iter": 50},
    "RandomForest": {"n_estimators": 20, "max_depth": 6},
    "ExtraTrees": {"n_estimators": 20, "max_depth": 6},
    "XGBoost": {"n_estimators": 5, "learning_rate": 0.3, "max_depth": 4},
    "LightGBM": {"n_estimators": 5, "learning_rate": 0.2, "max_depth": 5},
    "CatBoost": {"iterations": 5, "learning_rate": 0.2, "depth": 4},
    "AdaBoost": {"n_estimators": 8, "learning_rate": 0.7},
    "GradientBoosting": {"n_estimators": 8, "learning_rate": 0.3, "max_depth": 3},
    "SVC": {"C": 1.0, "max_iter": 15, "folds": 2},
    "KNN": {"n_neighbors": 5, "weights": "distance"},
    "GaussianNB": {"var_smoothing": 1e-9},
    "MLPClassifier": {"hidden_layer_sizes": [10], "alpha": 0.08, "max_iter": 30},
}


@pytest.fixture(scope="module")
def raw(spark, small):
    tx = standin.transactions_table(spark, small)
    return standin.train_rows(tx), standin.test_rows(tx)


@pytest.fixture(scope="module")
def folded(raw):
    return training.training_table(lq.engineered(raw[0]), 3)


@pytest.mark.parametrize("name", sorted(LEARNERS))
def test_out_of_fold_scores(folded, name):
    oof = training.oof_predict(LEARNERS[name], SMALL_BUDGETS[name], folded, lq.FEATURES).collect()
    assert len({r["transaction_id"] for r in oof}) == len(oof) == folded.count()
    assert all(0.0 <= r["score"] <= 1.0 and r["prediction"] in (0, 1) for r in oof)


def test_refitting_gives_the_same_scores(folded):
    def scores():
        oof = training.oof_predict(LEARNERS["RandomForest"], SMALL_BUDGETS["RandomForest"], folded, lq.FEATURES)
        return {r["transaction_id"]: r["score"] for r in oof.collect()}

    first, second = scores(), scores()
    assert first.keys() == second.keys() and all(first[k] == pytest.approx(second[k], abs=1e-9) for k in first)


def vectors(spark, x, y, first_id=0):
    rows = [(first_id + i, int(label), *map(float, row)) for i, (row, label) in enumerate(zip(x, y))]
    names = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame(rows, f"transaction_id long, is_fraud int, {', '.join(f'{n} double' for n in names)}")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


@pytest.mark.parametrize(("pivots", "block_rows"), [(1, 10_000), (7, 40), (40, 5)])
def test_neighbours_equal_brute_force(spark, pivots, block_rows):
    rng = np.random.default_rng(4)
    # A tight clump holds a third of the rows; integers make exact ties.
    x = np.vstack([rng.integers(0, 6, (200, 3)), np.full((100, 3), 2.0) + rng.integers(0, 2, (100, 3))]).astype(float)
    y = rng.integers(0, 2, len(x))
    q = np.vstack([x[::23], rng.uniform(-3, 9, (20, 3)), [[100.0, 100.0, 100.0]]])
    k = 4
    train = vectors(spark, x, y)
    queries = vectors(spark, q, np.zeros(len(q)), first_id=10_000)
    found = nearest_neighbors(queries, train, k, label="is_fraud", pivots=pivots, block_rows=block_rows).collect()
    got = {(r["transaction_id"], r["rank"]): (r["neighbor_id"], r["d2"]) for r in found}
    want = {}
    for i, point in enumerate(q):
        d2 = np.round(((x - point) ** 2).sum(1), 9)
        for rank, j in enumerate(np.lexsort((np.arange(len(x)), d2))[:k], start=1):
            want[(10_000 + i, rank)] = (int(j), float(d2[j]))
    assert got == want


def test_fewer_rows_than_neighbours(spark):
    train = vectors(spark, np.array([[0.0], [5.0]]), [0, 1])
    found = nearest_neighbors(vectors(spark, np.array([[1.0]]), [0], 50), train, 5, label="is_fraud", pivots=2)
    assert sorted(r["neighbor_id"] for r in found.collect()) == [0, 1]


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_bounded_neighbours_equal_the_join_and_survive_saving(spark, tmp_path, weights):
    rng = np.random.default_rng(11)
    x, y = rng.integers(0, 4, (300, 3)).astype(float), rng.integers(0, 2, 300)
    queries = vectors(spark, np.vstack([x[:30], rng.uniform(0, 4, (30, 3))]), np.zeros(60), first_id=1000)
    build = lambda most: NearestNeighbors(featuresCol="features", labelCol="is_fraud", k=4, weights=weights, maxTrainRows=most)
    share = lambda m: {r["transaction_id"]: r["probability"][1] for r in m.transform(queries).collect()}
    train = vectors(spark, x, y)
    bounded = build(1000).fit(train)
    assert share(bounded) == pytest.approx(share(build(0).fit(train)))
    PipelineModel([bounded]).write().save(str(tmp_path / "knn"))
    assert share(PipelineModel.load(str(tmp_path / "knn"))) == share(bounded)
    drawn = build(50).fit(train).train
    assert drawn.count() <= 50 and abs(drawn.filter("is_fraud = 1").count() - 50 * y.mean()) <= 1
    # A repeated query is scored row by row.
    twice = bounded.transform(queries.unionAll(queries))
    assert twice.count() == 120


def test_all_labelled_rows_vote(spark):
    """More rows than a bounded model kept, each its own nearest; ids that repeat or are missing are scored row by row."""
    learner = LEARNERS["KNN"]
    at = F.col("id").cast("double")
    rows = spark.range(20_100).select(F.col("id").alias("transaction_id"), array_to_vector(F.array(at)).alias("features"), (at % 3 == 0).cast("int").alias("is_fraud"))
    model = learner.build(learner.defaults, Setting(1, 20_100.0, "features")).fit(rows)
    assert model.train.count() == 20_100
    asked = [(None, 0.0), (7, 20_001.0), (7, 20_002.0), (7, 20_099.0)]
    queries = spark.createDataFrame(asked, "transaction_id long, at double").select("*", array_to_vector(F.array("at")).alias("features"))
    found = {(r["transaction_id"], r["at"]): r["probability"][1] for r in model.transform(queries).collect()}
    assert found == {(i, at): float(at % 3 == 0) for i, at in asked}


def test_exact_hits_decide_alone(spark):
    rows = [(1, 1, 0.0, 1.0), (1, 2, 4.0, 0.0), (2, 1, 1.0, 1.0), (2, 2, 4.0, 0.0)]
    near = spark.createDataFrame(rows, "transaction_id long, rank int, d2 double, neighbor_label double")
    by_distance = {r["transaction_id"]: r["score"] for r in vote(near, "distance").collect()}
    assert by_distance[1] == 1.0 and by_distance[2] == pytest.approx(1 / 1.5)
    assert {r["score"] for r in vote(near, "uniform").collect()} == {0.5}


def test_adaboost_equals_a_hand_run(spark):
    x = np.array([[1.0], [2.0], [3.0], [4.0], [5.0], [6.0]])
    y = np.array([1, 1, 0, 0, 1, 0])
    model = AdaBoostStumps(featuresCol="features", labelCol="is_fraud", rounds=3, learningRate=1.0).fit(vectors(spark, x, y))
    weights = np.ones(6)
    decision = np.zeros(6)
    for (feature, threshold, below, above), say in model.rounds_used():
        guess = np.where(x[:, feature] <= threshold, below, above)
        error = weights[guess != y].sum() / weights.sum()
        assert say == pytest.approx(math.log((1 - error) / error))
        weights = weights * np.exp(say * (guess != y))
        decision += say * np.where(guess == 1, 1, -1)
    total = sum(s for _, s in model.rounds_used())
    want = 1 / (1 + np.exp(-decision / total))
    out = model.transform(vectors(spark, x, y)).orderBy("transaction_id").collect()
    assert [r["probability"][1] for r in out] == pytest.approx(list(want))


def test_adaboost_rounds_equal_a_plain_loop(spark):
    """Twenty-five rounds over whole-number features: more than two rewrites of the weights."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 5, (400, 3)).astype(float)
    y = ((x[:, 0] + x[:, 1] > 4) ^ (rng.random(400) < 0.2)).astype(int)
    model = AdaBoostStumps(featuresCol="features", labelCol="is_fraud", rounds=25, learningRate=0.5).fit(vectors(spark, x, y))
    weights, want = np.ones(len(x)), []
    for _ in range(25):
        splits = []
        for f in range(3):
            for t in sorted(set(x[:, f]))[:-1]:
                sides = [x[:, f] <= t, x[:, f] > t]
                masses = [(weights[s & (y == 0)].sum(), weights[s & (y == 1)].sum()) for s in sides]
                splits.append((round(sum(2 * a * b / (a + b) for a, b in masses), 9), f, t, masses))
        _, f, t, masses = min(splits)
        below, above = (float(b > a) for a, b in masses)
        wrong = np.where(x[:, f] <= t, below, above) != y
        error = weights[wrong].sum() / weights.sum()
        say = 0.5 * math.log((1 - error) / error)
        weights = weights * np.exp(say * wrong)
        want.append((f, t, below, above, say))
    got = [(*stump, say) for stump, say in model.rounds_used()]
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


def test_naive_bayes_equals_its_formula(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(60, 3)) * [1, 10, 0.1], rng.integers(0, 2, 60)
    smoothing = 1e-3
    df = vectors(spark, x, y)
    model = GaussianNaiveBayes(featuresCol="features", labelCol="is_fraud", smoothing=smoothing).fit(df)
    extra = smoothing * x.var(0).max()
    logs = []
    for c in (0, 1):
        mean, var = x[y == c].mean(0), x[y == c].var(0) + extra
        logs.append(np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * var) + (x - mean) ** 2 / var).sum(1))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    got = [r["probability"][1] for r in model.transform(df).orderBy("transaction_id").collect()]
    assert got == pytest.approx(list(want))


def test_csv_round_trip(spark, raw, tmp_path):
    path = tables.write_table(raw[0], str(tmp_path / "train"), "csv")
    back = tables.read_transactions(spark, path, "train", "csv").drop("split")
    assert back.schema.simpleString() == raw[0].schema.simpleString()
    assert back.exceptAll(raw[0]).count() == 0 and back.count() == raw[0].count()


def test_log_keeps_the_last_run(spark, tmp_path):
    from cardwatch.operators import blend

    path = str(tmp_path / "log")
    base = dict.fromkeys(results_log.RESULTS_LOG_SCHEMA.names, None)
    for seq, (name, f1) in enumerate([("A", 0.9), ("B", 0.80001), ("A", 0.5), ("Ensemble_SoftVoting", 0.99)]):
        results_log.append_result(spark, path, base | {"run_seq": seq, "Model_Name": name, "CV_F1_Score": f1})
    board = blend.leaderboard(results_log.read_log(spark, path)).orderBy("Rank").collect()
    assert [(r["Model_Name"], r["CV_F1_Score"]) for r in board] == [("Ensemble_SoftVoting", 0.99), ("B", 0.8), ("A", 0.5)]
    top = blend.pick_top_models(results_log.read_log(spark, path), 1).collect()
    assert [r["Model_Name"] for r in top] == ["B"]


def test_tuning_survives_a_failing_trial(folded):
    space = {"C": ("choice", [-1.0])}
    trials = training.tune(LEARNERS["LogisticRegression"], folded, lq.FEATURES, n_trials=1, space=space).collect()
    assert trials[0]["mean_f1"] == 0.0 and trials[0]["error"]


def test_models_survive_saving(spark, raw, small):
    scored = lq.s06_save_load_model(spark, small)
    assert scored.count() == raw[1].count()


def test_stream_scores_every_row_once(spark, raw, small):
    scored = lq.x05_stream_scoring(spark, small)
    assert scored.select("transaction_id").distinct().count() == scored.count() == raw[1].count()


def test_nested_blend_covers_all_rows(folded):
    members = {"LogisticRegression": SMALL_BUDGETS["LogisticRegression"], "GaussianNB": SMALL_BUDGETS["GaussianNB"]}
    oof = ensemble.member_oof(members, folded, lq.FEATURES)
    assert ensemble.nested_blend(oof, list(members), 3, n_trials=5).count() == folded.count()


def test_whole_run_twice_into_one_folder(spark, raw, tmp_path):
    members = ["GradientBoosting", "GaussianNB"]
    config = RunConfig(
        vote_members=members,
        stack_members=[*members, "LogisticRegression"],
        merchants=standin.EVENT_TYPES,
        params={m: SMALL_BUDGETS[m] for m in members},
        folds=3,
        tuning_trials=2,
        weight_trials=10,
        output=str(tmp_path),
    )
    first, second = run(*raw, config), run(*raw, config)
    assert first.valid and first.chosen == second.chosen
    rows = sorted(map(tuple, first.submission.collect()))
    assert rows == sorted(map(tuple, second.submission.collect())) and len(rows) == raw[1].count()
    log = results_log.read_log(spark, f"{tmp_path}/results_log").collect()
    # Three single models twice each (pooled, mean of folds), the vote and the stack, in each run.
    assert len(log) == 2 * (3 * 2 + 2) and first.checks.count() == 7
    assert sorted({r["run_seq"] for r in log}) == list(range(10))
    for r in log:
        if r["Model_Name"] == second.chosen:
            written = spark.read.option("header", True).csv(f"{r['Output_Predictions_Path']}/predictions")
            assert sorted((int(x["transaction_id"]), int(x["is_fraud"])) for x in written.collect()) == rows
            oof = spark.read.parquet(f"{r['Output_Predictions_Path']}/oof")
            assert oof.count() == raw[0].count() and {"is_fraud", "prediction_prob"} <= set(oof.columns)
        if r["Model_Name"] in (*members, "LogisticRegression", STACKED_NAME):
            assert (pathlib.Path(r["Model_File_Path"]) / "metadata").exists()
    package = artifacts.load_settings(spark, str(tmp_path / "run-5"))
    assert package[STACKED_NAME].members == (*members, "LogisticRegression") and package["Ensemble_SoftVoting"].mode == "above"
    # The saved stack gives the stack's predictions again.
    models = artifacts.load_models([*members, "LogisticRegression", STACKED_NAME], str(tmp_path / "run-5"))
    meta = models.pop(STACKED_NAME)
    again = ensemble.stacked_scores(meta, ensemble.member_scores(models, lq.engineered(raw[1])))
    hits = again.filter(F.col("score") >= package[STACKED_NAME].threshold).count()
    (path,) = {r["Output_Predictions_Path"] for r in log if r["Model_Name"] == STACKED_NAME and r["run_seq"] >= 5}
    assert hits == spark.read.option("header", True).csv(f"{path}/predictions").filter("is_fraud = 1").count()
    assert {p.name for p in tmp_path.iterdir()} >= {"submission", "submission_standard", "submission_aggressive"}


def test_unknown_merchants_stop_a_run(raw):
    with pytest.raises(ValueError, match="merchant_category=view"):
        run(*raw, RunConfig(merchants=[e for e in standin.EVENT_TYPES if e != "view"]))


def test_notebook_preset_votes_among_the_best(raw):
    members = ["LogisticRegression", "RandomForest", "GaussianNB"]
    config = RunConfig(
        preset="notebook",
        vote_top=2,
        stack_members=members,
        vote_members=[],
        merchants=standin.EVENT_TYPES,
        params={m: SMALL_BUDGETS[m] for m in members},
        folds=3,
        weight_trials=5,
    )
    result = run(*raw, config)
    vote = result.log.filter("Model_Name = 'Ensemble_SoftVoting'").first()
    assert vote["Best_Parameters"].count(":") == 2
    assert not training.learner("LogisticRegression", "notebook").scaled


def test_engineered_table_hides_the_test_label(raw):
    table = encode.preprocess(*raw, standin.EVENT_TYPES)
    assert table.filter((F.col("split") == "test") & F.col("is_fraud").isNotNull()).count() == 0
    assert set(lq.FEATURES) <= set(table.columns) and len(lq.FEATURES) == 23
