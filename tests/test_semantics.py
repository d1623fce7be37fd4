"""Hand-worked tables for the rules that are easy to get wrong."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch import session
from cardwatch.functions import features as fx
from cardwatch.functions.ratios import correlation
from cardwatch.functions.running import running_sums, score_bucket, value_bucket
from cardwatch.operators import blend, distribution, encode, evaluate, folds, profile, quality
from cardwatch.operators import submission as sub
from cardwatch.schema import TRAIN_SCHEMA
from cardwatch.sources import tables


def column(df, name):
    return [r[name] for r in df.collect()]


def test_right_closed_bins(spark):
    trust = spark.createDataFrame([(20.0,), (20.01,), (30.0,), (100.0,), (101.0,)], "v double")
    bins = trust.select(fx.right_closed_bin(F.col("v"), profile.TRUST_EDGES, profile.TRUST_LABELS).alias("b"))
    assert column(bins, "b") == [None, "20-30", "20-30", "90-100", None]
    amount = spark.createDataFrame([(0.0,), (0.01,), (50.0,), (500.0,), (1500.0,), (1501.0,)], "v double")
    bins = amount.select(fx.right_closed_bin(F.col("v"), profile.AMOUNT_EDGES, profile.AMOUNT_LABELS).alias("b"))
    assert column(bins, "b") == [None, "$0-50", "$0-50", "$200-500", "$500+", None]


def test_flags_at_their_edges_and_without_values(spark):
    rows = [(500.0, 40, 5), (500.01, 39, 6), (math.nan, None, None), (None, 40, 23)]
    df = spark.createDataFrame(rows, "amount double, device_trust_score int, transaction_hour int")
    out = df.select(
        fx.is_high_amount().alias("high"),
        fx.is_low_trust().alias("low"),
        fx.is_night().alias("night"),
        fx.time_of_day().alias("time"),
    )
    assert [tuple(r) for r in out.collect()] == [
        (0, 0, 1, "Night"),
        (1, 1, 0, "Morning"),
        (0, 0, 0, "Evening"),
        (0, 0, 0, "Evening"),
    ]


TIED = [(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 0), (0.35, 1), (0.1, 0)]


def scored(spark, rows):
    return spark.createDataFrame([(float(s), y) for s, y in rows], "score double, is_fraud int")


def test_ranking_metrics_with_ties(spark):
    df = scored(spark, TIED)
    assert evaluate.average_precision(df, []).first()[0] == pytest.approx(0.755556, abs=1e-6)
    assert evaluate.roc_auc(df, []).first()[0] == pytest.approx(0.722222, abs=1e-6)


def test_curves_have_their_end_points(spark):
    roc = {tuple(r) for r in evaluate.roc_points(scored(spark, TIED), []).collect()}
    assert (0.0, 0.0, math.inf) in roc and (1.0, 1.0, 0.1) in roc and len(roc) == 6
    pr = {tuple(r) for r in evaluate.pr_points(scored(spark, TIED), []).collect()}
    assert (1.0, 0.0, None) in pr and (0.5, 1.0, 0.1) in pr and len(pr) == 6


def test_metrics_against_brute_force_over_many_buckets(spark):
    rng = random.Random(7)
    rows = [(rng.choice([rng.random(), rng.random() ** 9, 1 - rng.random() ** 9, 0.0, 1.0]), int(rng.random() < 0.2)) for _ in range(3000)]
    order = sorted(rows, reverse=True)
    pos, neg = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    by_score = defaultdict(lambda: [0, 0])
    for s, y in order:
        by_score[s][y] += 1
    tp = fp = 0
    ap = auc = 0.0
    for s in sorted(by_score, reverse=True):
        n, p = by_score[s]
        auc += n * (tp + p / 2)
        tp, fp = tp + p, fp + n
        ap += p / pos * tp / (tp + fp)
    df = scored(spark, rows)
    assert evaluate.average_precision(df, []).first()[0] == pytest.approx(ap, abs=1e-12)
    assert evaluate.roc_auc(df, []).first()[0] == pytest.approx(auc / pos / neg, abs=1e-12)


def test_tie_at_one_half(spark):
    df = spark.createDataFrame([(1, 0.5)], "transaction_id long, m double")
    assert df.select(evaluate.threshold_predict(F.col("m"))).first()[0] == 1
    assert blend.soft_vote(df, {"m": 1.0}).first()["prediction"] == 0


def test_nothing_predicted_positive(spark):
    df = scored(spark, [(0.1, 1), (0.2, 0)])
    row = evaluate.pooled_metrics(df, evaluate.threshold_predict(F.col("score")), []).first()
    assert (row["f1"], row["precision"], row["recall"]) == (0.0, 0.0, 0.0)


def test_no_positives_at_all(spark):
    df = scored(spark, [(0.1, 0), (0.7, 0)])
    assert evaluate.average_precision(df, []).first()[0] == 0.0
    best = evaluate.best_threshold(evaluate.threshold_sweep(df, []), []).first()
    assert (best["best_threshold"], best["best_f1"]) == (0.5, 0.0)


def test_threshold_grid(spark):
    grid = [r[0] for r in spark.range(99).select(evaluate.grid_threshold(F.col("id"))).collect()]
    assert grid == [0.01 + i * 0.01 for i in range(99)]
    assert grid[34] == 0.35000000000000003
    values = [*grid, *[math.nextafter(g, 0) for g in grid], 0.35, 0.0, 1.0, 2.0, -1.0, 0.005, 0.995]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    reached = [r[0] for r in df.select(evaluate.thresholds_reached(F.col("s"))).collect()]
    assert reached == [sum(t <= v for t in grid) for v in values]
    assert reached[values.index(0.35)] == 34


def test_plateau_keeps_its_lowest_threshold(spark):
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored(spark, [(0.01, 0), (0.9, 1)]), []), []).first()
    assert (best["best_threshold"], best["best_f1"]) == (0.02, 1.0)


def test_sweep_matches_direct_counting(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 3), int(rng.random() < 0.3)) for _ in range(400)]
    for r in evaluate.threshold_sweep(scored(spark, rows), []).collect():
        tp = sum(y == 1 and s >= r["threshold"] for s, y in rows)
        fp = sum(y == 0 and s >= r["threshold"] for s, y in rows)
        assert (r["tp"], r["fp"]) == (tp, fp)


def test_pooled_and_fold_mean_f1_differ(spark):
    rows = [(f, 1, 0.0 if f == 0 and i == 0 else 1.0) for f in range(5) for i in range(25 if f == 4 else 24)]
    rows += [(f, 0, 0.0) for f in range(5) for _ in range(10)]
    df = spark.createDataFrame(rows, "fold int, is_fraud int, score double")
    hit = evaluate.threshold_predict(F.col("score"))
    assert evaluate.pooled_metrics(df, hit, []).first()["f1"] == pytest.approx(0.995851, abs=1e-6)
    assert evaluate.fold_mean_metrics(df, hit, []).first()["mean_f1"] == pytest.approx(0.995745, abs=1e-6)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert df.agg(correlation(F.col("a"), F.col("b"))).first()[0] is None
    assert profile.correlation_matrix(df, ["a", "b"]).first()["correlation"] is None


def test_buckets_never_fall_as_values_rise(spark):
    rng = random.Random(1)
    values = sorted(
        [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(3000)] + [0.0, 1.0, -1.0, 5e-324, 1e308, -1e308]
    )
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for bucket in (value_bucket, score_bucket):
        found = column(df.orderBy("i").select(bucket(F.col("v")).alias("b")), "b")
        assert found == sorted(found)
    inside = sorted(rng.random() for _ in range(3000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inside)], "i int, v double")
    found = column(df.orderBy("i").select(score_bucket(F.col("v")).alias("b")), "b")
    assert found == sorted(found) and len(set(found)) > 500


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_equal_plain_windows(spark, descending):
    rng = random.Random(5)
    # One group holds most rows; values repeat, and one group key is missing.
    rows = [(rng.choice(["hot"] * 8 + ["cold", None]), rng.choice([rng.uniform(-5, 5), 1.0, 0.0]), i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v double, n int").withColumn("b", value_bucket(F.col("v")))
    order = F.col("v").desc() if descending else F.col("v").asc()
    out = running_sums(df, group=["g"], bucket="b", order=[order], sums={"upto": "n"}, totals={"whole": "n"}, descending=descending)
    got = sorted((r["g"] or "", r["v"], r["n"], r["upto"], r["whole"]) for r in out.collect())
    want = []
    for g, v, n in rows:
        mine = [(w, m) for h, w, m in rows if h == g]
        upto = sum(m for w, m in mine if (w >= v if descending else w <= v))
        want.append((g or "", v, n, upto, sum(m for _, m in mine)))
    assert got == sorted(want)


def test_quantiles_equal_numpy(spark):
    rng = random.Random(2)
    values = [round(rng.lognormvariate(3, 2), 2) for _ in range(1500)] + [7.0] * 700 + [-3.5, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = distribution.describe(df, ["v"]).first()
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(np.percentile(values, [25, 50, 75])), abs=1e-9)
    assert row["mean"] == pytest.approx(np.mean(values)) and row["std"] == pytest.approx(np.std(values, ddof=1))
    single = distribution.describe(df.limit(1), ["v"]).first()
    assert single["std"] is None and single["p25"] == single["p75"]


def test_histogram_of_a_constant_column(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0)], "split string, v double")
    rows = distribution.histogram(df, {"v": 4}, "split").collect()
    assert sum(r["n"] for r in rows) == 2 and len(rows) == 4


def test_duplicates_and_missing_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "transaction_id long, x string")
    assert quality.duplicate_rows(df).first()[0] == 2
    assert quality.duplicate_keys(df).first()[0] == 3
    assert quality.id_overlap(df, df.limit(0)).first()[0] == 0


def test_domain_check_finds_strangers_and_absent_values(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (None, 0)], "a int, b int")
    rows = {r["column_name"]: r for r in quality.domain_check(df, ["a", "b"], [0, 1]).collect()}
    assert (rows["a"]["outside"], rows["a"]["passed"]) == (2, False)
    assert (rows["b"]["outside"], rows["b"]["passed"]) == (0, False)


def test_gate_refuses_missing_values(spark):
    train = spark.createDataFrame([(1, 1.0, 0), (2, math.nan, 1)], "transaction_id long, amount double, is_fraud int")
    test = spark.createDataFrame([(3, 2.0)], "transaction_id long, amount double")
    gate = quality.engineered_gate(train, test, train.select("transaction_id").unionAll(test.select("transaction_id")))
    assert gate.first()["train_nulls"] == 1
    with pytest.raises(ValueError):
        quality.require(gate)


def test_folds_are_balanced_and_complete(spark):
    df = spark.range(1003).select(F.col("id").alias("transaction_id"), (F.col("id") % 40 == 0).cast("int").alias("is_fraud"))
    out = folds.stratified_folds(df, 5).collect()
    assert sorted(r["transaction_id"] for r in out) == list(range(1003))
    for label in (0, 1):
        sizes = [sum(r["fold"] == f and r["is_fraud"] == label for r in out) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    again = {r["transaction_id"]: r["fold"] for r in folds.stratified_folds(df.repartition(13), 5).collect()}
    assert again == {r["transaction_id"]: r["fold"] for r in out}


def test_balanced_weights_sum_to_the_row_count(spark):
    df = spark.range(100).select((F.col("id") < 4).cast("int").alias("is_fraud"))
    assert folds.balanced_weights(df).agg(F.sum("weight")).first()[0] == pytest.approx(100)


def test_scaling_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "a double, b double")
    rows = encode.standard_scale(df, ["a", "b"], df).collect()
    assert [r["b"] for r in rows] == [0.0] * 3 and sum(r["a"] for r in rows) == pytest.approx(0)
    assert np.std([r["a"] for r in rows]) == pytest.approx(1)


def test_weight_search_equals_direct_counting(spark):
    rng = random.Random(11)
    rows = [(int(rng.random() < 0.3), rng.random(), rng.choice([0.5, rng.random()]), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "is_fraud int, a double, b double, c double")
    trials = [*blend.weight_trials(12, 3), [0.0, 0.0, 0.0], [0.0, 1.0, 0.0]]
    for r in blend.search_weights(df, ["a", "b", "c"], trials).collect():
        w = trials[r["trial"]]
        if sum(w) == 0:
            assert r["f1"] == 0.0
            continue
        hit = [(a * w[0] + b * w[1] + c * w[2]) / sum(w) >= 0.5 for _, a, b, c in rows]
        tp = sum(h and y == 1 for h, (y, *_) in zip(hit, rows))
        wrong = sum(h != (y == 1) for h, (y, *_) in zip(hit, rows))
        assert r["f1"] == pytest.approx(2 * tp / (2 * tp + wrong))
        assert r["w_a"] + r["w_b"] + r["w_c"] == pytest.approx(1)


def test_only_a_strictly_better_candidate_is_chosen(spark):
    oof = spark.createDataFrame([(1, 0.9, 0.9), (0, 0.1, 0.1)], "is_fraud int, new double, old double")
    test = spark.createDataFrame([(1, 0.9, 0.1)], "transaction_id long, new double, old double")
    assert blend.select_final(oof, test, F.col("new"), F.col("old")).first()["is_fraud"] == 0
    worse = oof.withColumn("old", F.lit(0.9))
    assert blend.select_final(worse, test, F.col("new"), F.col("old")).first()["is_fraud"] == 1


def sample_of(spark, n=100):
    return spark.range(n).select(F.col("id").alias("transaction_id"), F.lit(0).alias("is_fraud"))


def verdicts(checks):
    return {r["check_name"]: r["passed"] for r in checks.collect()}


def test_valid_submission_passes(spark):
    good = sample_of(spark).withColumn("is_fraud", (F.col("transaction_id") < 2).cast("int"))
    checks = sub.validate_submission(good, sample_of(spark))
    assert all(verdicts(checks).values()) and len(verdicts(checks)) == 7 and sub.all_passed(checks)


def test_each_fault_is_found(spark):
    sample = sample_of(spark)
    good = sample.withColumn("is_fraud", (F.col("transaction_id") < 2).cast("int"))
    faults = {
        "Shape match": good.filter("transaction_id > 0"),
        "Column names": good.select("is_fraud", "transaction_id"),
        "Transaction IDs match": good.withColumn("transaction_id", F.col("transaction_id") + 1),
        "is_fraud binary (0/1)": good.withColumn("is_fraud", F.col("is_fraud") * 2),
        "No null values": good.withColumn("is_fraud", F.when(F.col("transaction_id") != 5, F.col("is_fraud"))),
        "is_fraud is integer": good.withColumn("is_fraud", F.col("is_fraud").cast("double")),
        "Reasonable fraud %": sample,
    }
    for name, bad in faults.items():
        assert verdicts(sub.validate_submission(bad, sample))[name] is False, name


def test_rate_limits_are_exclusive(spark):
    sample = sample_of(spark, 1000)
    for flagged, passed in ((5, False), (6, True), (99, True), (100, False)):
        made = sample.withColumn("is_fraud", (F.col("transaction_id") < flagged).cast("int"))
        assert verdicts(sub.validate_submission(made, sample))["Reasonable fraud %"] is passed


def test_missing_scores_are_below_every_score(spark):
    nan = float("nan")
    rows = [(1, None), (0, 0.2), (1, 0.6), (0, nan), (1, 0.9)]
    df = spark.createDataFrame(rows, "is_fraud int, score double")
    at_half = evaluate.threshold_predict(F.col("score"))
    pooled = evaluate.pooled_metrics(df, at_half, []).first()
    assert (pooled["precision"], round(pooled["recall"], 6)) == (1.0, 0.666667)
    sweep = {round(r["threshold"], 2): r for r in evaluate.threshold_sweep(df, []).collect()}
    assert (sweep[0.5]["tp"], sweep[0.5]["fp"], sweep[0.5]["fn"]) == (2, 0, 1)
    assert (sweep[0.01]["tp"], sweep[0.01]["fp"], sweep[0.01]["fn"]) == (2, 1, 1)
    # From the top: 0.9 (1), 0.6 (1), 0.2 (0), then the two missing ones together.
    points = evaluate.pr_points(df, []).collect()
    found = sorted((round(r["recall"], 4), round(r["precision"], 4)) for r in points)
    assert found == [(0.0, 1.0), (0.3333, 1.0), (0.6667, 0.6667), (0.6667, 1.0), (1.0, 0.6)]
    ap = evaluate.average_precision(df, []).first()["average_precision"]
    assert ap == pytest.approx((1 + 1 + 0.6) / 3)
    roc = evaluate.roc_points(df, [], drop_collinear=True).collect()
    corners = [(0.0, 0.0), (0.0, 0.3333), (0.0, 0.6667), (0.5, 0.6667), (1.0, 1.0)]
    assert sorted((r["fpr"], round(r["tpr"], 4)) for r in roc) == corners
    flagged = {r["threshold"]: r["n_fraud"] for r in evaluate.prediction_summary(df, [], [0.5, 0.3]).collect()}
    assert flagged == {0.5: 2, 0.3: 2}
    strategies = {r["strategy"]: r for r in evaluate.strategy_table(df, []).collect()}
    assert strategies["Standard (0.5)"]["fn"] == 1 and strategies["Standard (0.5)"]["fp"] == 0


def test_nan_is_missing(spark):
    rows = [(1, 1.0), (2, float("nan")), (3, None), (4, 3.0), (5, 0.0), (6, -0.0)]
    df = spark.createDataFrame(rows, "k int, amount double")
    assert {r["column_name"]: r["nulls"] for r in quality.null_counts(df, ["k", "amount"]).collect()} == {"k": 0, "amount": 2}
    stats = distribution.describe(df, ["amount"]).first()
    assert (stats["count"], stats["mean"], stats["max"], stats["p50"]) == (4, 1.0, 3.0, 0.5)
    assert {r["column_name"]: r["n_unique"] for r in distribution.distinct_counts(df, ["k", "amount"]).collect()} == {"k": 6, "amount": 3}


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    names = TRAIN_SCHEMA.names
    values = dict(zip(names, ["7", "NaN", "3", "Food", "1", "0", "50", "2", "40", "1"], strict=True))
    shuffled = [*names[5:], *names[:5]]
    (tmp_path / "t.csv").write_text(",".join(shuffled) + "\n" + ",".join(values[n] for n in shuffled) + "\n")
    row = tables.read_transactions(spark, str(tmp_path / "t.csv"), "train").first()
    assert row.asDict() == {
        "transaction_id": 7, "amount": None, "transaction_hour": 3, "merchant_category": "Food", "foreign_transaction": 1,
        "location_mismatch": 0, "device_trust_score": 50, "velocity_last_24h": 2, "cardholder_age": 40, "is_fraud": 1,
        "split": "train",
    }
    (tmp_path / "u.csv").write_text(",".join(names[1:]) + "\n" + ",".join(values[n] for n in names[1:]) + "\n")
    with pytest.raises(ValueError, match="in place of"):
        tables.read_transactions(spark, str(tmp_path / "u.csv"), "train")


def test_scratch_needs_a_shared_folder_off_one_machine(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Cluster()  # noqa: N815
        conf = {}  # noqa: RUF012

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
