"""Queries that fit models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.learners import rules
from cardwatch.learners.gaussian_nb import GaussianNaiveBayes
from cardwatch.learners.knn import nearest_neighbors, vote
from cardwatch.learners.zoo import BUILT_IN_BOOSTING, LEARNERS, Learner
from cardwatch.operators import encode, resample
from cardwatch.operators import evaluate as ev
from cardwatch.operators.importance import feature_importance
from cardwatch.plans import ensemble, training
from cardwatch.plans.run import STACK_MEMBERS, RunConfig, run
from cardwatch.schema import ID, LABEL, RAW_FEATURES, feature_names
from cardwatch.session import scratch_path, settle
from cardwatch.sources import artifacts, standin, tables
from cardwatch.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

FEATURES = feature_names(standin.EVENT_TYPES)
FOLDS = 5

# The published parameters and rounds of every learner.
BUDGETS = {name: learner.defaults for name, learner in LEARNERS.items()}

NUMBERED = {
    "m20_logistic_regression": "LogisticRegression",
    "m21_random_forest": "RandomForest",
    "m22_extra_trees": "ExtraTrees",
    "m23_xgboost_preset": "XGBoost",
    "m24_lightgbm_preset": "LightGBM",
    "m25_catboost_preset": "CatBoost",
    "m26_adaboost": "AdaBoost",
    "m27_gradient_boosting": "GradientBoosting",
    "m28_svc": "SVC",
    "m29_knn_oof": "KNN",
    "m30_gaussian_nb_oof": "GaussianNB",
    "m31_mlp": "MLPClassifier",
}


def raw_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tx = standin.transactions_table(spark, sf_dir)
    return standin.train_rows(tx), standin.test_rows(tx)


def engineered(df: DataFrame) -> DataFrame:
    return encode.encode(encode.engineer_features(df), standin.EVENT_TYPES)


def learning_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engineered train rows, written once: fits read them many times."""
    return settle(engineered(raw_split(spark, sf_dir)[0]))


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_table(engineered(raw_split(spark, sf_dir)[0]), FOLDS)


def rounded_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


def oof_of(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folded = table(spark, sf_dir)
        return rounded_score(training.oof_predict(training.learner(name), BUDGETS[name], folded, FEATURES))

    return query


def m04_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = table(spark, sf_dir)
    name = "LogisticRegression"
    return training.cross_validate(training.learner(name), BUDGETS[name], folded, FEATURES)


def m06_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = table(spark, sf_dir)
    learner = training.learner("LogisticRegression")
    return training.tune(learner, folded, FEATURES, n_trials=20)


def m07_fit_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = raw_split(spark, sf_dir)
    name = "GradientBoosting"
    model = training.fit_final(training.learner(name), BUDGETS[name], learning_rows(spark, sf_dir), FEATURES)
    return training.predictions(training.score_test(model, engineered(test)))


def m11_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = {m: BUDGETS[m] for m in STACK_MEMBERS}
    oof = ensemble.member_oof(members, table(spark, sf_dir), FEATURES)
    meta_oof, _, threshold = ensemble.stack(oof, list(members), FOLDS)
    stacked = meta_oof.withColumn("prediction", ev.threshold_predict(F.col("score"), threshold))
    return rounded_score(stacked)


def m15_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = learning_rows(spark, sf_dir)
    names = ["RandomForest", "GradientBoosting", "LogisticRegression", "AdaBoost"]
    models = {n: training.fit_final(training.learner(n), BUDGETS[n], learn, FEATURES) for n in names}
    return feature_importance(spark, models, FEATURES)


def f15_population_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows as the scaler inside the fits sees them, one row per position."""
    train, test = raw_split(spark, sf_dir)
    known = training.feature_matrix(train, RAW_FEATURES)
    stages = training.population_scaler("features", "scaled", known.count(), len(RAW_FEATURES))
    return by_position(Pipeline(stages=stages).fit(known).transform(training.feature_matrix(test, RAW_FEATURES)), "scaled")


def f16_matrix_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of the model inputs of the train rows."""
    return by_position(training.feature_matrix(engineered(raw_split(spark, sf_dir)[0]), FEATURES), "features")


def by_position(rows: DataFrame, vector: str) -> DataFrame:
    return rows.select(ID, F.posexplode(vector_to_array(vector)).alias("position", "value")).withColumn("value", F.round("value", 6))


def scaled_vectors(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Train and test with these columns z-scored by the train statistics."""
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    doubles = {c: F.col(c).cast("double") for c in columns}
    return tuple(assembler.transform(encode.standard_scale(df.withColumns(doubles), columns, train)) for df in (train, test))


def neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = scaled_vectors(*raw_split(spark, sf_dir), RAW_FEATURES)
    return nearest_neighbors(test, train, 5, label=LABEL)


def neighbors_by_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = scaled_vectors(*(settle(engineered(df)) for df in raw_split(spark, sf_dir)), FEATURES)
    return nearest_neighbors(test, train, 5, label=LABEL)


def listed(found: DataFrame) -> DataFrame:
    return found.select(ID, F.col("rank").alias("neighbor_rank"), "neighbor_id", F.round("d2", 6).alias("d2"))


def votes(found: DataFrame) -> DataFrame:
    near = vote(found, "distance").withColumnRenamed("score", "distance_score")
    return vote(found, "uniform").withColumnRenamed("score", "uniform_score").join(near, ID).select(
        ID, F.round("uniform_score", 6).alias("uniform_score"), F.round("distance_score", 6).alias("distance_score")
    )


def m29_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(neighbors(spark, sf_dir))


def m29_knn_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes(neighbors(spark, sf_dir))


def m29_knn_join_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(neighbors_by_all_features(spark, sf_dir))


def m29_knn_vote_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes(neighbors_by_all_features(spark, sf_dir))


def m30_gaussian_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = raw_split(spark, sf_dir)
    assembler = VectorAssembler(inputCols=RAW_FEATURES, outputCol="features")
    model = GaussianNaiveBayes(featuresCol="features", labelCol=LABEL, smoothing=1e-9).fit(
        assembler.transform(train)
    )
    scored = model.transform(assembler.transform(test))
    return rounded_score(scored.select(ID, training.positive_score(scored).alias("score")))


def s06_save_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = raw_split(spark, sf_dir)
    names = ["LogisticRegression", "GaussianNB", "KNN"]
    learn = learning_rows(spark, sf_dir)
    path = scratch_path(spark, "artifacts")
    artifacts.save_models(ensemble.member_models({n: BUDGETS[n] for n in names}, learn, FEATURES), path)
    equal = artifacts.Ensemble("equal", tuple(names), (0.5,) * len(names), 0.5, "at_least")
    artifacts.save_settings(spark, [equal], "equal", path)
    loaded = artifacts.load_models(names, path)
    wide = ensemble.member_scores(loaded, engineered(test))
    return wide.select(ID, *[F.round(n, 6).alias(n) for n in names])


def x05_stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = raw_split(spark, sf_dir)
    name = "LogisticRegression"
    model = training.fit_final(training.learner(name), BUDGETS[name], learning_rows(spark, sf_dir), FEATURES)
    arrived = tables.write_table(test, scratch_path(spark, "arriving"))
    stream = scoring.score_stream(scoring.read_stream(spark, arrived), model, standin.EVENT_TYPES)
    scored = scratch_path(spark, "scored")
    scoring.write_scores(stream, scored, scratch_path(spark, "stream-state")).awaitTermination()
    return rounded_score(spark.read.parquet(scored))


def r01_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = raw_split(spark, sf_dir)
    config = RunConfig(merchants=standin.EVENT_TYPES, folds=FOLDS, output=scratch_path(spark, "run"))
    return run(train, test, config).submission


# --- fits whose answer is known exactly ---------------------------------------------------------


def m05_oof_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fold: rows, positives, and rows whose score is a probability."""
    oof = training.oof_predict(training.learner("GaussianNB"), BUDGETS["GaussianNB"], table(spark, sf_dir), FEATURES)
    return oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(LABEL) == 1).alias("n_pos"),
        F.count_if(F.col("score").between(0, 1)).alias("n_probabilities"),
        F.count_if((F.col("score") > 0.5) == (F.col("prediction") == 1)).alias("n_consistent"),
    )


def fitted_on(spark: SparkSession, sf_dir: str, name: str | Learner, params: dict, features: list[str], *keep: str) -> DataFrame:
    """Scores of the train rows by a model of few columns: one row per value of ``keep``."""
    rows = raw_split(spark, sf_dir)[0].withColumn("category", F.col("merchant_category"))
    # One column in which every fourth value is missing.
    rows = rows.withColumn("known_foreign", F.when(F.col(ID) % 4 != 0, F.col("foreign_transaction")))
    rows = settle(encode.one_hot(rows, {"merchant_category": standin.EVENT_TYPES}))
    model = training.fit_final(training.learner(name) if isinstance(name, str) else name, params, rows, features)
    return training.score(model, rows, list(keep)).groupBy(*keep).agg(F.max("score").alias("score"))


def m20_category_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without penalty, logistic regression on one category gives back each value's weighted rate."""
    columns = [f"merchant_category_{e}" for e in standin.EVENT_TYPES]
    rates = fitted_on(spark, sf_dir, "LogisticRegression", {"C": 1e9}, columns, "category")
    return rates.withColumn("score", F.round("score", 3))


def m22_single_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of one split gives back the weighted rates of its two sides."""
    params = {"n_estimators": 1, "max_depth": 1}
    return rounded_score(fitted_on(spark, sf_dir, "ExtraTrees", params, ["foreign_transaction"], "foreign_transaction"))


def m27_single_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One boosting round fits the means of the labels as -1 and 1."""
    params = {"n_estimators": 1, "learning_rate": 0.1, "max_depth": 1}
    return rounded_score(fitted_on(spark, sf_dir, BUILT_IN_BOOSTING, params, ["foreign_transaction"], "foreign_transaction"))


PAIR = ["foreign_transaction", "location_mismatch"]


def m27_two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of depth 2 over two flags: every cell takes two Newton steps from the log odds."""
    params = {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 2}
    return rounded_score(fitted_on(spark, sf_dir, "GradientBoosting", params, PAIR, *PAIR))


def m25_symmetric_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two symmetric trees of depth 2 over two flags: penalised Newton steps from 0, on balanced classes."""
    params = {"iterations": 2, "learning_rate": 0.5, "depth": 2}
    return rounded_score(fitted_on(spark, sf_dir, "CatBoost", params, PAIR, *PAIR))


def m23_missing_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of one split each over a flag with missing values, which go to the side of larger gain."""
    params = {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 1}
    return rounded_score(fitted_on(spark, sf_dir, "XGBoost", params, ["known_foreign"], "known_foreign"))


def m26_three_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three boosted stumps over two flags, with rows reweighed in between."""
    params = {"n_estimators": 3, "learning_rate": 1.0}
    return rounded_score(fitted_on(spark, sf_dir, "AdaBoost", params, PAIR, *PAIR))


def m26_single_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One boosted stump: the larger class of each side."""
    params = {"n_estimators": 1, "learning_rate": 1.0}
    found = fitted_on(spark, sf_dir, "AdaBoost", params, ["location_mismatch", "foreign_transaction"], "foreign_transaction")
    return found.withColumn("score", F.round("score", 6))


# --- resampling, rules, other scalers -----------------------------------------------------------


def x01_undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.undersample(raw_split(spark, sf_dir)[0], ratio=2.0).select(ID, LABEL)


def new_rows(spark: SparkSession, sf_dir: str, by_density: bool) -> DataFrame:
    made = resample.new_rows(raw_split(spark, sf_dir)[0], RAW_FEATURES, by_density=by_density)
    values = [F.round(c, 6).alias(c) for c in ("gap", *RAW_FEATURES)]
    return made.select(ID, F.col("copy").cast("int").alias("copy"), "neighbor_id", *values)


def x02_smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(spark, sf_dir, by_density=False)


def x02_adasyn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(spark, sf_dir, by_density=True)


def x02_smote_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold scores of a learner whose training rows alone are grown."""
    learner = training.learner("LogisticRegression")
    grow = lambda rows: resample.oversample(rows, FEATURES)
    return rounded_score(training.oof_predict(learner, learner.defaults, table(spark, sf_dir), FEATURES, resample=grow))


def x03_leaf_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purity of the leaves of a tree over two flags, by the flags' values."""
    train = settle(raw_split(spark, sf_dir)[0])
    mined = rules.paths(rules.grow_tree(train, PAIR), PAIR)
    by_leaf = rules.purity(train, mined)
    leaves = train.select(*PAIR, rules.leaf_of(mined).alias("leaf")).distinct()
    return leaves.join(by_leaf, "leaf").select(*PAIR, "n", "n_pos", F.round("purity", 6).alias("purity"))


def x03_rule_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many predictions of a score the rules over two flags change: leaves with 20 rows, a quarter of them fraud."""
    tx = standin.transactions_table(spark, sf_dir)
    train = settle(standin.train_rows(tx))
    mined = rules.mine(train, PAIR, least_rows=20, least_purity=0.25)
    scored = standin.scores(tx).join(tx.select(ID, *PAIR), ID).withColumn("before", ev.threshold_predict(F.col("score_a")))
    return scored.groupBy("before", rules.override(F.col("before"), mined).alias("after")).agg(F.count("*").alias("n_rows"))


def x03_pure_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the pure fraud leaves of a full tree over all engineered features, with their purity on the rows it was grown on."""
    learn = learning_rows(spark, sf_dir)
    return rules.purity(learn, rules.mine(learn, FEATURES, least_rows=2))


def x04_min_max_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = raw_split(spark, sf_dir)
    scaled = resample.min_max_scale(test, RAW_FEATURES, train)
    return scaled.select(ID, *[F.round(c, 6).alias(c) for c in RAW_FEATURES])


def x04_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample.label_encode(raw_split(spark, sf_dir)[1], "merchant_category", sorted(standin.EVENT_TYPES))
    return rows.select(ID, "merchant_category_code")


def s06_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest difference between the scores of a model and of the same model saved and loaded, for every kind of learner."""
    _, test = raw_split(spark, sf_dir)
    names = ["LogisticRegression", "RandomForest", "AdaBoost", "GradientBoosting", "SVC", "KNN", "GaussianNB", "MLPClassifier"]
    models = ensemble.member_models({n: BUDGETS[n] for n in names}, learning_rows(spark, sf_dir), FEATURES)
    path = scratch_path(spark, "artifacts")
    artifacts.save_models(models, path)
    before = ensemble.member_scores(models, engineered(test))
    after = ensemble.member_scores(artifacts.load_models(names, path), engineered(test))
    both = before.join(after.withColumnsRenamed({n: f"{n}_loaded" for n in names}), ID)
    pairs = [
        F.struct(
            F.lit(n).alias("model"),
            F.count(F.lit(1)).alias("n_rows"),
            F.max(F.abs(F.col(n) - F.col(f"{n}_loaded"))).alias("largest_difference"),
        )
        for n in names
    ]
    return both.agg(F.array(*pairs).alias("rows")).select(F.inline("rows"))


def x05_stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream scores next to batch scores of the same model."""
    _, test = raw_split(spark, sf_dir)
    name = "LogisticRegression"
    model = training.fit_final(training.learner(name), BUDGETS[name], learning_rows(spark, sf_dir), FEATURES)
    arrived = tables.write_table(test, scratch_path(spark, "arriving"))
    stream = scoring.score_stream(scoring.read_stream(spark, arrived), model, standin.EVENT_TYPES)
    path = scratch_path(spark, "scored")
    scoring.write_scores(stream, path, scratch_path(spark, "stream-state")).awaitTermination()
    batch = training.score_test(model, engineered(test)).withColumnRenamed("score", "batch_score")
    both = batch.join(spark.read.parquet(path).select(ID, "score"), ID, "full")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("score") - F.col("batch_score"))).alias("largest_difference")
    )


def learner_queries() -> dict[str, Query]:
    return {
        "s06_save_load_model": s06_save_load_model,
        "m04_cross_validate": m04_cross_validate,
        "f15_population_scaler": f15_population_scaler,
        "f16_matrix_positions": f16_matrix_positions,
        "m05_oof_predict": oof_of("RandomForest"),
        "m06_tune": m06_tune,
        "m07_fit_final": m07_fit_final,
        "m11_stack": m11_stack,
        "m15_feature_importance": m15_feature_importance,
        **{key: oof_of(name) for key, name in NUMBERED.items()},
        "m29_knn_join": m29_knn_join,
        "m29_knn_vote": m29_knn_vote,
        "m29_knn_join_all_features": m29_knn_join_all_features,
        "m29_knn_vote_all_features": m29_knn_vote_all_features,
        "m30_gaussian_nb": m30_gaussian_nb,
        "m05_oof_coverage": m05_oof_coverage,
        "m20_category_rate": m20_category_rate,
        "m22_single_split": m22_single_split,
        "m26_single_stump": m26_single_stump,
        "m27_single_round": m27_single_round,
        "m23_missing_side": m23_missing_side,
        "m25_symmetric_trees": m25_symmetric_trees,
        "m26_three_rounds": m26_three_rounds,
        "m27_two_rounds": m27_two_rounds,
        "x01_undersample": x01_undersample,
        "x02_smote": x02_smote,
        "x02_adasyn": x02_adasyn,
        "x02_smote_oof": x02_smote_oof,
        "x03_leaf_purity": x03_leaf_purity,
        "x03_rule_override": x03_rule_override,
        "x03_pure_rules": x03_pure_rules,
        "x04_min_max_scale": x04_min_max_scale,
        "x04_label_encode": x04_label_encode,
        "s06_round_trip": s06_round_trip,
        "x05_stream_equals_batch": x05_stream_equals_batch,
        "r01_run": r01_run,
        "x05_stream_scoring": x05_stream_scoring,
    }
