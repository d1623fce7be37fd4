"""Every operator as a named query over a directory of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions import features as fx
from cardwatch.operators import blend, distribution, encode, evaluate, folds, profile, quality
from cardwatch.operators import submission as sub
from cardwatch.registry.learner_queries import learner_queries
from cardwatch.registry.oracle import CORRELATED, ENGINEERED_SQL, FEATURES, LOG_THRESHOLDS, LOG_WEIGHTS, SCORES, TRIALS
from cardwatch.schema import BINARY, ID, LABEL, NUMERIC, RAW_COLUMNS, RAW_FEATURES, SPLIT, one_hot_names
from cardwatch.session import scratch_path
from cardwatch.sources import results_log, standin, tables

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a fixed number of digits, for comparison across engines; means keep ten (see the twins)."""
    return df.select(
        *[
            F.round(c, 10 if c.endswith("mean") else digits).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


# --- inputs -------------------------------------------------------------------------------------


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.transactions_table(spark, sf_dir)


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.train_rows(tx(spark, sf_dir))


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.test_rows(tx(spark, sf_dir))


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.engineer_features(tx(spark, sf_dir))


def engineered_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.engineer_features(train(spark, sf_dir))


def encoded(df: DataFrame) -> DataFrame:
    return encode.encode(encode.engineer_features(df), standin.EVENT_TYPES)


def preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.preprocess(train(spark, sf_dir), test(spark, sf_dir), standin.EVENT_TYPES)


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.scores(tx(spark, sf_dir))


def oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(spark, sf_dir).filter(F.col(SPLIT) == "train")


def long_of(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """Scores of one split, one row per model. The split is chosen first, so only its files are read."""
    wide = score_table(spark, sf_dir).filter(F.col(SPLIT) == split).drop(SPLIT)
    return evaluate.long_scores(wide, SCORES, [ID, LABEL])


def long_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_of(spark, sf_dir, "train")


def at_half() -> Column:
    return evaluate.threshold_predict(F.col("score"), 0.5)


def test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(spark, sf_dir).filter(F.col(SPLIT) == "test")


# --- sources and sinks --------------------------------------------------------------------------


def s01_read_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both splits through CSV and back, with the declared schema."""
    paths = {
        "train": tables.write_table(train(spark, sf_dir), scratch_path(spark, "train"), "csv"),
        "test": tables.write_table(test(spark, sf_dir), scratch_path(spark, "test"), "csv"),
    }
    read = [tables.read_transactions(spark, p, s, "csv") for s, p in paths.items()]
    return read[0].unionByName(read[1], allowMissingColumns=True).select(*RAW_COLUMNS, SPLIT, LABEL)


def s02_read_engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.write_table(
        preprocessed(spark, sf_dir), scratch_path(spark, "engineered"), partition_by=[SPLIT]
    )
    learn, score, ids = tables.read_engineered(spark, path)
    tagged_test = score.join(ids, ID, "left_semi").withColumn(SPLIT, F.lit("test"))
    both = learn.withColumn(SPLIT, F.lit("train")).unionByName(tagged_test, allowMissingColumns=True)
    return both.select(ID, SPLIT, *FEATURES, LABEL)


def s03_write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.write_table(tx(spark, sf_dir), scratch_path(spark, "transactions"), partition_by=[SPLIT])
    written = spark.read.parquet(path).groupBy(SPLIT)
    return rounded(
        written.agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount_sum"), F.sum(ID).alias("id_sum")
        )
    )


def log_results(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One result table per run: every model and the blend at the run's threshold."""
    names = [*SCORES, blend.ENSEMBLE_NAME]
    wide = oof(spark, sf_dir).withColumn(blend.ENSEMBLE_NAME, blend.weighted_blend(LOG_WEIGHTS))
    long = evaluate.long_scores(wide, names, [ID, LABEL])
    ap = evaluate.average_precision(long, ["model"])
    runs = []
    for seq, threshold in enumerate(LOG_THRESHOLDS):
        predicted = evaluate.threshold_predict(F.col("score"), threshold)
        metrics = evaluate.pooled_metrics(long, predicted, ["model"]).join(ap, "model")
        runs.append(
            metrics.select(
                F.lit(seq).alias("run_seq"),
                F.col("model").alias("Model_Name"),
                F.col("accuracy").alias("CV_Accuracy"),
                F.col("f1").alias("CV_F1_Score"),
                F.col("average_precision").alias("CV_PR_AUC"),
                F.col("precision").alias("CV_Precision"),
                F.col("recall").alias("CV_Recall"),
                F.lit(f"{{'threshold': {threshold}}}").alias("Best_Parameters"),
                F.concat(F.lit("models/"), F.lower("model")).alias("Model_File_Path"),
                F.concat(F.lit("outputs/"), F.lower("model")).alias("Output_Predictions_Path"),
            )
        )
    return runs


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_log.log_rows(reduce(DataFrame.unionByName, log_results(spark, sf_dir)))


def s05_append_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "results_log")
    for run in log_results(spark, sf_dir):
        results_log.append_results(run, path)
    return results_log.read_log(spark, path).select("run_seq", "Model_Name", *results_log.METRICS)


# --- composed inputs of single queries ----------------------------------------------------------


def distinct_of_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = train(spark, sf_dir)
    return distribution.distinct_counts(df, df.columns)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = encoded(train(spark, sf_dir)).select(*FEATURES, LABEL)
    return profile.feature_catalog(df, [*RAW_FEATURES, LABEL], distribution.distinct_counts(df, df.columns))


def importances_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute correlation of each raw feature with each score, as that score's importances: one scan, one aggregate."""
    wide = standin.with_scores(train(spark, sf_dir))
    pairs = [
        F.struct(F.lit(m).alias("model"), F.lit(c).alias("feature"), F.abs(profile.correlation(F.col(c), F.col(m))).alias("importance"))
        for m in SCORES
        for c in RAW_FEATURES
    ]
    return wide.agg(F.array(*pairs).alias("rows")).select(F.inline("rows"))


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = encoded(train(spark, sf_dir))
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame)
    values = vector_to_array("features")
    return assembled.select(
        ID,
        LABEL,
        F.size(values).alias("n_features"),
        F.round(F.aggregate(values, F.lit(0.0), lambda total, v: total + v), 6).alias("feature_sum"),
    )


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = encode.standard_scale(
        tx(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in NUMERIC}), NUMERIC, train(spark, sf_dir)
    )
    return rounded(z.select(ID, SPLIT, *NUMERIC))


def folded(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    return folds.stratified_folds(train(spark, sf_dir), k)


def folded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = folds.stratified_folds(oof(spark, sf_dir), 5)
    return evaluate.long_scores(wide, SCORES, [ID, "fold", LABEL])


def blended_submission(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    predicted = evaluate.threshold_predict(blend.weighted_blend(LOG_WEIGHTS), threshold)
    return sub.submission(test_scores(spark, sf_dir), predicted)


def sample_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return test(spark, sf_dir).select(ID, F.lit(0).alias(LABEL))


def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_sweep(long_oof(spark, sf_dir), ["model"])


def shape_of_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = quality.shape(train(spark, sf_dir)).select(F.lit("train").alias(SPLIT), "*")
    return a.unionByName(quality.shape(test(spark, sf_dir)).select(F.lit("test").alias(SPLIT), "*"))


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, score = encode.split_back(preprocessed(spark, sf_dir))
    return quality.engineered_gate(learn, score, standin.events(spark, sf_dir))


def single_feature(name: str) -> Query:
    return lambda s, d: tx(s, d).select(ID, fx.engineered_columns()[name].alias(name))


# --- the registry -------------------------------------------------------------------------------


def queries() -> dict[str, Query]:
    by_model = ["model"]
    registry: dict[str, Query] = {
        "s01_derive_transactions": standin.transactions,
        "s01_read_transactions": s01_read_transactions,
        "s02_read_engineered": s02_read_engineered,
        "s03_write_table": s03_write_table,
        "s04_id_sidecar": lambda s, d: tables.id_sidecar(test(s, d)),
        "s04_id_range": lambda s, d: tables.id_range(test(s, d)),
        "s05_append_result": s05_append_result,
        "q01_null_counts": lambda s, d: quality.null_counts(tx(s, d), RAW_COLUMNS, [SPLIT]),
        "q02_duplicate_rows": lambda s, d: quality.duplicate_rows(tx(s, d), [SPLIT]),
        "q03_duplicate_keys": lambda s, d: quality.duplicate_keys(tx(s, d), ID, [SPLIT]),
        "q04_id_overlap": lambda s, d: quality.id_overlap(train(s, d), test(s, d)),
        "q05_schema_match": lambda s, d: quality.schema_report(train(s, d), test(s, d)),
        "q06_domain_check": lambda s, d: quality.domain_check(tx(s, d), BINARY, [0, 1], [SPLIT]),
        "q07_edge_counts": lambda s, d: quality.edge_counts(tx(s, d), NUMERIC, [SPLIT]),
        "q08_shape": shape_of_splits,
        "q09_engineered_gate": gate,
        "q10_preview": lambda s, d: quality.preview(train(s, d), 5),
        "q10_column_info": lambda s, d: quality.column_info(train(s, d)),
        "p01_describe": lambda s, d: rounded(distribution.describe(train(s, d), [*RAW_FEATURES, LABEL])),
        "p02_value_counts": lambda s, d: profile.value_counts(train(s, d), "merchant_category"),
        "p03_value_shares": lambda s, d: rounded(profile.value_shares(train(s, d), LABEL)),
        "p04_n_unique": distinct_of_train,
        "p04_unique_values": lambda s, d: profile.unique_values(train(s, d), "merchant_category"),
        "p05_class_balance": lambda s, d: rounded(profile.class_balance(train(s, d))),
        "p06_rate_by_category": lambda s, d: rounded(profile.rate_by_category(train(s, d))),
        "p07_rate_by_hour": lambda s, d: rounded(
            profile.rate_by(train(s, d), ["transaction_hour"]).withColumn("is_night", fx.is_night())
        ),
        "p08_crosstab_counts": lambda s, d: profile.crosstab(train(s, d), ["transaction_hour"]),
        "p09_crosstab_row_pct": lambda s, d: rounded(
            profile.flag_row_pct(
                engineered_train(s, d), [*BINARY, "is_high_risk_location", "is_high_amount", "is_low_trust"]
            )
        ),
        "p10_crosstab2_margins": lambda s, d: profile.crosstab_margins(train(s, d), *BINARY),
        "p11_crosstab2_row_pct": lambda s, d: rounded(profile.row_pct(profile.crosstab(train(s, d), BINARY), BINARY)),
        "p12_interaction_grid": lambda s, d: rounded(profile.interaction_grid(train(s, d), *BINARY)),
        "p13_rate_by_trust_bin": lambda s, d: rounded(
            profile.rate_by_bin(
                train(s, d), "device_trust_score", profile.TRUST_EDGES, profile.TRUST_LABELS, "trust_bin"
            )
        ),
        "p14_rate_by_amount_bin": lambda s, d: rounded(
            profile.rate_by_bin(train(s, d), "amount", profile.AMOUNT_EDGES, profile.AMOUNT_LABELS, "amount_bin")
        ),
        "p15_rate_and_count_by_velocity": lambda s, d: rounded(profile.rate_by(train(s, d), ["velocity_last_24h"])),
        "p16_rate_by_location_score": lambda s, d: rounded(
            profile.rate_by(engineered_train(s, d), ["location_anomaly_score"])
        ),
        "p17_corr_matrix": lambda s, d: rounded(profile.correlation_matrix(encoded(train(s, d)), CORRELATED)),
        "p18_corr_with_target": lambda s, d: rounded(profile.correlation_with(encoded(train(s, d)), FEATURES)),
        "p18_top_correlations": lambda s, d: rounded(
            profile.strongest_correlations(profile.correlation_with(encoded(train(s, d)), FEATURES))
        ),
        "p19_iqr_outliers": lambda s, d: rounded(distribution.iqr_outliers(train(s, d), NUMERIC)),
        "p20_split_drift": lambda s, d: rounded(distribution.split_drift(tx(s, d), NUMERIC)),
        "p21_feature_ranges": lambda s, d: rounded(profile.feature_ranges(encoded(tx(s, d)), FEATURES)),
        "p22_grouped_feature_stats": lambda s, d: rounded(
            profile.feature_ranges(engineered_train(s, d), ["amount_to_trust_ratio", "amount_velocity_ratio"])
        ).select("feature", "mean", "std"),
        "p23_histogram_by_split": lambda s, d: rounded(
            distribution.histogram(tx(s, d), {c: 40 for c in NUMERIC}, SPLIT)
        ),
        "p23_histogram_by_class": lambda s, d: rounded(
            distribution.histogram(
                engineered_train(s, d),
                {"device_trust_score": 30, "amount": 50, "amount_to_trust_ratio": 40, "amount_velocity_ratio": 40},
                LABEL,
            )
        ),
        "p24_box_summary": lambda s, d: rounded(distribution.box_summary(train(s, d), NUMERIC, LABEL)),
        "p25_minority_plus_sample": lambda s, d: profile.minority_plus_sample(
            train(s, d), ["amount", "device_trust_score", "transaction_hour", "velocity_last_24h", LABEL]
        ),
        "p26_feature_catalog": catalog,
        "p27_category_counts_ordered": lambda s, d: profile.counts_in_order(
            engineered_train(s, d), "time_of_day_category"
        ),
    }
    registry |= {
        f"f{i:02d}_{name}": single_feature(name) for i, name in enumerate(ENGINEERED_SQL, start=1)
    }
    registry |= {
        "f09_one_hot": lambda s, d: encoded(tx(s, d)).select(ID, *one_hot_names(standin.EVENT_TYPES)),
        "f10_bool_to_int": lambda s, d: encode.bool_to_int(
            tx(s, d).select(
                ID, (F.col("amount") > 500).alias("dear"), (F.col("device_trust_score") < 40).alias("distrusted")
            )
        ),
        "f11_combine": lambda s, d: encode.combine(train(s, d), test(s, d)).select(*RAW_COLUMNS, SPLIT, LABEL),
        "f12_split_back_train": lambda s, d: encode.split_back(preprocessed(s, d))[0],
        "f12_split_back_test": lambda s, d: encode.split_back(preprocessed(s, d))[1],
        "f13_engineer_features": lambda s, d: engineered(s, d).drop(LABEL),
        "f14_preprocess": preprocessed,
        "f15_standard_scale": scaled,
        "f15_fold_scaler": lambda s, d: rounded(encode.fold_scaler(folded(s, d), NUMERIC, 5)),
        "f16_feature_matrix": feature_matrix,
        "m01_pos_weight": lambda s, d: rounded(folds.pos_weight(train(s, d))),
        "m02_balanced_weights": lambda s, d: rounded(folds.balanced_weights(train(s, d)).select(ID, "weight")),
        "m03_stratified_folds": lambda s, d: folded(s, d).select(ID, LABEL, "fold"),
        "m04_fold_metrics": lambda s, d: rounded(
            evaluate.fold_mean_metrics(folded_scores(s, d), at_half(), by_model), 9
        ),
        "m08_weighted_blend": lambda s, d: rounded(
            score_table(s, d).select(ID, blend.weighted_blend(LOG_WEIGHTS).alias("blend"))
        ),
        "m09_search_weights": lambda s, d: rounded(blend.search_weights(oof(s, d), SCORES, TRIALS)),
        "m09_best_weights": lambda s, d: rounded(blend.best_trial(blend.search_weights(oof(s, d), SCORES, TRIALS))),
        "m10_soft_vote": lambda s, d: rounded(blend.soft_vote(test_scores(s, d), LOG_WEIGHTS)),
        "m12_pick_top_models": lambda s, d: blend.pick_top_models(results(s, d), 2),
        "m13_leaderboard": lambda s, d: blend.leaderboard(results(s, d)),
        "m14_select_final": lambda s, d: blend.select_final(
            oof(s, d), test_scores(s, d), blend.weighted_blend(LOG_WEIGHTS), F.col("score_a")
        ),
        "m16_importance_consensus": lambda s, d: rounded(blend.importance_consensus(importances_by_score(s, d))),
        "e01_threshold_predict": lambda s, d: score_table(s, d).select(
            ID,
            evaluate.threshold_predict(F.col("score_a")).alias("at_least"),
            evaluate.threshold_predict(F.col("score_a"), mode="above").alias("above"),
        ),
        "e02_confusion_matrix": lambda s, d: evaluate.confusion_matrix(long_oof(s, d), at_half(), by_model),
        "e03_pooled_metrics": lambda s, d: rounded(evaluate.pooled_metrics(long_oof(s, d), at_half(), by_model)),
        "e04_classification_report": lambda s, d: rounded(
            evaluate.classification_report(long_oof(s, d), at_half(), by_model)
        ),
        "e05_roc_points": lambda s, d: rounded(evaluate.roc_points(long_oof(s, d), by_model)),
        "e05_roc_corners": lambda s, d: rounded(evaluate.roc_points(long_oof(s, d), by_model, drop_collinear=True)),
        "e06_roc_auc": lambda s, d: rounded(evaluate.roc_auc(long_oof(s, d), by_model)),
        "e07_pr_points": lambda s, d: rounded(evaluate.pr_points(long_oof(s, d), by_model)),
        "e08_average_precision": lambda s, d: rounded(evaluate.average_precision(long_oof(s, d), by_model)),
        "e09_prevalence_baseline": lambda s, d: rounded(evaluate.prevalence_baseline(tx(s, d), [SPLIT])),
        "e10_threshold_sweep": lambda s, d: rounded(sweep(s, d)),
        "e11_best_threshold": lambda s, d: rounded(evaluate.best_threshold(sweep(s, d), by_model)),
        "e12_threshold_at": lambda s, d: rounded(evaluate.threshold_at(sweep(s, d), by_model, [0.5, 0.3])),
        "e13_strategy_table": lambda s, d: rounded(evaluate.strategy_table(long_oof(s, d), by_model)),
        "e14_prediction_summary": lambda s, d: rounded(
            evaluate.prediction_summary(long_of(s, d, "test"), by_model, [0.5, 0.3])
        ),
        "e15_submission": blended_submission,
        "e15_submission_aggressive": lambda s, d: blended_submission(s, d, 0.3),
        "e16_validate_submission": lambda s, d: sub.validate_submission(
            blended_submission(s, d), sample_submission(s, d)
        ),
    }
    return registry | learner_queries()
