"""The named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import (
    bpe,
    exact_dedup,
    filter_audit,
    importance,
    language,
    license_scan,
    lm_scoring,
    near_dups,
    packing,
    personal,
    quality_rules,
    suffix_dedup,
    url_filter,
)
from cardwatch.llm.shared import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(documents(spark, sf_dir).select("doc_id", "text"))
    line = lambda p: F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, line), ",")
    of_kind = lambda kind: F.size(F.filter("personal", lambda p: p["kind"] == kind)).cast("long")
    base = F.filter("personal", lambda p: p["kind"].isin(*personal.BASE_KINDS))
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in personal.BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("personal")).alias("spans"),
        F.size("personal").cast("long").alias("n_spans"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(documents(spark, sf_dir))
    by_order = [F.get("n_by_order", n).alias(f"n_{n + 1}grams") for n in range(lm_scoring.ORDER)]
    return scored.select("doc_id", "n_words", *by_order, "n_unseen", "score")


#: At most this many labelled documents of each language train the language model.
LANGUAGE_SAMPLE = 400


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    labelled = docs.filter(~language.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = language.bounded_sample(labelled, LANGUAGE_SAMPLE, id_col="doc_id", lang_col="lang")
    texts = docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language.predict(texts, language.fit(sample)).drop("text")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(documents(spark, sf_dir), ranks=ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_duplicates(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "kept")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir).select("doc_id", "text"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in columns])


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("license.places", lambda p: p["base"])
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(F.col("base"), lambda p: p["start"])
    return scanned.select("doc_id", "license", base.alias("base")).select(
        "doc_id",
        F.col("license.n_words").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.col("license.places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("license.places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Query]:
    return {
        "op1_personal_data": op1_personal_data,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_language_id": op3_language_id,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_minhash_near_dups": op6_minhash_near_dups,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_license_scan": op9_license_scan,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_url_filter": op12_url_filter,
        "op13_filter_audit": op13_filter_audit,
    }
