"""The corpus pipeline: stages that each read what their predecessor kept, each over one operator of ``cardwatch.llm``."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from cardwatch.llm import exact_dedup, near_dups, packing, personal, quality_rules  # noqa: E402
from cardwatch.llm.shared import documents, write_once  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("personal data", private),
    ("packing", pack),
]

# Signatures, anchored parsing and packing are not expressible in SQL; tests/llm checks the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each on the written result of the one before."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
