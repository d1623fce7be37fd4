"""Exact dedup, quality rules and licence scan on awkward rows; their queries against SQL."""

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import exact_dedup, license_scan, oracle, quality_rules
from cardwatch.llm.queries import queries
from check import compare, connect

SQL = oracle.oracle_sql()
SCHEMA = "doc_id long, text string, digest string, run int, quality string, license string, best string, __words string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", None, "z", "w") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small, name):
    assert compare(queries()[name](spark, small), connect(small), SQL[name]) == []


def test_exact_groups(spark):
    rows = [(1, "Ab\nÉ"), (7, "aB\nÉ"), (3, "ab\né"), (None, "ab\né"), (5, None), (4, ""), (9, "x"), (9, "X"), (9, "x")]
    found = exact_dedup.exact_duplicates(table(spark, rows).repartition(5), fan_in=2).collect()
    assert len(found) == len(rows)
    groups = {}
    for r in found:
        groups.setdefault(bytes(r["digest"]), []).append(r)
    seen = sorted(
        (sorted((r["doc_id"] or 0) for r in g), g[0]["keep_id"], g[0]["group_size"], sum(r["kept"] for r in g))
        for g in groups.values()
    )
    assert seen == [([0, 3], 3, 2, 1), ([1, 7], 7, 2, 1), ([4, 5], 5, 2, 1), ([9, 9, 9], 9, 3, 1)]
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    smallest = exact_dedup.exact_duplicates(table(spark, rows), keep="smallest")
    assert sorted(r["keep_id"] for r in smallest.filter("kept").collect()) == [1, 3, 4, 9]


def test_exact_hot_group_over_many_runs(spark):
    docs = spark.range(0, 3000, numPartitions=40).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "Copy").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup.exact_duplicates(docs, fan_in=3)
    assert found.filter("group_size = 2000 AND keep_id = 2998").count() == 2000
    assert found.filter("kept").count() == 1001


def test_exact_drop_keeps_rows_and_columns(spark):
    docs = table(spark, [(1, "a"), (2, "A"), (2, "a"), (3, None), (None, "")])
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert exact_dedup.drop_duplicates(table(spark, [])).count() == 0


def repeat_words(words):
    windows = list(zip(words, words[1:], words[2:]))
    again = {w for w in windows if windows.count(w) > 1}
    return len({i + k for i, w in enumerate(windows) if w in again for k in range(3)})


def test_quality_counts(spark):
    texts = [
        None,
        "",
        " \n\t ",
        "a b c a b c a",
        "a a a a",
        "x y",
        "one two three four one two three four five one two three",
        "É# $é\x0bq|z\n\nÉ# $é\x0bq|z\n \n",
        "the word goes on and on " * 30,
        "w " * 5000,
        "of all things a text should have " + " ".join(f"w{i}" for i in range(60)),
    ]
    judged = quality_rules.judge(table(spark, enumerate(texts)))
    assert sorted(judged.columns) == sorted(table(spark, []).columns)
    for r in judged.collect():
        text, q = texts[r["doc_id"]] or "", r["quality"]
        words = [w for w in text.replace("\n", " ").replace("\t", " ").replace("\x0b", " ").split(" ") if w]
        lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
        assert q["n_words"] == len(words) and q["word_chars"] == sum(map(len, words))
        assert q["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert q["n_dup_lines"] == len(lines) - len(set(lines)) and q["n_lines"] == len(lines)
        assert q["n_repeat_words"] == repeat_words(words)
        assert q["base_failed"] == (len(words) < 50 or 100 * q["n_repeat_words"] > 50 * len(words))
        assert q["kept"] == (not q["failed"])
    kept = quality_rules.keep_good(table(spark, enumerate(texts)))
    assert [r["doc_id"] for r in kept.collect()] == [10] and len(kept.columns) == 8
    assert quality_rules.keep_good(table(spark, [])).count() == 0


def test_threshold_ties_pass():
    assert [r.compare for r in quality_rules.RATIO_RULES].count("<") == 2


def test_license_places(spark):
    texts = [
        None,
        "",
        "Under the MIT License. Under THE mit-license!",
        "apache license, version 2.0 / APACHE LICENSE VERSION 2",
        "cc by nc cc by nc cc by",
        "license mit the under",
        "Redistribution and use in source and binary forms, with or without",
        "under the mit licenseé",
        "cc by",
        "under " * 3000 + "under the mit license",
    ]
    found = {r["doc_id"]: r["license"] for r in license_scan.scan_licenses(table(spark, enumerate(texts))).collect()}
    starts = lambda n: sorted((p["label"], p["start"]) for p in found[n]["places"])
    assert [found[n]["n_words"] for n in range(3)] == [0, 0, 8]
    assert starts(2) == [("mit", 0), ("mit", 4)]
    assert starts(3) == [("apache-2", 0), ("apache-2", 5)]
    assert starts(4) == [("cc-by-nc", 0), ("cc-by-nc", 3)]
    assert starts(6) == [("bsd", 0)] and 0.5 < found[6]["places"][0]["score"] < 1
    assert starts(9) == [("mit", 3000)]
    assert all(starts(n) == [] for n in (0, 1, 5, 7, 8))
    assert license_scan.scan_licenses(table(spark, [])).count() == 0


def test_anchor_is_the_rarest_word():
    counts = dict.fromkeys({w for t in license_scan.TEMPLATES for w in t.key.split()}, 5) | {"mit": 900, "license": 2}
    index = license_scan.rare_index(counts)
    assert [p.anchor_at for p in index["license"] if p.template.label == "mit"] == [3]
