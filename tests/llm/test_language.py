"""Language identification: frozen code lengths against a plain tree walk, and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cardwatch.llm import language
from cardwatch.llm.queries import op3_language_id

SAMPLES = {"de": ["Der Hund und die Katze.", "Das Haus, das"], "en": ["The dog and the cat.", "the house", "thé"]}
SCHEMA = "doc_id long, text string, lang string, score string, __row string"


def fitted(spark, least=1):
    rows = [(n, t, lang, "s", "r") for lang, texts in SAMPLES.items() for n, t in enumerate(texts)]
    rows += [(7, None, "en", "s", "r"), (8, "x", None, "s", "r")]
    return language.fit(spark.createDataFrame(rows, SCHEMA), least_context=least)


def walk(sample, text):
    """Bits for ``text`` by walking down from the longest context, byte by byte."""
    lead = b"\n\n\n"
    trees = [Counter() for _ in range(4)]
    for t in sample:
        raw = lead + t.encode().lower()
        for i in range(3, len(raw)):
            for k in range(4):
                trees[k][raw[i - k : i], raw[i]] += 1
    bits, raw = 0.0, lead + text.encode().lower()
    for i in range(3, len(raw)):
        out = set()
        for k in (3, 2, 1, 0):
            here = {b: n for (c, b), n in trees[k].items() if c == raw[i - k : i] and b not in out}
            if not here:
                continue
            whole = sum(here.values()) + len(here)
            if raw[i] in here:
                bits -= math.log2(here[raw[i]] / whole)
                break
            bits -= math.log2(len(here) / whole)
            out |= set(here)
        else:
            bits += math.log2(256 - len(out))
    return bits


def test_code_lengths_equal_a_tree_walk(spark):
    model = fitted(spark)
    pick = random.Random(2)
    texts = ["", "the cat", "Der Hund", "zzz!", "éÉ漢", *["".join(pick.choices("the dogaudsk. é\n", k=30)) for _ in range(40)]]
    got = model.code_lengths(pa.array(texts))
    assert model.languages == ["de", "en"]
    for row, text in zip(got, texts):
        for k, lang in enumerate(model.languages):
            assert abs(row[k] / language.UNIT - walk(SAMPLES[lang], text)) < 0.002 * len(text.encode()) + 1e-9


def test_code_lengths_are_those_of_a_distribution(spark):
    model = fitted(spark, least=2)
    shares = np.exp2(-model.length.reshape(-1, model.symbols, 2).astype(float) / language.UNIT)
    known = (model.symbols - 1) + 0 * shares[:, 0]
    total = shares[:, 1:].sum(axis=1) + (256 - known) * shares[:, 0]
    assert np.allclose(total, 1, atol=0.01)


def test_awkward_rows(spark):
    texts = [None, "", "123 !?", "the", "der " * 60_000, "the", "漢"]
    docs = spark.createDataFrame([(n, t, "x", "s", "r") for n, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: r for r in language.predict(docs, fitted(spark)).collect()}
    assert [found[n]["lang_pred"] for n in range(6)] == ["und", "und", "und", "en", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[0]["score"] == 0
    assert set(found[0].asDict()) == {*docs.columns, "lang_pred"}
    assert language.predict(docs.limit(0), fitted(spark)).count() == 0
    nothing = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}


def test_sample_is_bounded_and_fixed(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 'b', 'a') AS lang")
    sample = language.bounded_sample(docs, 50, id_col="doc_id", lang_col="lang")
    assert {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == {"a": 50, "b": 50}
    again = language.bounded_sample(docs.repartition(7), 50, id_col="doc_id", lang_col="lang")
    assert sorted(sample.collect()) == sorted(again.collect())


@pytest.mark.parametrize("fold", [True, False])
def test_op3_accuracy(spark, small, fold):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op3_language_id(spark, small).collect()
    assert len(rows) == len(docs)
    own = [r for r in rows if r["held_out"] == fold and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in own)
    assert right >= 0.97 * len(own)
