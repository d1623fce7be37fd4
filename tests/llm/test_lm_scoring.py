"""Backoff scores against a plain count, document by document. The whole query is checked against SQL in test_tables."""

import math
import random
from collections import Counter

import pytest

from cardwatch.llm import lm_scoring

SCHEMA = "doc_id long, text string, chunk long, n string, score string, totals string"


def plain(texts, order):
    words = [(t or "").lower().split(" ") if t else [] for t in texts]
    words = [[w for w in ws if w] for ws in words]
    own = [Counter(tuple(ws[i : i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1)) for ws in words]
    every = sum(own, Counter())
    total, out = sum(map(len, words)), []
    for ws, mine in zip(words, own):
        logs = 0
        for i in range(len(ws)):
            factor, n = 1.0, min(order, i + 1)
            while n > 1 and not every[tuple(ws[i - n + 1 : i + 1])] - mine[tuple(ws[i - n + 1 : i + 1])]:
                factor, n = factor * lm_scoring.BACKOFF, n - 1
            gram, rest = tuple(ws[i - n + 1 : i + 1]), total - len(ws)
            count = every[gram] - mine[gram]
            before = every[gram[:-1]] - mine[gram[:-1]] if n > 1 else rest
            logs += math.log(factor * (count / before if count else 1 / (rest + 1)))
        out.append(logs / len(ws) if ws else None)
    return out


@pytest.mark.parametrize("order", [1, 3, 4])
def test_scores(spark, monkeypatch, order):
    monkeypatch.setattr(lm_scoring, "_CHUNK", 400)
    pick = random.Random(order)
    texts = [None, "", "  ", "alone", "The the THE the"] + [
        " ".join(pick.choices(["the", "of", "and", "A", "a", "cat", "dog", f"w{k}", "é"], k=pick.randint(1, 60))) for k in range(50)
    ]
    texts += [texts[-1], "x " * 40_000]
    docs = spark.createDataFrame([(i, t, 1, "n", "s", "t") for i, t in enumerate(texts)], SCHEMA).repartition(3, "doc_id")
    rows = sorted(lm_scoring.score(docs, order=order).collect())
    want = plain(texts, order)
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    for r, w in zip(rows, want):
        assert (r["score"] is None) == (w is None) and abs((r["score"] or 0) - (w or 0)) < 1e-5
        assert sum(r["n_by_order"]) == r["n_words"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lm_scoring.score(docs).count() == 0
    nothing = spark.createDataFrame([(1, None, 1, "n", "s", "t")], SCHEMA)
    assert [r["n_words"] for r in lm_scoring.score(nothing).collect()] == [0]
