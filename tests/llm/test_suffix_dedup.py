"""Removed passages against a count of all strings; the index against a dictionary."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cardwatch.llm import suffix_dedup
from cardwatch.llm.log_index import Entries, LogIndex
from cardwatch.llm.queries import op7_suffix_dedup

SCHEMA = "doc_id long, text string, uid string, runs string, removed string, kept string"


def by_counting(texts, length):
    """(n_removed, n_spans, kept) of each text by counting every string of ``length`` bytes."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), kept))
    return out


def found(spark, texts, length, gram):
    docs = spark.createDataFrame([(i, t, "u", "r", "x", "k") for i, t in enumerate(texts)], SCHEMA).repartition(4, "doc_id")
    rows = sorted(suffix_dedup.remove_repeats(docs, length=length, gram=gram).collect())
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert [r["n_bytes"] for r in rows] == [len((t or "").encode()) for t in texts]
    return [(sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])) for r in rows]


@pytest.mark.parametrize("chunk", [suffix_dedup._CHUNK, 300])
@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", chunk)
    pick = random.Random(seed)
    word = lambda n: "".join(pick.choices("abcdeé ", k=n))
    shared = [word(pick.randint(15, 90)) for _ in range(6)]
    texts = [None, "", "a" * 19, "a" * 20, "a" * 21, "ab" * 70, "é" * 30]
    for _ in range(60):
        parts = [word(pick.randint(0, 40)) for _ in range(4)]
        for k in range(3):
            s = pick.choice(shared)
            parts.insert(k * 2, s[pick.randint(0, 20) :] if pick.random() < 0.5 else s[: pick.randint(10, 90)])
        texts.append("".join(parts))
    texts += texts[-3:]
    assert found(spark, texts, 20, 8) == by_counting(texts, 20)


def test_periodic_text(spark):
    texts = ["x" * 500, "abc" * 300, "abc" * 100 + "d" + "abc" * 90, "y" * 39, "nothing else here"]
    assert found(spark, texts, 40, 12) == by_counting(texts, 40)


def test_op7(spark, small):
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    rows = sorted(op7_suffix_dedup(spark, small).collect())
    want = by_counting([r["text"] for r in docs], 200)
    assert [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == [
        (d["doc_id"], len(d["text"].encode()), n, s, hashlib.sha256(k).hexdigest()) for d, (n, s, k) in zip(docs, want)
    ]
    assert sum(n for n, _, _ in want) > 0


def test_empty_table(spark):
    assert found(spark, [], 200, 64) == []


def test_index_reports_every_entry_with_a_partner():
    pick = random.Random(1)
    index, rows, like, unlike = LogIndex(), [], set(), set()
    for step in range(60):
        batch = [(pick.randint(0, 400), pick.randint(0, 2), step * 100 + k) for k in range(pick.randint(0, 30))]
        rows += batch
        key, body, uid = (np.array([r[i] for r in batch], np.int64) for i in range(3))
        one = np.ones(len(batch), np.int64)
        told = index.add(Entries(key.astype(np.uint64), body.astype(np.uint64), uid, 0 * one, one, np.zeros(len(batch), np.int8)))
        like |= set(told[0].uid.tolist())
        unlike |= set(told[1].uid.tolist())
        sizes = [level.size for level in index.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    pairs = Counter(r[:2] for r in rows)
    bodies = {k: len({b for q, b, _ in rows if q == k}) for k, _, _ in rows}
    for k, b, uid in rows:
        # With one body all partners are found at once; with several, each row is either reported or has its like there.
        if bodies[k] == 1:
            assert (uid in like) == (pairs[k, b] > 1) and uid not in unlike
        else:
            assert uid in like | unlike
            assert any(u in unlike for q, c, u in rows if (q, c) == (k, b))
