"""Near duplicates against all pairs; signatures against their law; components against a plain union."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cardwatch.llm import near_dups
from cardwatch.llm.components import components
from cardwatch.llm.queries import op6_minhash_near_dups
from cardwatch.llm.spans import chunks

SCHEMA = "doc_id long, text string, uid string, size string, root string, bucket string"


def shingles(text):
    words = [w.lower() for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def all_pairs(texts):
    """Class of each index by comparing every pair."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def classes(rows, key="doc_id"):
    groups = {}
    for r in rows:
        groups.setdefault(r["class_id"], []).append(r[key])
    return sorted(sorted(g) for g in groups.values())


def wanted(ids, texts):
    groups = {}
    for i, root in zip(ids, all_pairs(texts)):
        groups.setdefault(root, []).append(i)
    return sorted(sorted(g) for g in groups.values())


def test_op6_equals_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = op6_minhash_near_dups(spark, small).collect()
    assert classes(rows) == wanted([r["doc_id"] for r in docs], [r["text"] for r in docs])
    assert sum(r["kept"] for r in rows) == len({r["class_id"] for r in rows})
    assert all(r["doc_id"] == r["class_id"] for r in rows if r["kept"])


@pytest.mark.parametrize("block", [near_dups.BLOCK, 7])
def test_mixed_buckets_lose_no_link(spark, monkeypatch, block):
    """Texts around a shared passage, similar to their leader at all degrees; chains of edits; a large group of copies."""
    monkeypatch.setattr(near_dups, "BLOCK", block)
    pick = random.Random(4)
    word = lambda: f"w{pick.randint(0, 10**6)}"
    passage = [word() for _ in range(60)]
    texts = [" ".join(passage + [word() for _ in range(n)]) for n in range(2, 26) for _ in range(3)]
    chain = [word() for _ in range(80)]
    for _ in range(25):
        chain = chain[3:] + [word() for _ in range(3)]
        texts.append(" ".join(chain))
    original = [word() for _ in range(100)]
    for _ in range(60):
        copy = list(original)
        copy[pick.randrange(100)] = word()
        texts.append(" ".join(copy))
    pick.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "u", "s", "r", "b") for i, t in enumerate(texts)], SCHEMA).repartition(6, "doc_id")
    assert classes(near_dups.near_duplicates(docs).collect()) == wanted(range(len(texts)), texts)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "b a"), (None, "a\tb"), (8, "x " * 60_000), (8, "x " * 60_000)]
    docs = spark.createDataFrame([(i, t, "u", "s", "r", "b") for i, t in rows], SCHEMA)
    found = near_dups.near_duplicates(docs).collect()
    assert len(found) == len(rows) and sum(r["kept"] for r in found) == 6
    assert sorted((r["class_id"], r["class_size"]) for r in found) == sorted(
        [(1, 1), (2, 1), (3, 1), (4, 3), (4, 3), (4, 3), (6, 1), (8, 2), (8, 2)]
    )
    kept = near_dups.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 8]
    assert near_dups.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_agree_as_often_as_weights_do():
    pick = np.random.default_rng(1)
    names = pick.integers(0, 2**63, 300).astype(np.uint64)
    a, b = pick.integers(0, 4, 300), pick.integers(0, 4, 300)
    one, two = (near_dups.dart_signatures(names[w > 0], w[w > 0], np.array([0, (w > 0).sum()]), 4000)[0] for w in (a, b))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((one == two).mean() - want) < 0.04


def test_a_text_alone_or_among_others_has_one_signature():
    texts = ["the quick brown fox jumps over the lazy dog", "a", "b " * 500]
    together = [near_dups.shingle_sets(c) for c in chunks(pa.array(texts))]
    signs = np.vstack([near_dups.dart_signatures(s, np.ones_like(c), b, 96) for s, c, b in together])
    for n, t in enumerate(texts):
        (own,) = [near_dups.shingle_sets(c) for c in chunks(pa.array([t]))]
        assert (near_dups.dart_signatures(own[0], np.ones_like(own[1]), own[2], 96) == signs[n]).all()


def test_components(spark):
    pick = random.Random(9)
    links = [(pick.randint(0, 80), pick.randint(0, 80)) for _ in range(55)] + [(200, n) for n in range(201, 260)]
    links += [(n, n + 1) for n in range(300, 340)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = {n: n for e in links for n in e}
    for _ in root:
        for u, v in links:
            root[u] = root[v] = min(root[u], root[v])
    assert got == {n: root[n] for u, v in links if u != v for n in (u, v)}
