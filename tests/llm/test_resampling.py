"""Importance resampling, URL filters and the filter audit: queries against SQL, and awkward tables against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import filter_audit, importance, oracle, shared, url_filter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EXTRA = "source string, digest string, n long, line string, key string, uid string, rank string"


def docs_table(spark, rows):
    """(doc_id, text) rows with other columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", "x", 1, "l", "k", "u", "r") for i, t in rows], f"doc_id long, text string, {EXTRA}")


# --- importance resampling --------------------------------------------------------------------------


def runs_of(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def plain_resample(rows, target, buckets, percent, min_words=20):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs_of(text)[0]))
    for text in target:
        t.update(map(bucket, runs_of(text)[0]))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)
    }
    out = []
    for doc_id, text in rows:
        runs, n_words = runs_of(text)
        weight = sum(gain[bucket(r)] for r in runs)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n_words, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, [r[0] for r in fit[: percent * len(fit) // 100]]


def awkward_texts():
    pick = random.Random(5)
    words = ["alpha", "Beta", "γάμμα", "x1", "日本語", "e", "f" * 70, "the", "of"]
    texts = [None, "", "\n\n\n", "one", "one\ntwo", "a\nb\nc\nd", "A B\n\nC", "...", "tail\n", "\nhead", "w" * 5000, "x y " * 3000]
    for _ in range(60):
        texts.append("".join(pick.choice(words) + pick.choice([" ", "\n", ", ", " \n\n"]) for _ in range(pick.randint(1, 60))))
    texts += texts[20:40]
    return texts


def test_resampling_on_awkward_rows(spark):
    texts = awkward_texts()
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(7000, texts[30])] * 3
    target = ["the of the\nalpha", None, "x1 x1"]
    aim = spark.createDataFrame([(t, "a", 1) for t in target], "text string, uid string, n int")
    found = importance.resample(docs_table(spark, rows).repartition(5), aim, buckets=97, percent=30).collect()
    expected, drawn = plain_resample(rows, target, 97, 30)
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in found), key=key) == sorted(expected, key=key)
    ranked = sorted((r["rank"], r["doc_id"]) for r in found if r["rank"] is not None)
    assert [r for r, _ in ranked] == list(range(1, len(drawn) + 1)) and [i for _, i in ranked] == drawn


def test_resampling_of_nothing(spark):
    empty = docs_table(spark, [])
    assert importance.resample(empty, empty).count() == 0
    some = importance.resample(docs_table(spark, [(1, "a b"), (2, None)]), empty).orderBy("doc_id").collect()
    assert [(r["n_features"], r["rank"]) for r in some] == [(3, None), (0, None)]


def test_a_line_in_every_document(spark):
    docs = spark.range(0, 4000, numPartitions=13).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the same line\n"), F.col("id") % 50, F.lit(" word\n" * 20)).alias("text")
    )
    found = importance.resample(docs, docs.limit(5))
    assert found.filter("n_words = 24 AND n_features = 69").count() == 4000
    assert found.filter("rank IS NOT NULL").agg(F.max("rank")).first()[0] == 200


def test_hot_keys_are_dealt(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("u"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    facts = counts.select("k", (F.col("k") * 2).alias("twice"))
    hot = shared.hot_keys(counts, "k")
    assert hot.collect() == [(-1, 334)]
    assert shared.dealt(rows, hot, "k", "u").filter("k = -1").groupBy("__slice").count().agg(F.max("count")).first()[0] < 40
    met = shared.join_by_key(rows, facts, "k", counts, spread_by="u")
    assert met.count() == 9000 and met.filter("twice <> 2 * k").count() == 0


# --- URL filters ------------------------------------------------------------------------------------


def page(*targets):
    return "<p>" + "".join(f'<a class=x href="{t}">t</a>' for t in targets) + "</p>"


URLS = [
    "http://a.example.net/en/1", "https://A.Example.NET/fr/2?x#y", "http://net/", "http://net", "http://x.net:80/en/", "ftp://example.com/de/q",
    "http://b.example.com/de/", "http://b.example.com/de", "http://c.org/fr/", "http://c.org/fr", "http://org/fr/x", "http://notexample.net/en/",
    "no scheme", "", None, "x://y://net/en/", "http://?q=/de/", "//d.org/fr/", "http://d.org#/fr/", "http://hub.com/1", "HTTP://HUB.com/2\nz",
]


def graph_rows():
    pick = random.Random(2)
    hosts = [f"h{i}.com" for i in range(30)] + ["good.example.net", "bad.net", "w.example.com"]
    rows = [(i, u, page("/rel", "#x", u or "")) for i, u in enumerate(URLS)]
    for i, h in enumerate(hosts * 3):
        path = {"good.example.net": "/en/1", "bad.net": "/x", "w.example.com": "/de/1"}.get(h, f"/{i}")
        near = pick.sample(hosts[max(0, i % 33 - 4) : i % 33 + 5], 3)
        rows.append((100 + i, f"http://{h}{path}", page(*[f"https://{n.upper()}/z?u" for n in near], f"//{pick.choice(hosts)}/p", "rel")))
    rows += [(400, "http://h3.com/q", None), (None, "http://h4.com/", ""), (401, "http://h5.com/", "<a href=http://bad.net/x>b</a>")]
    return rows + rows[30:36]


def test_urls_against_sql(spark):
    rows = graph_rows()
    pages = spark.createDataFrame([(*r, "c", 1, "d") for r in rows], "page_id long, url string, html string, host string, n int, trust string")
    found = url_filter.judge_urls(pages.repartition(4))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    theirs = con.execute(oracle.oracle_sql()["op12_url_filter"]).fetchall()
    mine = [tuple(r) for r in found.select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(mine, key=str) == sorted(theirs, key=str)
    verdicts = {r["host"]: r["verdict"] for r in found.collect() if r["rule"] is None}
    assert {verdicts[f"h{i}.com"] for i in range(30)} == {"allow", "block"} and verdicts[""] == "allow"
    assert found.filter("trust > 0 AND distrust > 0").count() > 0


def test_rules_of_urls(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judge_urls(pages).collect()}
    assert found[1] == ("a.example.net", "/fr/2", "net/") and found[0][2] == "example.net/en/"
    assert found[2][2] == "net/" and found[3] == ("net", "", None) and found[4] == ("x.net:80", "/en/", None)
    assert found[6][2] == "example.com/de/" and found[7][2] is None and found[10][2] == "org/fr/" and found[11][2] == "net/"
    assert found[12][:2] == found[13][:2] == found[14][:2] == ("", "") and found[15] == ("y:", "//net/en/", None)
    assert found[16] == ("", "", None) and found[17] == ("", "", None) and found[18] == ("d.org", "", None)


def test_distrust_flows_against_links(spark):
    hosts = spark.createDataFrame([("seed", False, True), ("good", True, False), ("a", False, False)], "host string, trusted boolean, blocked boolean")
    edges = spark.createDataFrame([("linker", "seed", 3), ("seed", "victim", 1), ("good", "victim", 1), ("good", "a", 3)], "source string, target string, n long")
    found = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(hosts, edges).collect()}
    unit = url_filter.UNIT
    assert found["linker"] == (0, unit * 15 // 100 * 85 // 300 * 3) and found["victim"][1] == 0
    assert found["a"][0] == 3 * found["victim"][0] > 0


def test_urls_of_nothing(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- filter audit -----------------------------------------------------------------------------------


def plain_masks(rows):
    smallest = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    out = []
    for doc_id, source, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = (
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            doc_id is not None and doc_id > smallest[text],
        )
        out.append((doc_id, source or "", {f for f, failed in zip("ABCDE", fails) if failed}))
    return out


def plain_audit(rows, labels):
    masks, out = plain_masks(rows), []
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    shapley = Counter()
    for part in {m[1] for m in masks}:
        own = [(i, f) for i, p, f in masks if p == part]
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                before = set(order[: step - 1])
                left = [(i, f) for i, f in own if not f & before]
                gone = [i for i, f in left if name in f]
                shapley[part, name] += len(gone)
                out.append([
                    part, order, step, len(left) - len(gone), len(gone), sum(name in f and bool(f & before) for _, f in own),
                    sum(f == {name} for _, f in own), sum(i in good for i in gone), sum(i in toxic for i in gone),
                ])
    return sorted([*r, shapley[r[0], r[1][r[2] - 1]]] for r in out)


def audit_rows():
    pick = random.Random(8)
    words = ["a", "B", "c#", "dé", "日", "E\u00a0f", "g\x0bh", "word"] + [f"w{i}" for i in range(200)]
    texts = [None, "", " ", "A" * 50, "same " * 60, "x" * 40_000] + [
        " ".join(pick.choices(words[pick.choice([0, 8]) :], k=pick.randint(1, 120))) for _ in range(40)
    ]
    texts += ["shared prefix " * 100 + str(i) for i in range(30)] + [texts[10][:-1], texts[10][:3]]
    rows = [(i, pick.choice(["a", "b", "b", None, ""]), pick.choice(texts)) for i in range(300)]
    return rows + [(None, "a", texts[3]), (None, "b", texts[3]), (3, "c", texts[9]), (3, "c", texts[9]), (500, "c", texts[9])]


LABELS = [(i, i % 2, (i // 2) % 2) for i in range(0, 290)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1), (8, None, None)]


@pytest.mark.parametrize("flush, most, tasks", [(16 << 20, 16 << 20, 1), (2000, 3000, 7)])
def test_audit_against_plain_python(spark, monkeypatch, flush, most, tasks):
    monkeypatch.setattr(filter_audit, "FLUSH_BYTES", flush)
    monkeypatch.setattr(filter_audit, "PREFIX_BYTES", most)
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, source string, text string, mask int, uid string, part string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs.repartition(tasks), labels)
    assert sorted(map(list, found.collect())) == plain_audit(rows, LABELS)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = filter_audit.audit(spark.createDataFrame([(1, "s", "t")], docs.schema), labels)
    assert one.count() == 600 and one.filter("shapley = 120 AND removed + redundant = 1").count() == 120


def test_audit_of_a_hot_text(spark):
    docs = spark.range(0, 9000, numPartitions=30).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    masks = filter_audit.failure_masks(docs)
    assert {r["mask"]: r["n"] for r in masks.groupBy("mask").agg(F.count("*").alias("n")).collect()} == {1: 6001, 17: 2999}


def test_trie_holds_each_text_once():
    texts = [b"", b"a", b"ab", b"abc", b"abd", b"b" * 100, b"b" * 99 + b"c", b"ab"]
    trie = filter_audit.Trie()
    for i, text in enumerate(texts):
        trie.put(text, -i, i).rows.append((i, -i))
    found = defaultdict(set)
    for node in trie.terminals():
        found[node.least].update(i for i, _ in node.rows)
    assert sorted(map(tuple, found.values())) == [(0,), (1,), (2, 7), (3,), (4,), (5,), (6,)] and found[-7] == {2, 7}


def test_crc_of_spans():
    data = np.frombuffer(b"hello wide world" + b"z" * 100, np.uint8)
    starts, lengths = np.array([0, 6, 11]), np.array([5, 4, 105])
    wanted = np.array([[1, 1, 1], [1, 1, 0], [1, 0, 0]], bool)
    tail = b"world" + b"z" * 100
    runs = [b"hello", b"hello wide", b"hello wide " + tail, b"wide", b"wide " + tail, tail]
    assert importance.run_buckets(data, starts, lengths, wanted, 9973).tolist() == [zlib.crc32(r) % 9973 for r in runs]
