"""Spans against plain patterns over the whole text."""

import hashlib
import random
import re

from cardwatch.llm import personal
from cardwatch.llm.queries import op1_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def doubled(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and doubled(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


def base(text):
    return [s for s in personal.find_spans(text) if s[0] in personal.BASE_KINDS]


def test_random_texts():
    pick = random.Random(3)
    signs = ["@", ".", "..", "-", " ", "  ", "+", "(", ")", "a", "B%", "é", "\U0001f600", "1", "25", "256", "007", "\n", "a@b.c"]
    signs += ["4111111111111111", "4111 1111 1111 1111", "+1 (555) 123-4567", "10.0.0.1", "x@y", ".com", "5500-0000-0000-0004"]
    for _ in range(30_000):
        text = "".join(pick.choices(signs, k=pick.randint(1, 25)))
        assert base(text) == plain(text), text


def test_further_kinds():
    text = (
        "IBAN DE89 3704 0044 0532 0130 00, not DE89 3704 0044 0532 0130 01. SSN: 123-45-6789. "
        "https://user:pass@host.example/x password=b7db7aa4a5fcc78305 Account no. 12345678 password reset"
    )
    found = {k: text[s:e] for k, s, e in personal.find_spans(text) if k not in personal.BASE_KINDS}
    assert found == {
        "iban": "DE89 3704 0044 0532 0130 00",
        "ssn": "123-45-6789",
        "url_login": "user:pass@host.example",
        "secret": "b7db7aa4a5fcc78305",
        "account": "12345678",
    }


def test_clean_text_stays():
    text = "On 12.5.2020 we sold 1,234 units; see item 3.4.5 and call 555. Version 2.0 costs 19.99 at the door."
    assert personal.find_spans(text) == [] and personal.redact(text, []) == text


def test_runs_of_cues_are_read_once():
    text = "token=" * 800_000
    assert personal.find_spans(text) == [("secret", 6, len(text))]
    inner = "secret=aaaaaaaaaaaatoken= bbbbbbbbbbbbb and password: secret=cccccccccccc"
    assert [inner[s:e] for _, s, e in personal.find_spans(inner)] == ["aaaaaaaaaaaatoken=", "bbbbbbbbbbbbb", "secret=cccccccccccc"]


def test_awkward_rows(spark):
    schema = "doc_id long, text string, n_chars long, personal string, __text string, redacted string"
    texts = {1: None, 2: "", 3: "é a@b.co +1 555 123 4567 \U0001f600 10.0.0.1", 4: "x" * 200_000 + " a@b.co", 5: "a@b.co\na@b.co"}
    docs = spark.createDataFrame([(i, t, len(t or ""), "p", "t", "r") for i, t in [*texts.items(), (3, texts[3])]], schema)
    found = personal.find_personal(docs)
    assert found.count() == 6 and sorted(found.columns) == sorted(docs.columns)
    for r in found.collect():
        assert [(p["kind"], p["start"], p["end"]) for p in r["personal"]] == plain(texts[r["doc_id"]])
    kept = personal.redact_documents(docs)
    assert kept.schema == docs.schema
    got = {r["doc_id"]: r for r in kept.collect()}
    assert [got[i]["text"] for i in (1, 2)] == [None, ""]
    assert got[3]["text"] == "é <email> <phone> \U0001f600 <ip>" and got[3]["n_chars"] == len(got[3]["text"])
    assert got[4]["text"] == "x" * 200_000 + " <email>" and got[5]["text"] == "<email>\n<email>"
    assert personal.redact_documents(docs.limit(0)).count() == 0


def test_op1_digests(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op1_personal_data(spark, small).collect()
    assert len(rows) == len(texts) and sum(r["n_email"] for r in rows) > 0
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in want) for k in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(r["spans"].split(","))
        assert r["n_spans"] == len(personal.find_spans(texts[r["doc_id"]]))
