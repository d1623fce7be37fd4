"""Personal data by anchors: an Aho-Corasick automaton finds short cues, deterministic parsers expand and check them.

Anchors are the at-sign, the plus sign before a digit, digits next to digits or separators, schemes, country codes of
account numbers and words that announce an identifier. Each parser looks only around its anchor, so the cost follows
the number of cues and not the number of patterns.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: In this order spans are listed; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url_login", "iban", "ssn", "account", "secret")

_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOCAL = frozenset(_LETTERS + _DIGITS + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"[ :#]{1,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?:[ ]?(?:no\.?|number|nr\.?|#))?[ :#=]{1,3}([0-9]{6,17})(?![0-9])", re.I)
_SECRET = re.compile(r"[ ]?[:=][ ]?([A-Za-z0-9_\-+/=]{12,})")

# Lengths of account numbers (IBAN) by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22,
    "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}
_CUES = {
    "ssn": "ssn",
    "social security number": "ssn",
    "account": "account",
    "acct": "account",
    "konto": "account",
    "password": "secret",
    "passwd": "secret",
    "api_key": "secret",
    "apikey": "secret",
    "secret": "secret",
    "token": "secret",
}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All anchors: text -> (parser, length)."""
    found = ahocorasick.Automaton()
    anchors = {"@": "email", "://": "url_login"}
    anchors |= {f"+{d}": "phone" for d in _DIGITS}
    anchors |= {f"{a}.{b}": "ip" for a in _DIGITS for b in _DIGITS}
    anchors |= {f"{a}{s}{b}": "card" for a in _DIGITS for s in ("", " ", "-") for b in _DIGITS}
    anchors |= {f"{c}{d}": "iban" for c in IBAN_LENGTHS for d in _DIGITS}
    for cue, kind in _CUES.items():
        anchors |= dict.fromkeys((cue, cue.capitalize(), cue.upper()), kind)
    for anchor, kind in anchors.items():
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def iban_holds(number: str) -> bool:
    """Length by country and the remainder of 97."""
    if IBAN_LENGTHS.get(number[:2]) != len(number):
        return False
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _run_start(text: str, at: int, floor: int, separators: str) -> int:
    """Walk left from a digit over digits with single separators between them, not beyond ``floor``."""
    while at > floor:
        if text[at - 1] in _DIGITS:
            at -= 1
        elif at - 1 > floor and text[at - 1] in separators and text[at - 2] in _DIGITS:
            at -= 2
        else:
            break
    return at


class _Parsers:
    """Parsers of one text. ``done[kind]``: where the kind's last match or rejected run ends; nothing before it is read again."""

    def __init__(self, text: str):
        self.text = text
        self.done = dict.fromkeys(KINDS, 0)
        self.spans: list[tuple[str, int, int]] = []

    def add(self, kind: str, start: int, end: int) -> None:
        self.spans.append((kind, start, end))

    def email(self, start: int, end: int) -> None:
        first = start
        while first > self.done["email"] and self.text[first - 1] in _LOCAL:
            first -= 1
        if first < start and (domain := _DOMAIN.match(self.text, end)):
            self.add("email", first, domain.end())
            self.done["email"] = domain.end()

    def ip(self, start: int, end: int) -> None:
        if start < self.done["ip"]:
            return
        run = _DOTTED.match(self.text, _run_start(self.text, start, self.done["ip"], "."))
        self.done["ip"] = run.end()
        parts, at = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            size = len(".".join(own))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
                self.add("ip", at, at + size)
            at += size + 1

    def card(self, start: int, end: int) -> None:
        if start < self.done["card"]:
            return
        run = _NUMBER.match(self.text, _run_start(self.text, start, self.done["card"], " -"))
        self.done["card"] = run.end()
        digits = run[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            self.add("card", *run.span())

    def phone(self, start: int, end: int) -> None:
        if (run := _PHONE.match(self.text, start)) and 8 <= sum(c in _DIGITS for c in run[0]) <= 15:
            self.add("phone", *run.span())

    def url_login(self, start: int, end: int) -> None:
        if login := _LOGIN.match(self.text, end):
            self.add("url_login", *login.span())

    def iban(self, start: int, end: int) -> None:
        if start < self.done["iban"] or start and self.text[start - 1].isalnum():
            return
        if (run := _IBAN.match(self.text, start)) and iban_holds(run[0].replace(" ", "")):
            self.add("iban", *run.span())
            self.done["iban"] = run.end()

    def _announced(self, kind: str, pattern: re.Pattern, end: int) -> None:
        # A cue well inside the last value could only announce a part of it; reading on from each would cost a square.
        if end + 1 < self.done[kind]:
            return
        if (value := pattern.match(self.text, end)) and value.start(1) >= self.done[kind]:
            self.add(kind, *value.span(1))
            self.done[kind] = value.end(1)

    def ssn(self, start: int, end: int) -> None:
        self._announced("ssn", _SSN, end)

    def account(self, start: int, end: int) -> None:
        self._announced("account", _ACCOUNT, end)

    def secret(self, start: int, end: int) -> None:
        self._announced("secret", _SECRET, end)


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), in code points with an exclusive end, by kind as listed, then start."""
    if not text:
        return []
    parsers = _Parsers(text)
    for last, (kind, size) in automaton().iter(text):
        getattr(parsers, kind)(last + 1 - size, last + 1)
    return sorted(parsers.spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Replace every span by its kind in angle brackets; spans that overlap become one, named after the first."""
    out, end = [], 0
    for start, stop, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= end:
            out += [text[end:start], f"<{kind}>"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


_SPANS = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType()))


@F.pandas_udf(_SPANS)
def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)] for t in texts], dtype=object)


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series) -> pd.Series:
    """Null where there is nothing to replace."""
    found = ((t, find_spans(t)) for t in texts)
    return pd.Series([redact(t, spans) if spans else None for t, spans in found], dtype=object)


def find_personal(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``personal``: an array of (kind, start, end) in code points, by kind as in ``KINDS``, then start.

    Base kinds are found leftmost and without overlap per kind; a candidate that fails its check is dropped and not read
    again. Kinds may overlap each other. A null or empty text has no spans; texts of any length are read whole; repeated
    rows are treated alike. A column named ``personal`` is replaced, other columns of any name stay; an empty table gives
    an empty result.
    """
    return docs.withColumn("personal", _spans(F.col(text_col)))


def redact_documents(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span in the texts replaced by its kind; a length column, where there is one, follows.

    Null texts stay null. Columns and rows stay as they are otherwise.
    """
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[text_col].alias("__text"))
    found = held.withColumn("__new", _redacted(F.col("__text")))
    columns = []
    for c in docs.columns:
        own = F.col(f"__row.`{c}`")
        if c == text_col:
            own = F.coalesce("__new", own)
        elif c == length_col:
            length = F.char_length("__new").cast(docs.schema[c].dataType)
            own = F.when(F.col("__new").isNotNull(), length).otherwise(own)
        columns.append(own.alias(c))
    return found.select(*columns)
