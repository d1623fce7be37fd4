"""License scan: a positional index of rare template words, aligned with each file and verified by key phrases.

The template words' document frequencies are counted over all files. Each key phrase is then indexed under
its rarest word only; a file is aligned with a template where it holds that word, and the place counts if the
whole key phrase stands there. Everything is one aggregate and one projection of built-in functions; the only
thing that reaches the driver is one count per template word.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import let, lower_ascii

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """A licence notice; ``key`` is the part that must stand in a file word for word."""

    label: str
    text: str
    key: str
    base: bool = False


# Phrases by which licences are recognised.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge to any person"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("lgpl", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc0", "creative commons zero cc0 1 0 universal", "cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software released into the public domain"),
    Template("proprietary", "all rights reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null counts as empty."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def template_frequencies(docs: DataFrame, *, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """In how many texts each template word occurs. One row per template word comes back, whatever the input's size."""
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    found = F.array_intersect(words_of(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(found).alias("word")).groupBy("word").count()
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in counted.collect()}


class Posting(NamedTuple):
    template: Template
    #: Position of the anchor in the key phrase, and of the key phrase in the template.
    anchor_at: int
    key_at: int


def rare_index(frequencies: dict[str, int], templates: tuple[Template, ...] = TEMPLATES) -> dict[str, list[Posting]]:
    """Anchor word -> postings. The anchor of a key phrase is its word of highest IDF; on a tie, the first."""
    index: dict[str, list[Posting]] = {}
    for t in templates:
        key, text = t.key.split(), t.text.split()
        at = min(range(len(key)), key=lambda i: (frequencies[key[i]], i))
        key_at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
        index.setdefault(key[at], []).append(Posting(t, at, key_at))
    return index


def _place(words: Column, position: Column, p: Posting) -> Column:
    """The place at which ``p`` is aligned if its anchor stands at ``position``; null where the key phrase does not stand."""
    key, text = p.template.key.split(), p.template.text.split()
    start = position - p.anchor_at
    verified = start >= 0
    for k, w in enumerate(key):
        verified = verified & F.coalesce(F.get(words, start + k) == w, F.lit(False))
    aligned = sum(
        (F.coalesce(F.get(words, start - p.key_at + k) == w, F.lit(False)).cast("int") for k, w in enumerate(text)),
        F.lit(0),
    )
    return F.when(
        verified,
        F.struct(
            F.lit(p.template.label).alias("label"),
            F.lit(p.template.base).alias("base"),
            start.cast("long").alias("start"),
            (aligned / F.lit(float(len(text)))).alias("score"),
        ),
    )


def scan_licenses(docs: DataFrame, *, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``docs`` with a struct column ``license``: n_words and ``places``, an array of (label, base, start, score).

    A place is where a template's whole key phrase stands; ``start`` is its first word, counted from 0, and ``score`` the
    share of the template's words that stand where the template has them. All places are listed, overlapping ones and
    repeated ones too; several templates may share a label. A null or empty text has no words and no places. A column
    named ``license`` is replaced, other columns of any name stay; an empty table gives an empty result.

    The frequencies are counted when this is called, by one job over ``docs``.
    """
    index = rare_index(template_frequencies(docs, text_col=text_col, templates=templates), templates)
    anchors = list(index)

    def places(words: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(anchors))

        def of_position(i: Column) -> Column:
            candidates = [
                F.when(F.get(words, i) == anchor, _place(words, i, p)) for anchor, ps in index.items() for p in ps
            ]
            return F.filter(F.array(*candidates), lambda x: x.isNotNull())

        return F.flatten(F.transform(at, of_position))

    def scanned(words: Column) -> Column:
        has_anchor = F.arrays_overlap(words, F.array(*map(F.lit, anchors)))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.when(has_anchor, places(words)).otherwise(
                F.array().cast("array<struct<label:string,base:boolean,start:bigint,score:double>>")
            ).alias("places"),
        )

    return docs.withColumn("license", let(words_of(F.col(text_col)), scanned))
