"""Quality rules: a threshold table compiled into one projection, without user functions or shuffles."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import let

SPACE = r"[\x20\x09-\x0D]"


class Rule(NamedTuple):
    """Fails where ``scale * measure`` is below (or above) ``bound * per``; whole numbers, so no rounding decides."""

    name: str
    measure: str
    compare: str
    bound: int
    per: str | None = None
    scale: int = 1


# The thresholds every document has to meet in any case.
BASE_RULES = (
    Rule("few_words", "n_words", "<", 50),
    Rule("repeated_words", "n_repeat_words", ">", 50, "n_words", 100),
)

# Further thresholds, on ratios to words, lines and characters.
RATIO_RULES = (
    Rule("symbols", "n_symbols", ">", 25, "n_words", 100),
    Rule("exclamations", "n_marks", ">", 50, "n_words", 100),
    Rule("no_stop_words", "n_stop_words", "<", 1, "n_words", 100),
    Rule("repeated_lines", "n_dup_lines", ">", 50, "n_lines", 100),
    Rule("short_words", "word_chars", "<", 2, "n_words"),
    Rule("long_words", "word_chars", ">", 20, "n_words"),
)

# Common function words of English, German, French and Spanish, as they stand in running text.
STOP_WORDS = (
    "the of and to in is that for it on was with as be at by this are from or an have not they which had his but "
    "der die und das den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "le la les de et des un une du que est pour dans qui par sur pas plus ne au avec ce il sont "
    "el los que y en del se las por con no para su al lo como más pero sus"
).split()


def _covered(starts: Column) -> Column:
    """How many words the three-word windows at these sorted starts cover together."""
    last = F.size(starts) - 1
    step = lambda i: F.least(F.coalesce(F.get(starts, i + 1) - F.get(starts, i), F.lit(3)), F.lit(3))
    return F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("long"), lambda n, i: n + step(i))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text, the first occurrence included."""

    def starts(windows: Column) -> Column:
        at = F.sort_array(F.transform(windows, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))

        def repeated(rows: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(rows, j)["v"] == F.get(rows, k)["v"], F.lit(False))
            every = F.sequence(F.lit(0), F.size(rows) - 1)
            hit = F.filter(every, lambda j: same(j, j + 1) | ((j > 0) & same(j, F.greatest(j - 1, F.lit(0)))))
            return F.sort_array(F.transform(hit, lambda j: F.get(rows, j)["i"]))

        return let(at, repeated)

    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(starts(windows), _covered)
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(windows, count))


def measures(text: Column) -> dict[str, Column]:
    """Columns that hold all counts of a text; null counts as a text without words."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return {
        "__words": of_words,
        "__lines": of_lines,
        "__word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"),
        "__n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "__n_marks": F.regexp_count(text, F.lit("[!?]")).cast("long"),
    }


# Where the projection finds each measure.
MEASURES = {
    "n_words": "__words.n_words",
    "word_chars": "__word_chars",
    "n_symbols": "__n_symbols",
    "n_dup_lines": "__lines.n_dup_lines",
    "n_repeat_words": "__words.n_repeat_words",
    "n_lines": "__lines.n_lines",
    "n_stop_words": "__words.n_stop_words",
    "n_marks": "__n_marks",
}


def compiled(rule: Rule) -> Column:
    """The rule as a Boolean column over the measures."""
    left = F.col(MEASURES[rule.measure]) * rule.scale
    right = F.lit(rule.bound).cast("long") * (F.col(MEASURES[rule.per]) if rule.per else F.lit(1))
    return left < right if rule.compare == "<" else left > right


def judge(
    docs: DataFrame,
    *,
    text_col: str = "text",
    base: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RATIO_RULES,
) -> DataFrame:
    """``docs`` with a struct column ``quality``: all measures, ``failed`` (names of failed rules), ``base_failed``, ``kept``.

    One projection over the scan, no shuffle. A document is kept if no rule of either table fails. A null or empty text
    has zero counts and fails the word minimum; ties with a threshold pass. A column named ``quality`` is replaced, other
    columns of any name stay; an empty table gives an empty result.
    """
    held = _judged(docs, text_col, base, rules)
    return held.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c != "quality"], "quality")


def _judged(docs: DataFrame, text_col: str, base: tuple[Rule, ...], rules: tuple[Rule, ...]) -> DataFrame:
    """The rows as one struct ``__row``, so that no column of theirs meets a measure, beside their ``quality``."""
    any_of = lambda table: reduce(or_, [compiled(r) for r in table], F.lit(False))
    names = F.filter(
        F.array(*[F.when(compiled(r), F.lit(r.name)) for r in (*base, *rules)]), lambda x: x.isNotNull()
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    measured = docs.select(row, *[m.alias(c) for c, m in measures(F.col(text_col)).items()])
    return measured.select(
        "__row",
        F.struct(
            *[F.col(at).alias(m) for m, at in MEASURES.items()],
            names.alias("failed"),
            any_of(base).alias("base_failed"),
            (~any_of((*base, *rules))).alias("kept"),
        ).alias("quality"),
    )


def keep_good(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns only."""
    return _judged(docs, text_col, BASE_RULES, RATIO_RULES).filter("quality.kept").select("__row.*")
