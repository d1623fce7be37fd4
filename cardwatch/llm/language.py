"""Language identification by prediction by partial matching over bytes.

Each language has context trees of bounded depth over the bytes of its sample. With frozen statistics the code length of
a byte is a function of the bytes before it, down to the longest context that was seen: symbols seen there have their
share, the rest is an escape to the next shorter context, in which the symbols already ruled out no longer take part
(method C with exclusion). So the trees of all languages are written out as one table, context by symbol, in whole
1/1024ths of a bit, and a text's code lengths are sums of whole numbers, equal in every order of summation.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.spans import chunks

#: Code lengths are whole multiples of 1/UNIT bits.
UNIT = 1024
#: What stands before a text.
BEFORE = b"\n\n\n"
DEPTH = len(BEFORE)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
UNDETERMINED = "und"


class LanguageModel(NamedTuple):
    """``symbol``: byte -> symbol (0: in no sample). ``context``: last three symbols -> row. ``length``: row and symbol -> one
    code length per language."""

    languages: list[str]
    symbol: np.ndarray
    context: np.ndarray
    length: np.ndarray

    @property
    def symbols(self) -> int:
        return int(self.symbol.max()) + 1

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length of each text per language, in units."""
        found = [np.zeros((0, len(self.languages)), np.int64)]
        for chunk in chunks(texts, (16 << 20) // max(4, len(self.languages))):
            n = self.symbols
            starts, sizes = chunk.offsets[:-1], np.diff(chunk.offsets)
            led = np.insert(chunk.data[: chunk.size], np.repeat(starts, DEPTH), np.frombuffer(BEFORE * chunk.rows, np.uint8))
            s = self.symbol[led]
            last3 = np.zeros(len(s), np.int64)
            last3[DEPTH:] = (s[:-3] * n + s[1:-2]) * n + s[2:-1]
            costs = self.length[self.context[last3] * n + s]
            first = starts + DEPTH * np.arange(1, chunk.rows + 1)
            cuts = np.stack([first, first + sizes], axis=1).ravel()
            sums = np.add.reduceat(np.vstack([costs, costs[:1]]), cuts, axis=0, dtype=np.int64)[::2]
            found.append(np.where(sizes[:, None] > 0, sums, 0))
        return np.concatenate(found)


def bounded_sample(labelled: DataFrame, rows: int, *, id_col: str, lang_col: str) -> DataFrame:
    """At most ``rows`` rows of each language, those with the smallest hash of the id.

    A first cut by hash keeps about three times as many, so that no task has to rank all rows of a frequent language.
    """
    counts = {r[lang_col]: r["count"] for r in labelled.groupBy(lang_col).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 40))
    cut = F.lit(1 << 40)
    for lang, n in counts.items():
        if n > 3 * rows + 100:
            cut = F.when(F.col(lang_col) == lang, F.lit(int((1 << 40) * (3 * rows + 100) / n))).otherwise(cut)
    ordered = Window.partitionBy(lang_col).orderBy("__draw", id_col)
    return (
        labelled.withColumn("__draw", draw)
        .filter(F.col("__draw") < cut)
        .withColumn("__rank", F.row_number().over(ordered))
        .filter(F.col("__rank") <= rows)
        .drop("__draw", "__rank")
    )


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, four bytes as an integer, count) of each batch; every text is led by ``BEFORE``."""
    for batch in batches:
        kinds = batch.column(0).dictionary_encode()
        for k, lang in enumerate(kinds.dictionary.to_pylist()):
            texts = batch.column(1).filter(pa.array(kinds.indices.to_numpy() == k))
            for chunk in chunks(texts):
                led = np.insert(
                    _FOLD[chunk.data[: chunk.size]],
                    np.repeat(chunk.offsets[:-1], DEPTH),
                    np.frombuffer(BEFORE * chunk.rows, np.uint8),
                )
                at = np.flatnonzero(
                    ~np.isin(np.arange(len(led)), (chunk.offsets[:-1, None] + DEPTH * np.arange(chunk.rows)[:, None] + np.arange(DEPTH)).ravel())
                )
                b = led.astype(np.int64)
                grams, counts = np.unique(b[at - 3] << 24 | b[at - 2] << 16 | b[at - 1] << 8 | b[at], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"]
                )


def fit(labelled: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least_context: int = 2) -> LanguageModel:
    """Fit on a bounded sample (see ``bounded_sample``): grams are counted by Spark, and the count table is the model.

    Rows without a language or text are ignored. Contexts of three bytes that the sample of all languages together has
    fewer than ``least_context`` times give way to two bytes.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        _count_grams, "lang string, gram long, n long"
    )
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").toPandas()
    return from_counts(table["lang"].to_numpy(), table["gram"].to_numpy(np.int64), table["n"].to_numpy(np.int64), least_context)


def from_counts(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, least_context: int) -> LanguageModel:
    languages, of = np.unique(lang.astype(str), return_inverse=True)
    b = [(gram >> s) & 255 for s in (24, 16, 8, 0)]
    symbol = np.zeros(256, np.int64)
    seen = np.unique(np.concatenate([b[3], np.frombuffer(BEFORE, np.uint8)]))
    symbol[seen] = np.arange(1, len(seen) + 1)
    a, s = len(seen) + 1, [symbol[x] for x in b]
    last2 = s[1] * a + s[2]
    last3 = s[0] * a * a + last2
    kept, place = np.unique(last3, return_inverse=True)
    contexts = kept[np.bincount(place, n, len(kept)) >= least_context]

    context = np.tile(np.arange(a * a), a) + len(contexts)
    context[contexts] = np.arange(len(contexts))
    length = np.zeros(((len(contexts) + a * a), a, len(languages)), np.uint16)
    shorter = contexts % (a * a)
    for k in range(len(languages)):
        own = of == k
        order0 = np.bincount(s[3][own], n[own], a)
        order1 = np.bincount(s[2][own] * a + s[3][own], n[own], a * a).reshape(a, a)
        order2 = np.bincount(last2[own] * a + s[3][own], n[own], a**3).reshape(a * a, a)
        order3 = np.bincount(np.searchsorted(contexts, last3[own]).clip(0, max(0, len(contexts) - 1)) * a + s[3][own],
                             n[own] * np.isin(last3[own], contexts), max(1, len(contexts)) * a).reshape(-1, a)[: len(contexts)]
        for rows in range(0, len(contexts), 8192):
            cut = slice(rows, min(rows + 8192, len(contexts)))
            two = shorter[cut]
            length[cut, :, k] = _units([order3[cut], order2[two], order1[two % a], order0[None, :]])
        two = np.arange(a * a)
        length[len(contexts) :, :, k] = _units([order2, order1[two % a], order0[None, :]])
    # The texts' own bytes are folded to lower case when they are looked up.
    return LanguageModel(languages.tolist(), symbol[_FOLD], context, length.reshape(length.shape[0] * a, len(languages)))


def _units(orders: list[np.ndarray]) -> np.ndarray:
    """Code length of every symbol after contexts whose counts, from the longest context down, are ``orders``."""
    rows, a = orders[0].shape
    length = np.zeros((rows, a))
    escape = np.zeros((rows, 1))
    out = np.zeros((rows, a), bool)
    for counts in orders:
        counts = np.where(out, 0, counts)
        total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        here = counts > 0
        with np.errstate(divide="ignore"):
            length = np.where(here, escape - np.log2(np.where(here, counts, 1) / np.maximum(total + kinds, 1)), length)
            escape = escape + np.where(total > 0, np.log2(np.maximum(total + kinds, 1)) - np.log2(np.maximum(kinds, 1)), 0)
        out |= here
    # Bytes that the language's sample has nowhere share what is left evenly.
    unseen = np.maximum(256 - out.sum(axis=1, keepdims=True), 1)
    length = np.where(out, length, escape + np.log2(unseen))
    return np.minimum(np.rint(length * UNIT), 65535).astype(np.uint16)


def predict(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score: the language of least code length, and its posterior under even odds.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if the model knows no language. Of
    languages with equal code lengths the first in order of name is taken. Texts are read whole. Columns named lang_pred
    or score are replaced, other columns of any name stay; an empty table gives an empty result.
    """
    names = np.array([*model.languages, UNDETERMINED], object)
    held = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    lettered = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def judged(texts: pa.Array) -> pa.Array:
        known = held.value
        best, score = np.full(len(texts), len(known.languages)), np.zeros(len(texts))
        if known.languages:
            lengths = known.code_lengths(texts)
            best = np.where(texts.is_valid().to_numpy(zero_copy_only=False), lengths.argmin(axis=1), best)
            over = (lengths - lengths.min(axis=1, keepdims=True)) / UNIT
            score = np.where(best < len(known.languages), 1 / np.exp2(-over).sum(axis=1), 0.0)
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang_pred", "score"])

    found = docs.select(row.alias("__row"), judged(lettered).alias("__judged"))
    return found.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in ("lang_pred", "score")], "__judged.*"
    )


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees: CRC-32 of the id as text, modulo 5, is 0. Null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
