"""Near duplicates by DartMinHash signatures and banded joins.

Every shingle of a text owns cells, one per unit of its weight, and into every cell darts fall at random ranks. A text
collects the darts of its cells up to a rank at which every coordinate of the signature has been hit, and keeps the
earliest dart per coordinate; two texts agree in a coordinate with the probability of their weighted Jaccard similarity.
The darts of a cell depend on the shingle alone, and a text throws about ``k ln k`` of them, however long it is.

Texts with equal shingle sets become one. In each bucket of each band the others are compared with the bucket's smallest
member only, so a large group costs as many comparisons as it has members. Only where a bucket still holds texts of
several groups are those compared with each other: buckets with the same smallest member are put together, and dealt out in
blocks, by signature and then by their whole shingle sets. No bucket is cut short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.components import components
from cardwatch.llm.shared import join_by_key, store_rows, store_texts, write_once
from cardwatch.llm.spans import Chunk, chunks, folded_words, gram_hashes, hash_spans, mix, ranges

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
#: Members of a mixed group, and shingles of all of them, that one task compares with as many others.
BLOCK = 2000
BLOCK_SHINGLES = 4_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(chunk: Chunk, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, with their counts, and where each text's start."""
    data, starts, lengths, bounds = folded_words(chunk)
    grams, edges = gram_hashes(hash_spans(data, starts, lengths), bounds, n)
    sets = [np.unique(grams[a:b], return_counts=True) for a, b in zip(edges[:-1], edges[1:])]
    sizes = np.array([len(s) for s, _ in sets], np.int64)
    return (
        np.concatenate([np.zeros(0, np.uint64), *[s for s, _ in sets]]),
        np.concatenate([np.zeros(0, np.int64), *[c for _, c in sets]]),
        np.append(0, np.cumsum(sizes)),
    )


def dart_signatures(shingles: np.ndarray, weights: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """One row of ``k`` coordinates (32-bit dart names) per text; texts without shingles have rows of zeros."""
    texts = len(bounds) - 1
    cells = mix(np.repeat(shingles, weights) + ranges(np.zeros(len(weights), np.int64), weights).astype(np.uint64) * _STEP)
    of = np.repeat(np.repeat(np.arange(texts), np.diff(bounds)), weights)
    total = np.bincount(of, minlength=texts)
    nearest = np.full((texts, k), ~np.uint64(0))
    limit = k * (np.log(k) + 2.5) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        live = todo[of]
        cell, text, rank, nth = cells[live], of[live], 0.0, 0
        while len(cell):
            nth += 1
            h = mix(cell + np.uint64(nth * int(_STEP) % 2**64))
            # The gap to the next dart of a cell is exponential.
            rank = rank - np.log(((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            near = rank <= limit[text]
            cell, text, rank, h = cell[near], text[near], rank[near], mix(h[near] ^ _STEP)
            coordinate = ((h >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            # Earlier darts have smaller bits; the dart's name settles what the leading bits leave open.
            key = (rank.view(np.uint64) & np.uint64(0xFFFFFFFF00000000)) | (mix(h) & np.uint64(0xFFFFFFFF))
            np.minimum.at(nearest.reshape(-1), text * k + coordinate, key)
        todo &= (nearest == ~np.uint64(0)).any(axis=1)
        limit = limit * 2
    nearest[total == 0] = 0
    return (nearest & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per text and band."""
    h = np.tile(np.arange(bands, dtype=np.uint64), (len(signatures), 1))
    for r in range(rows):
        h = mix(h * _STEP + signatures[:, r : bands * rows : rows])
    return h


def sketch(texts: DataFrame, *, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """Per stored text: uid, doc_id, size (distinct shingles), set_key (digest of the shingle set), signature, buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                shingles, counts, bounds = shingle_sets(chunk, n)
                signs = dart_signatures(shingles, counts if weighted else np.ones_like(counts), bounds, bands * rows)
                keys = [
                    hashlib.blake2b(shingles[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(bounds[:-1], bounds[1:])
                ]
                width = lambda w: pa.array(np.arange(chunk.rows + 1, dtype=np.int32) * w)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.rows),
                        batch.column(1).slice(chunk.first, chunk.rows),
                        pa.array(np.diff(bounds)),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(width(bands * rows), pa.array(signs.view(np.int32).ravel())),
                        pa.ListArray.from_arrays(width(bands), pa.array(band_keys(signs, bands, rows).view(np.int64).ravel())),
                    ],
                    ["uid", "doc_id", "size", "set_key", "signature", "buckets"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"uid long, doc_id {kind}, size long, set_key binary, signature array<int>, buckets array<long>"
    )


def _shingles_of(texts: DataFrame, uids: DataFrame, n: int) -> DataFrame:
    """(uid, shingles: sorted array of long) of the texts with these uids."""
    chosen = texts.drop("doc_id").join(uids.hint("merge"), "uid", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                shingles, _, bounds = shingle_sets(chunk, n)
                held = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.rows), held], ["uid", "shingles"])

    return chosen.mapInArrow(run, "uid long, shingles array<long>")


def _comparable(a: Column, b: Column, threshold: float) -> Column:
    """Sets whose sizes differ too much cannot reach the threshold."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def _verified(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets have a Jaccard similarity of ``threshold`` or more."""
    left = shingles.select(F.col("uid").alias("u"), F.col("shingles").alias("a"))
    right = shingles.select(F.col("uid").alias("v"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(left, "u").join(right, "v").filter(common >= threshold * (F.size("a") + F.size("b") - common)).select("u", "v")
    )


def _dealt_in_blocks(members: DataFrame) -> DataFrame:
    """``members`` (stored: lead, uid, root, size) with ``blocks``, into how many their group is dealt, and ``own``, theirs.

    Members of a large group learn this in many tasks.
    """
    needed = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    groups = members.groupBy("lead").agg(needed.cast("int").alias("blocks"), F.count("*").alias("n"))
    groups = write_once(groups, "block-counts")
    told = join_by_key(members, groups.select("lead", "blocks"), "lead", groups.select("lead", "n"), "uid")
    return told.withColumn("own", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))


def _links_in_blocks(dealt: DataFrame, bands: int, rows: int, threshold: float) -> DataFrame:
    """Links (u, v) between texts of different roots in one group; together with the roots they join all that is linked.

    ``dealt``: lead (names the group), own, blocks, uid, root, size, signature, shingles. A group with many or long members is
    dealt out in blocks; each pair of blocks is a task of its own. There, what is within five standard deviations of the
    threshold by signature is compared by its whole shingle sets. Links that join nothing new are not given out, so a task
    gives out fewer rows than it takes in.
    """
    k = bands * rows
    least = k * threshold - 5 * (k * threshold * (1 - threshold)) ** 0.5
    carried = ["uid", "root", "size", "signature", "shingles"]
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("lead", "own", *carried, other).select(
        "lead",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") <= F.col("other")).alias("left"),
        (F.col("own") >= F.col("other")).alias("right"),
        *carried,
    )

    def compare(table: pa.Table) -> pa.Table:
        uid, root, size = (table.column(c).to_numpy() for c in ("uid", "root", "size"))
        left, right = (table.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
        signs = table.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, k)
        held = table.column("shingles").combine_chunks()
        flat, ends = held.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(size))
        # Groups within this task: members of one set are linked, here or through their roots.
        _, group = np.unique(root, return_inverse=True)
        found = []
        for i in np.flatnonzero(left):
            j = np.flatnonzero(right & (group != group[i]) & (np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i])))
            j = j[(signs[j] == signs[i]).sum(axis=1) >= least]
            if not len(j):
                continue
            own = flat[ends[i] : ends[i + 1]]
            others = flat[ranges(ends[j], size[j])]
            hit = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
            common = np.add.reduceat(hit, np.cumsum(size[j]) - size[j], dtype=np.int64)
            for v in j[common >= threshold * (size[i] + size[j] - common)]:
                if group[v] != group[i]:
                    group[group == group[v]] = group[i]
                    found.append((max(uid[i], uid[v]), min(uid[i], uid[v])))
        u, v = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"u": u, "v": v})

    return dealt.groupBy("lead", "low", "high").applyInArrow(compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weighted: bool = False,
                    uid_col: str | None = None) -> DataFrame:
    """Classes of texts that are linked by a Jaccard similarity of ``threshold`` or more over runs of ``n`` words.

    Returns one row per input row: uid, doc_id, class_id, class_size, kept. Words stand between blanks,
    with A-Z lower-cased; a text of fewer than ``n`` words is one shingle. A class is all texts linked directly or through
    others; class_id is its smallest doc_id, and one row with that id is kept. ``weighted`` counts repeated shingles in the
    signatures; the final check is on sets.

    A null text counts as empty; a text without words is a class of its own. A null id never gives the class its
    name unless all ids are null. Repeated rows are one class. Other columns are ignored, whatever their names; an empty
    table gives an empty result. ``docs`` is scanned once and stored with a uid per row, unless ``uid_col`` names a column of
    uids that are stored already.
    """
    if uid_col is None:
        texts = store_texts(docs, id_col, text_col)
    else:
        texts = docs.select(F.col(uid_col).alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketches = write_once(sketch(texts, n=n, bands=bands, rows=rows, weighted=weighted), "sketches")
    own = F.when(F.col("size") == 0, F.col("uid")).otherwise(F.lit(-1))
    # Written, so that the join below reads it and Spark can split a shingle set that very many texts share.
    same = write_once(sketches.groupBy("set_key", "size", own.alias("own")).agg(F.min("uid").alias("rep")), "sets")
    reps = sketches.join(same.select(F.col("rep").alias("uid")), "uid", "left_semi").filter("size > 0")
    reps = write_once(reps.select("uid", "size", "signature", "buckets"), "reps")

    members = reps.select("uid", "size", F.explode("buckets").alias("bucket"))
    leads = members.groupBy("bucket").agg(F.min(F.struct("uid", "size")).alias("lead"), F.count("*").alias("n"))
    met = write_once(members.join(leads.filter("n > 1"), "bucket").select("bucket", "uid", "size", "lead"), "buckets")
    stars = met.filter(F.col("uid") != F.col("lead.uid")).filter(_comparable(F.col("size"), F.col("lead.size"), threshold))
    stars = stars.select(F.col("uid").alias("u"), F.col("lead.uid").alias("v")).distinct()
    shingles = write_once(_shingles_of(texts, met.select("uid").distinct(), n), "shingles")
    links = write_once(_verified(stars, shingles, threshold), "star-links")

    roots = write_once(components(links), "roots")
    rooted = met.join(roots.withColumnRenamed("node", "uid"), "uid", "left").select(
        "bucket", "uid", "size", F.coalesce("root", "uid").alias("root")
    )
    ends = F.min("root").alias("low"), F.max("root").alias("high"), F.min("uid").alias("lead")
    mixed = rooted.groupBy("bucket").agg(*ends).filter("low <> high").select("bucket", "lead")
    together = write_once(rooted.join(mixed, "bucket").select("lead", "uid", "root", "size").distinct(), "mixed-groups")
    together = _dealt_in_blocks(together).join(reps.select("uid", "signature"), "uid").join(shingles, "uid")
    more = write_once(_links_in_blocks(together, bands, rows, threshold), "block-links")
    joined = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))

    classes = (
        sketches.withColumn("own", own)
        .join(same, ["set_key", "size", "own"])
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("uid", "doc_id", F.coalesce("root", "rep").alias("root"))
    )
    classes = write_once(classes, "classes")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid"))
    named = write_once(classes.groupBy("root").agg(first.alias("first"), F.count("*").alias("class_size")), "named")
    return classes.join(named, "root").select(
        "uid",
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns. ``docs`` is scanned once."""
    rows, uid = store_rows(docs)
    classes = near_duplicates(rows, id_col=id_col, text_col=text_col, uid_col=uid)
    stay = classes.filter("kept").select(F.col("uid").alias(uid))
    stay = stay.hint("merge")  # it grows with the input, so it is never broadcast
    return rows.join(stay, uid, "left_semi").drop(uid)
