"""Operators over a table whose scan gives its rows in another order each time, as after other splits or a lost executor."""

import random

import pyarrow as pa
import pytest

from cardwatch.llm import exact_dedup, lm_scoring, near_dups, suffix_dedup

N = 120


def texts():
    pick = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    out = [" ".join(pick.choices(words, k=pick.randint(60, 120))) for _ in range(N)]
    for k in range(0, N, 4):  # an exact copy, a near one, a shared passage
        out[k + 1] = out[k].upper()
        out[k + 2] = out[k] + " end"
        out[k + 3] = out[k + 3] + " " + out[k][:300]
    return out


def scans(spark):
    """(a table that always gives the same rows at the same places, the same table shuffled anew by each scan)"""
    steady = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").coalesce(1)

    def shuffle(batches):
        table = pa.Table.from_batches(list(batches))
        order = list(range(table.num_rows))
        random.SystemRandom().shuffle(order)
        yield from table.take(order).combine_chunks().to_batches()

    return steady, steady.mapInArrow(shuffle, steady.schema)


@pytest.mark.parametrize(
    "operator",
    [
        lm_scoring.score,
        near_dups.near_duplicates,
        near_dups.keep_one_of_each,
        exact_dedup.drop_duplicates,
        suffix_dedup.remove_repeats,
    ],
    ids=lambda f: f.__name__,
)
def test_each_scan_in_another_order(spark, monkeypatch, operator):
    monkeypatch.setattr(lm_scoring, "_CHUNK", 3000)
    steady, shuffled = scans(spark)
    # The place in the scan names no row here, only the ids do.
    rows = [sorted(operator(docs).drop("uid").collect(), key=str) for docs in (steady, shuffled)]
    assert len(rows[0]) >= N // 4 and rows[0] == rows[1]


def test_chunks_in_parts(spark, monkeypatch):
    """A stored chunk that several tasks read is one chunk."""
    monkeypatch.setattr(lm_scoring, "_CHUNK", 3000)
    whole = sorted(lm_scoring.score(scans(spark)[0]).collect())
    write_once = lm_scoring.write_once
    monkeypatch.setattr(lm_scoring, "write_once", lambda df, name, *codec: write_once(df, name, *codec).repartition(7))
    assert sorted(lm_scoring.score(scans(spark)[0]).collect()) == whole
