"""Steps whose memory or plans must not grow with the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.learners import knn, rules
from cardwatch.operators import resample

SCHEMA = "transaction_id long, is_fraud int, a double, b double"


def test_rules_of_many_leaves(spark):
    many = [rules.Rule(i, (("a", float(i - 1), float(i)),)) for i in range(512)]
    df = spark.createDataFrame([(i, i % 2, float(i), 0.0) for i in range(512)] + [(900, 1, None, 0.0)], SCHEMA)
    table = rules.purity(df, many)
    assert table.count() == 512 and table.filter("purity = 1").count() == 256
    even = df.select("transaction_id", rules.override(F.lit(0), many[::2]).alias("p"))
    assert {r["transaction_id"] for r in even.filter("p = 1").collect()} == set(range(0, 512, 2))
    assert df.select(rules.leaf_of([]).alias("leaf")).filter("leaf IS NOT NULL").count() == 0


def test_new_rows_send_no_table_through_the_driver(spark):
    rows = [(i, int(i % 3 == 0), float(i % 17), float(i % 5)) for i in range(300)]
    made = resample.oversample(spark.createDataFrame(rows, SCHEMA), ["a", "b"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("kind", ["spread", "ties", "copies"])
@pytest.mark.parametrize("k", [1, 7])
def test_leaves_find_what_all_points_hold(kind, k):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(3000, 4)) * [1, 1, 5, 0.1]
    points = {"spread": points, "ties": np.round(points), "copies": np.repeat(points[:3], 1000, axis=0)}[kind]
    x, ids = np.concatenate([points[::60], rng.normal(size=(50, 4))]), rng.permutation(3000)
    places, d2 = knn._nearest(x, points, ids, k)
    exact = np.round(((x[:, None, :] - points[None]) ** 2).sum(2), knn.DIGITS)
    order = np.array([np.lexsort((ids, e))[:k] for e in exact])
    assert (places == order).all() and (d2 == np.take_along_axis(exact, order, 1)).all()


def test_rows_are_held_against_pivots_in_slices():
    batch = pd.DataFrame({"id": range(10_000)})
    parts = list(knn._slices(iter([batch]), knn.MOST_PIVOTS))
    assert max(map(len, parts)) * knn.MOST_PIVOTS <= knn.HELD
    assert pd.concat(parts).equals(batch)


def test_a_cell_whose_box_is_far_is_not_visited(spark, monkeypatch):
    # Two lines of points side by side: the balls around their pivots reach the other line, the boxes do not.
    rows = [(i, 0, float(i % 500), 9.0 * (i // 500)) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA).select("transaction_id", "is_fraud", F.array("a", "b").alias("x"))
    vectors = df.select("transaction_id", "is_fraud", knn.array_to_vector("x").alias("features"))
    visits, search = [], knn._search
    monkeypatch.setattr(knn, "_search", lambda v, *rest: visits.append(v.count()) or search(v, *rest))
    found = knn.nearest_neighbors(vectors, vectors, 3, label="is_fraud", pivots=8)
    values = np.array([(r[2], r[3]) for r in rows])
    exact = np.round(((values[:, None, :] - values[None]) ** 2).sum(2), knn.DIGITS)
    expected = {i: tuple(np.lexsort((np.arange(1000), exact[i]))[:3]) for i in range(1000)}
    near: dict = {}
    for r in found.orderBy("transaction_id", "rank").collect():
        near.setdefault(r["transaction_id"], []).append(r["neighbor_id"])
    assert {i: tuple(n) for i, n in near.items()} == expected
    assert visits[0] == 1000 and visits[1] < 100
