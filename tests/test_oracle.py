"""Every query with an SQL twin gives the twin's columns, types and rows."""

import pytest

import __spark_entry__ as entry_points
from check import compare, connect

ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, small, name):
    assert compare(entry_points.queries()[name](spark, small), duck, ORACLES[name]) == []


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["location_anomaly_score"] for r in sorted(rows)] == [0, 1, 2]
