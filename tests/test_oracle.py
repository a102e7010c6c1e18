"""Every query with a SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert max(r["rank"] for r in rows) == 10


def test_every_sql_text_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
