"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert ok, note


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    row = entry(spark).first()
    assert row.n_rows == row.tp + row.tn + row.fp + row.fn > 0
