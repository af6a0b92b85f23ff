"""Every registered query against its statement, on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", KEYS)
def test_equals_statement(spark, sf, con, key):
    df = queries()[key](spark, sf)
    sql = oracle_sql().get(key)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    df = entry(spark)
    assert "total_revenue" in df.columns and df.count() > 0


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())
