"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, small, name):
    assert compare(spark, con, small, name, entry.queries()[name], SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
