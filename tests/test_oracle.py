"""Every catalogue query with an SQL equivalent gives the rows DuckDB gives."""

import pytest
from compare import connect, difference

from __spark_entry__ import oracle_sql, queries

TABLES = "/root/testdata/sf0.001"
SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def con():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, TABLES), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_give_rows(spark, name):
    assert not QUERIES[name](spark, TABLES).isEmpty()


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
