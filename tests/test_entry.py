import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
