"""Every registered query against its SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry_point
from tariffbook.plans import catalogue, oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalogue.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    with compare.duck(SF_DIR) as connection:
        yield connection


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), connection, SQL[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
