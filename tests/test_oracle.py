"""Every registered query against DuckDB on the smallest tables."""

import pytest
from conftest import FOLDER
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_text_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_duckdb(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
