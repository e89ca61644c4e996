"""Every registered query agrees with its SQL in rows, values and types."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, duck_types, spark_rows, spark_types

import __spark_entry__ as driver

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert spark_types(df) == duck_types(con, SQL[name])
    columns, rows = spark_rows(df)
    expected_columns, expected = duck_rows(con, SQL[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
