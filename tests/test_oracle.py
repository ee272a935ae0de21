"""Every query with SQL gives the rows, values and types DuckDB gives on the same tables."""

import pytest
from check import compare, compare_types, connect

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = queries()[name](spark, sf_dir)
    assert compare(df, connection, oracle_sql()[name]) == []
    assert compare_types(df, connection, oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0
