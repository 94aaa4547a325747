"""Every named query against its DuckDB statement."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from provfin.registry import oracle, queries

KEYS = list(queries.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_statement():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_duckdb(key, spark, sf_dir, con):
    assert difference(entry.queries()[key](spark, sf_dir), con, entry.oracle_sql()[key]) is None


def test_comparison_sees_a_changed_value(spark, con):
    rows = spark.sql("SELECT 1 AS a, 2.5D AS b")
    assert difference(rows, con, "SELECT 1 AS a, 2.5::DOUBLE AS b") is None
    assert difference(rows, con, "SELECT 1 AS a, 2.6::DOUBLE AS b") is not None
    assert difference(rows, con, "SELECT 1 AS a, 2.5::DOUBLE AS c") is not None


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
