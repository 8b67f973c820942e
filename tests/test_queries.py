"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from riskspark.registry import oracle_sql, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duckdb_tables(small):
    return duck(small)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, duckdb_tables, name):
    assert difference(spark, duckdb_tables, small, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["decision_date", "channel", "decision"]
    assert df.count() > 0


def test_registry_is_complete():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 80
