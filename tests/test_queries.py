"""Every registered query runs; those with SQL give the same columns, types and rows."""

from __future__ import annotations

import pytest

import oracle
from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf_dir, con):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_a_stable_schema(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "key", "n"]
    assert df.count() > 0
