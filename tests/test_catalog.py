"""Every registered query with SQL must equal DuckDB on the smallest tables; the others must run."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    rows = QUERIES[name](spark, SF).toPandas()
    assert len(rows) > 0
    assert difference(rows, duck.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)
