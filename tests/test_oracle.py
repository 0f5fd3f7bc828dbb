"""Every registered query runs; those with SQL give the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, folder, name):
    assert difference(QUERIES[name](spark, folder), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, folder, name):
    assert len(QUERIES[name](spark, folder).collect()) > 0


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 8
