"""Every registered query with checking SQL equals DuckDB on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import connect, differences

# Joins of all pairs, and rows handed to Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    found = entry.queries()[name](spark, FOLDER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in UNWANTED if op in plan]
    result = found.toArrow()
    assert differences(result, duck.sql(entry.oracle_sql()[name]).to_arrow_table()) == []


def test_checker_notices_differences(duck):
    def table(sql):
        return duck.sql(sql).to_arrow_table()

    assert differences(table("SELECT 1.0e0 AS a"), table("SELECT 1.1e0 AS a"))
    assert differences(table("SELECT 1 AS a"), table("SELECT 1 AS b"))
    assert differences(table("SELECT 1 AS a"), table("SELECT 1 AS a UNION ALL SELECT 1"))
    assert differences(table("SELECT CAST(1 AS BIGINT) AS a"), table("SELECT 1 AS a"))


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 3


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
