"""Every registered query against its SQL, and none with a Python worker in its plan."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from tidemark.queries.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, entry.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "user_name"]
    assert df.count() > 0
