"""Every query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from check import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    """The same rows, from a plan without products of rows and without Python."""
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert bad not in plan
    assert differences(con, name, df)[0] == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "story_id" in df.columns
