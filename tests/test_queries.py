"""Every registered query against its SQL, and the driver's contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload.check import compare, duck
from workload.roles import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(ORACLES) == {"m5_forest", "m8_dominant_vectors"}
    assert entry.entry(spark).count() > 0


def check_plan(df):
    """No pair of tables is crossed and no row goes through a plain Python function."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Scan ExistingRDD"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    check_plan(df)
    assert compare(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF)
    check_plan(df)
    assert df.count() > 0 and len(df.columns) > 1
