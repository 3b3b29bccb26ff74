"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TEXT = {name for name in driver.queries() if name == "pipeline" or name.startswith("op")}  # tested with their package
QUERIES = {name: query for name, query in driver.queries().items() if name not in TEXT}
SQL = {name: sql for name, sql in driver.oracle_sql().items() if name not in TEXT}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not present")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(found, duck.execute(SQL[name]).df()) == ""
    assert len(found) > 0


def test_entry(spark):
    found = {r["instrument_id"]: r for r in driver.entry(spark).collect()}
    assert len(found) == 10
    # Expected values of the flagship query.
    assert (found["0"]["var_95_pct"], found["0"]["var_99_pct"], found["0"]["cvar_95_pct"], found["0"]["returns"]) == (
        -0.950795, -0.991054, -0.966907, 63)
    assert (found["1"]["var_95_pct"], found["1"]["var_99_pct"], found["1"]["cvar_95_pct"], found["1"]["returns"]) == (
        -0.865529, -0.998805, -0.950052, 55)


def test_sample(spark):
    assert QUERIES["bronze_sample"](spark, FOLDER).count() == 10


NESTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonMap")


@pytest.mark.parametrize(
    "name", ["instrument_var", "complete_risk_metrics", "portfolio_history", "counterparty_risk", "bronze_validation"])
def test_plans_stay_in_the_engine(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in NESTED if word in plan]


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["daily_returns"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
