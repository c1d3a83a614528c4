"""Every registered query against DuckDB: same columns, rows, values and types, and no Python in its plan."""

import re

import pytest
from compare import TABLES, differences, duck

from __spark_entry__ import entry
from tillwise.plans.catalog import registered as queries
from tillwise.plans.oracle import oracle as oracle_sql

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    assert differences(df, con, oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|ArrowEval|MapInPandas|FlatMapGroups|CartesianProduct|NestedLoopJoin", plan)


def test_entry_gives_growth_by_month(spark):
    df = entry(spark)
    assert {"month", "revenue", "mom_growth_pct", "yoy_growth_pct"} <= set(df.columns)
    assert df.count() == 80


@pytest.mark.parametrize("name", ["abc_analysis", "rfm", "clv_by_segment", "bcg_matrix", "churn_risk", "kpis"])
def test_same_rows_over_many_partitions(spread, con, name):
    assert differences(queries()[name](spread, FOLDER), con, oracle_sql()[name]) is None
