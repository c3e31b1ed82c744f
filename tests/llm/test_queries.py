"""Registered queries against their check SQL, and the plans of the native ones."""

import pytest

import __spark_entry__ as entry_point
from lakeloom.llm.queries import QUERIES, check_sql
from tests.oracle import compare, connect


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(check_sql()))
def test_matches_sql(spark, sf_dir, name):
    assert compare(entry_point.queries()[name](spark, sf_dir), connect(sf_dir), entry_point.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["op1_sharding", "op3_mixing", "op5_quality_rules"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_all_are_registered():
    named = entry_point.queries()
    assert set(QUERIES) <= set(named) and "pipeline" in named
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
