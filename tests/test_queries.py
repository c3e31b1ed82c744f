"""Every registered query against its check SQL on the given tables."""

import pytest

import __spark_entry__ as entry_point
from lakeloom.plans import registry
from tests.oracle import compare, connect

# those of the optional subpackage have tests beside its own
QUERIES = {n: q for n, q in entry_point.queries().items() if n in registry.plans()}
SQL = {n: q for n, q in entry_point.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# The only plans with Python in a task.
PYTHON = {"kalman_smooth", "kalman_rts"}


def check_shape(df, name):
    """No pairs, and Python only where stated."""
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert ("Python" in p or "Pandas" in p) == (name in PYTHON)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert compare(df, con, SQL[name]) == []
    check_shape(df, name)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert len(df.collect()) > 0
    check_shape(df, name)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["order_date", "product_category", "total_revenue", "total_items_sold"]
    assert df.count() > 0
