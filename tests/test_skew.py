"""Plans on tables in which single keys hold a third of the rows, with all joins
as sort-merge joins (no side small enough to broadcast)."""

import tempfile

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.oracle import TABLES, compare, connect

NAMES = """sales_performance user_statistics user_engagement above_group_avg silver_latest_by_key theta_stock
multi_source_orders web_brand_returns unreturned overlap_counts rollup_topn rollup_rank dual_rank best_worst
cumulative_cross gps_latest_state gps_active_routes run_summary low_share_items revenue_ratio upsert_merge""".split()


@pytest.fixture(scope="module")
def hot_dir():
    source, out = "/root/testdata/sf0.001", tempfile.mkdtemp(prefix="run-", dir="/tmp")
    con = duckdb.connect()
    changes = {
        "lineitem": """CASE WHEN row_number() OVER () % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey,
                       CASE WHEN row_number() OVER () % 5 IN (0, 1) THEN 11 ELSE l_partkey END AS l_partkey,
                       CASE WHEN row_number() OVER () % 7 IN (0, 1, 2) THEN 3 ELSE l_suppkey END AS l_suppkey""",
        "orders": "CASE WHEN row_number() OVER () % 3 = 1 THEN 5 ELSE o_custkey END AS o_custkey",
        "events": "CASE WHEN row_number() OVER () % 3 = 1 THEN 5 ELSE user_id END AS user_id",
    }
    for t in TABLES:
        columns = f"* REPLACE ({changes[t]})" if t in changes else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{source}/{t}.parquet') TO '{out}/{t}.parquet' (FORMAT parquet)")
    return out


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, hot_dir, no_broadcast, name):
    problems = compare(entry_point.queries()[name](spark, hot_dir), connect(hot_dir), entry_point.oracle_sql()[name])
    assert [p for p in problems if p != "EMPTY"] == []


def test_a_hot_join_partition_is_split(spark):
    from pyspark.sql import functions as F

    from lakeloom.session import apply_defaults

    apply_defaults(spark)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
        dims = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("d"))
        out = facts.join(dims, "k").groupBy("k").agg(F.sum("v").alias("s"))
        assert sum(r.s for r in out.collect()) == sum(range(300_000))
        assert "skewed" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
