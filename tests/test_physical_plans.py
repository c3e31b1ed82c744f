"""Shape of the physical plans."""

import pytest

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    p = plan_of(QUERIES["star_topk_brand"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,2000-11-01T00:00)" in p
    schemas = [line for line in QUERIES["star_topk_brand"](spark, sf_dir)._jdf.queryExecution().toString().split("ReadSchema: ")[1:]]
    assert any(s.startswith("struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>") for s in schemas)


def test_without_broadcast_the_joins_are_sort_merge(spark, sf_dir):
    """Dimensions too big to broadcast still give equi-joins and equal results."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = sorted(map(str, QUERIES["above_avg_returners"](spark, sf_dir).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["above_avg_returners"](spark, sf_dir)
        assert sorted(map(str, df.collect())) == small
        p = plan_of(df)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p and "NestedLoop" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_published_tables_join_without_shuffling_facts(spark, sf_dir):
    from lakeloom.plans.registry import plan
    from lakeloom.plans.star import Star, publish

    star = publish(Star(spark, "/root/testdata/sf0.001"), "published", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_of(star.sales)
        assert "SortMergeJoin" in plan_of(star.sales)
        per_order = plan("basket_counts", star)
        assert plan_of(per_order).count("Exchange hashpartitioning(order_id") == 0
        got = sorted(map(str, per_order.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(str, QUERIES["basket_counts"](spark, "/root/testdata/sf0.001").collect()))


def test_a_fact_is_scanned_once(spark, sf_dir):
    """Variants of one fact are conditional sums of a single pass."""
    for name in ("repurchase_chain", "multi_source_orders", "net_sales", "unreturned", "intersect_channels",
                 "growth_compare", "lag_lead", "week_over_year", "cov_pairs", "cumulative_cross", "side_by_side"):
        p = plan_of(QUERIES[name](spark, sf_dir))
        assert p.count("lineitem.parquet") <= 1 and p.count("orders.parquet") <= 1, name


@pytest.mark.parametrize("name, most", [("best_worst", 12), ("dual_rank", 12), ("run_summary", 8), ("gps_retain_latest", 3)])
def test_branches_read_written_frames(spark, sf_dir, name, most):
    """Plans with several branches over one aggregate do not repeat it: what is left reads
    small frames, and no fact table but for the capped log's own rows."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.count("Exchange") - plan.count("BroadcastExchange") <= most
    assert plan.count("lineitem.parquet") == plan.count("orders.parquet") == 0
