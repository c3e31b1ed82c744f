"""Bronze, silver and gold jobs on small hand-made tables."""

from datetime import datetime as dt

import pytest

from lakeloom import schemas
from lakeloom.operators.conform import any_by_key, cast_failures, conform, latest_by_key
from lakeloom.plans import gold, medallion
from lakeloom.sources import tables
from lakeloom.sources.snapshot import JdbcSource, ingest_snapshot


def frame(spark, name, *rows):
    schema = schemas.SOURCE[name]
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def shop(spark):
    d = lambda n: dt(2024, 1, n)
    return {
        "users": frame(spark, "users", {"id": 1, "age": 30, "created_at": d(1), "updated_at": d(2)},
                       {"id": 2, "age": 40, "created_at": d(1), "updated_at": d(2)},
                       {"id": 3, "age": 50, "created_at": d(1), "updated_at": d(2)}),
        "orders": frame(spark, "orders",
                        {"order_id": 10, "user_id": 1, "created_at": d(3), "num_of_item": 2, "updated_at": d(3)},
                        {"order_id": 11, "user_id": 1, "created_at": d(4), "num_of_item": 1, "updated_at": d(4)},
                        {"order_id": 12, "user_id": 2, "created_at": d(5), "num_of_item": 1, "updated_at": d(5)}),
        "order_items": frame(spark, "order_items",
                             {"id": 1, "order_id": 10, "user_id": 1, "product_id": 7, "sale_price": 10.0},
                             {"id": 2, "order_id": 10, "user_id": 1, "product_id": 8, "sale_price": 5.255},
                             {"id": 3, "order_id": 11, "user_id": 9, "product_id": 7, "sale_price": 1.0},
                             {"id": 3, "order_id": 11, "user_id": 9, "product_id": 7, "sale_price": 1.0}),
        "products": frame(spark, "products", {"id": 7, "category": "A"}, {"id": 8, "category": "B"}),
        "events": frame(spark, "events", {"id": 1, "user_id": 1, "created_at": d(6)},
                        {"id": 2, "user_id": None, "created_at": d(7)}, {"id": 3, "user_id": None, "created_at": d(8)}),
    }


def test_sales_performance(shop):
    rows = {(r.order_date.day, r.product_category): (r.total_revenue, r.total_items_sold)
            for r in gold.sales_performance(shop["order_items"], shop["orders"], shop["products"]).collect()}
    assert rows == {(3, "A"): (10.0, 1), (3, "B"): (5.255, 1), (4, "A"): (2.0, 2)}


def test_user_engagement_keeps_the_null_user(shop):
    rows = {r.user_id: (r.event_count, r.last_event_at.day) for r in gold.user_engagement(shop["events"]).collect()}
    assert rows == {1: (1, 6), None: (2, 8)}


def test_user_statistics(shop):
    out = gold.user_statistics(shop["users"], shop["orders"], shop["order_items"], shop["events"])
    rows = {r.user_id: r for r in out.collect()}
    assert sorted(rows) == [1, 2, 3]  # ghosts add no user
    one = rows[1]
    # orders, not lines; items from the order; spend by the order's user
    assert (one.total_orders, one.total_items_purchased, one.total_spend, one.total_events) == (2, 3, 17.26, 1)
    assert one.last_order_at == dt(2024, 1, 4) and one.last_event_at == dt(2024, 1, 6)
    two, three = rows[2], rows[3]
    assert (two.total_orders, two.total_spend, two.total_events) == (1, 0.0, 0)
    assert (three.total_orders, three.total_items_purchased, three.last_order_at) == (0, 0, None)


def test_snapshot_columns(shop):
    out = ingest_snapshot(shop["users"])
    assert "source_updated_at" in out.columns and "load_at" in out.columns and "updated_at" not in out.columns
    assert ingest_snapshot(shop["products"]).columns[-1] == "load_at"


def test_latest_by_key_is_the_newest_in_any_order(spark):
    rows = [(k, v) for k in range(5) for v in range(20)]
    df = spark.createDataFrame(rows, "k int, v int")
    for parts in (1, 7):
        got = {r.k: r.v for r in latest_by_key(df.repartition(parts, "v"), ["k"], ["v"]).collect()}
        assert got == {k: 19 for k in range(5)}
    assert any_by_key(df, ["k"]).count() == 5


def test_latest_by_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_by_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_conform_nulls_bad_values_and_lists_them(spark):
    schema = schemas.flat("id BIGINT, at TIMESTAMP")
    df = spark.createDataFrame([("1", "2024-01-01 10:00:00"), ("x", "2024-01-02"), ("3", "soon"), ("4", None)], "id string, at string")
    out = conform(df, schema).collect()
    assert [r.id for r in out] == [1, None, 3, 4]
    assert [r.at is None for r in out] == [False, False, True, True]
    failed = {r.id: r.failed_columns for r in cast_failures(df, schema).collect()}
    assert failed == {"x": ["id"], "3": ["at"]}


def test_jobs_are_repeatable(spark, shop):
    tables.initialize_namespaces(spark)
    golds = ("user_statistics", "user_engagement", "sales_performance")

    def values(name):
        kept = [c for c in schemas.GOLD[name].fieldNames() if c != "updated_at"]
        return sorted(map(str, spark.read.table(f"gold.{name}").select(*kept).collect()))

    seen = []
    for snapshot in range(2):  # the second one loads the same rows again
        for name, df in shop.items():
            medallion.to_bronze(df, name)
            medallion.to_silver(spark, name)
            medallion.to_silver(spark, name)
        for name in golds:
            medallion.to_gold(spark, name)
            medallion.to_gold(spark, name)
            assert set(schemas.GOLD[name].fieldNames()) <= set(spark.read.table(f"gold.{name}").columns)
        seen.append([values(name) for name in golds])
        assert spark.read.table("bronze.orders").count() == 3 * (snapshot + 1)
        assert spark.read.table("silver.orders").count() == 3
        assert spark.read.table("silver.order_items").count() == 4  # repeats inside a snapshot stay
    assert seen[0] == seen[1] and all(seen[0])
    sales = {(r.order_date.day, r.product_category): (r.total_revenue, r.total_items_sold)
             for r in spark.read.table("gold.sales_performance").collect()}
    assert sales == {(3, "A"): (10.0, 1), (3, "B"): (5.255, 1), (4, "A"): (2.0, 2)}


def test_bronze_is_partitioned_and_pruned_by_load_day(spark, shop):
    tables.initialize_namespaces(spark)
    medallion.to_bronze(shop["orders"], "orders", "bronze.orders_days")
    medallion.to_bronze(shop["products"], "products", "bronze.products_days")
    parts = lambda t: [r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()]
    assert len(parts("bronze.orders_days")) == 3 and all(
        p.startswith("load_at_day=") and "created_at_day=2024-01-0" in p for p in parts("bronze.orders_days"))
    assert sorted(p.split("category=")[1] for p in parts("bronze.products_days")) == ["A", "B"]
    rows = medallion.loaded_since(spark.read.table("bronze.orders_days"), "2024-02-02")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "load_at_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_refresh_moves_rows_between_days_and_replaces_order_items(spark, shop):
    from pyspark.sql import functions as F
    tables.initialize_namespaces(spark)

    def load(name, df, loaded, first=False):
        rows = ingest_snapshot(df).withColumn("load_at", F.lit(loaded).cast("timestamp"))
        rows.write.mode("overwrite" if first else "append").saveAsTable(f"bronze.{name}_moved")
        if first:
            tables.overwrite_table(medallion.with_audit(medallion.silver_rows(spark.table(f"bronze.{name}_moved"), name)),
                                   f"silver.{name}_moved", tables.SILVER_LAYOUT[name])
        else:
            for _ in range(2):
                medallion.refresh_silver(spark, name, loaded, f"bronze.{name}_moved", f"silver.{name}_moved")
                spark.catalog.refreshTable(f"silver.{name}_moved")

    load("orders", shop["orders"], "2024-02-01", first=True)
    moved = (shop["orders"].filter("order_id = 10").withColumn("created_at", F.lit("2024-01-20").cast("timestamp"))
             .withColumn("updated_at", F.lit("2024-01-20").cast("timestamp")))
    load("orders", moved, "2024-02-02")
    got = {(r.order_id, r.created_at.day) for r in spark.table("silver.orders_moved").collect()}
    assert got == {(10, 20), (11, 4), (12, 5)} and spark.table("silver.orders_moved").count() == 3
    items = shop["order_items"].withColumn("created_at", F.lit("2024-01-03").cast("timestamp"))
    load("order_items", items, "2024-02-01", first=True)
    load("order_items", items.filter("id = 3").withColumn("sale_price", F.lit(2.0)), "2024-02-02")
    assert sorted((r.id, r.sale_price) for r in spark.table("silver.order_items_moved").collect()) == [
        (1, 10.0), (2, 5.255), (3, 2.0), (3, 2.0)]


def test_silver_takes_the_newest_snapshot(spark, shop):
    from pyspark.sql import functions as F
    old = ingest_snapshot(shop["orders"]).withColumn("load_at", F.lit("2024-02-01").cast("timestamp"))
    new = (ingest_snapshot(shop["orders"]).withColumn("load_at", F.lit("2024-02-02").cast("timestamp"))
           .withColumn("status", F.lit("Shipped")))
    rows = medallion.silver_rows(old.unionByName(new), "orders").collect()
    assert len(rows) == 3 and {r.status for r in rows} == {"Shipped"}


def test_refresh_rewrites_only_touched_days(spark, shop):
    import glob
    import os

    from pyspark.sql import functions as F
    tables.initialize_namespaces(spark)

    def snapshot(df, loaded):
        rows = ingest_snapshot(df).withColumn("load_at", F.lit(loaded).cast("timestamp"))
        rows.write.mode("append").saveAsTable("bronze.orders_inc")

    old = shop["orders"]
    snapshot(old, "2024-02-01")
    tables.overwrite_table(medallion.with_audit(medallion.silver_rows(spark.table("bronze.orders_inc"), "orders")),
                           "silver.orders_inc", tables.SILVER_LAYOUT["orders"])
    place = spark.sql("DESCRIBE EXTENDED silver.orders_inc").filter("col_name = 'Location'").first().data_type.replace("file:", "")
    stamp = lambda: {d: sorted(os.listdir(d)) for d in glob.glob(place + "/created_at_day=*")}
    before = stamp()
    changed = (old.filter("order_id = 10").withColumn("status", F.lit("Shipped"))
               .withColumn("updated_at", F.lit("2024-01-09").cast("timestamp")))
    added = old.filter("order_id = 10").withColumn("order_id", F.lit(13).cast("bigint"))
    stale = old.filter("order_id = 11").withColumn("status", F.lit("Lost")).withColumn("updated_at", F.lit("2023-01-01").cast("timestamp"))
    snapshot(changed.unionByName(added).unionByName(stale), "2024-02-02")
    for _ in range(2):
        medallion.refresh_silver(spark, "orders", "2024-02-02", "bronze.orders_inc", "silver.orders_inc")
        spark.catalog.refreshTable("silver.orders_inc")
        got = {r.order_id: r.status for r in spark.table("silver.orders_inc").collect()}
        assert got == {10: "Shipped", 11: None, 12: None, 13: None}
    after = stamp()
    same = {os.path.basename(d) for d in before if before[d] == after[d]}
    assert same == {"created_at_day=2024-01-05"}
    with pytest.raises(ValueError):
        medallion.refresh_silver(spark, "products", "2024-01-01", "bronze.orders_inc", "silver.orders_inc")


def test_jdbc_options():
    whole = JdbcSource("jdbc:x", "t", "u", "p", one_task=True).options()
    assert "partitionColumn" not in whole and whole["dbtable"] == "t"
    split = JdbcSource("jdbc:x", "t", "u", "p", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=4).options()
    assert split["numPartitions"] == "4" and split["lowerBound"] == "0"
    for partial in ({"partition_column": "id"}, {}):
        with pytest.raises(ValueError):
            JdbcSource("jdbc:x", "t", "u", "p", **partial).options()


def test_silver_findings(spark, shop):
    held = dict(shop, inventory_items=frame(spark, "inventory_items"), distribution_centers=frame(spark, "distribution_centers"))
    held["orders"] = held["orders"].unionByName(frame(
        spark, "orders", {"order_id": 12, "user_id": 7, "num_of_item": 0, "status": "Lost", "created_at": dt(2024, 1, 9), "updated_at": dt(2024, 1, 8)},
        {"order_id": 13, "user_id": None, "num_of_item": 1, "status": "Shipped"}))
    read = lambda n: conform(held[n].withColumnRenamed("updated_at", "source_updated_at"), schemas.silver_schema(n))
    found = lambda n: sorted(tuple(r) for r in medallion.silver_findings(read, n).collect())
    rules = {"num_items_positive", "valid_status", "updated_after_created"}
    assert found("orders") == sorted([("orders", "12", "rule", r, 1) for r in rules]
                                     + [("orders", "12", "orphan", "user_id", 1), ("orders", "12", "duplicate", "order_id", 2)])
    assert found("order_items") == [("order_items", "3", "orphan", "user_id", 1)] * 2   # may repeat, so no duplicate
    assert found("distribution_centers") == [] and found("users") == [] and found("events") == []


def test_check_silver_writes_its_findings(spark, shop):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS checked")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS quality")
    young = frame(spark, "users", {"id": 1, "age": 3}, {"id": 2, "age": 40}, {"id": 2, "age": 200})
    young = young.withColumnRenamed("updated_at", "source_updated_at")
    conform(young, schemas.silver_schema("users")).write.mode("overwrite").saveAsTable("checked.users")
    for _ in range(2):
        got = {(r.kind, r.detail): r.findings for r in medallion.check_silver(spark, "users", "checked").collect()}
        assert got == {("rule", "age_valid"): 2, ("duplicate", "id"): 1}
    assert spark.table("quality.users").count() == 3
