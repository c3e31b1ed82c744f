"""Business tables kept up from changes, against rebuilds."""

from datetime import datetime as dt
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators.increments import SIGN, SumTable, before, changes, netted
from lakeloom.plans import gold, increments, kept, medallion, registry
from lakeloom.plans.increments import KeptGold, refresh_gold
from lakeloom.sources import tables
from lakeloom.sources.snapshot import ingest_snapshot
from tests.test_medallion import shop  # noqa: F401
from tests.test_streams import folder

TYPES = {"users": "id bigint", "orders": "order_id bigint, user_id bigint, num_of_item int, created_at timestamp, status string",
         "order_items": "id bigint, order_id bigint, product_id bigint, sale_price double",
         "products": "id bigint, category string", "events": "id bigint, user_id bigint, created_at timestamp"}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def world(seed):
    """Rows per table; a step edits them in place."""
    draw = np.random.default_rng(seed)
    pick = lambda n: int(draw.integers(n))
    day = lambda: dt(2024, 1, 1) + timedelta(days=pick(5), hours=pick(24))
    maybe = lambda v: None if pick(9) == 0 else v
    new = {"users": lambda i: (i,), "orders": lambda i: (i, maybe(pick(14)), maybe(pick(5)), maybe(day()), "ab"[pick(2)]),
           "order_items": lambda i: (i, maybe(pick(30)), maybe(pick(8)), maybe(round(draw.random() * 100, 2))),
           "products": lambda i: (i, maybe("ABC"[pick(3)])), "events": lambda i: (i, maybe(pick(14)), maybe(day()))}
    most = {"users": 12, "orders": 30, "order_items": 80, "products": 8, "events": 60}
    now = {n: {} for n in TYPES}

    def step(touch):
        for n in touch:
            for i in range(most[n]):
                kind = pick(4)
                if kind == 0:
                    now[n].pop(i, None)
                elif kind == 1 or not any(now[n].values()):
                    now[n][i] = [new[n](i)] * (2 if n == "order_items" and pick(4) == 0 else 1)
        return {n: [r for copies in now[n].values() for r in copies] for n in TYPES}

    return step


STEPS = [list(TYPES), ["order_items", "orders", "events"], ["products", "users"], list(TYPES)]


@pytest.mark.parametrize("name", ["sales_performance", "user_engagement", "user_statistics"])
def test_increments_equal_a_rebuild(spark, name):
    step, path = world(5), f"{folder()}/{name}"
    was = {n: spark.createDataFrame([], t) for n, t in TYPES.items()}
    rebuilt = {"sales_performance": lambda t: gold.sales_performance(t["order_items"], t["orders"], t["products"]),
               "user_engagement": lambda t: gold.user_engagement(t["events"]),
               "user_statistics": lambda t: gold.user_statistics(t["users"], t["orders"], t["order_items"], t["events"])}[name]
    for number, touch in enumerate(STEPS):
        now = {n: spark.createDataFrame(rows, TYPES[n]).coalesce(1) for n, rows in step(touch).items()}
        kept = KeptGold(spark, name, path)
        for _ in range(2 if number == 1 else 1):  # an increment that is repeated counts once
            kept.apply(number, now, {n: changes(was[n], now[n]) for n in touch})
        rounded = lambda df: rows_of(df.withColumn("total_revenue", F.round("total_revenue", 6)) if name[0] == "s" else df)
        want = rounded(rebuilt(now))
        assert rounded(kept.table()) == want and want
        if number == 2:
            kept.sums.compact()
            assert rounded(kept.table()) == want
        was = now


def test_changes_are_a_difference_of_bags(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (None, None), (4, "e"), (4, "e")], "k int, v string")
    change = changes(old, new)
    assert rows_of(change) == sorted([(1, "a", -1), (3, "c", -1), (3, "d", 1), (None, None, 1), (4, "e", 2)], key=str)
    back = netted(before(new, change))
    assert sum(([r[:2]] * r[SIGN] for r in back.collect()), []) and rows_of(back.drop(SIGN).exceptAll(old.distinct())) == []
    assert changes(old, old).collect() == []


def test_only_touched_keys_are_added(spark):
    now = {"events": spark.createDataFrame([(i, i % 50, dt(2024, 1, 1 + i % 28)) for i in range(500)], TYPES["events"])}
    kept = KeptGold(spark, "user_engagement", folder() + "/e")
    kept.apply(0, now, {"events": changes(now["events"].limit(0), now["events"])})
    less = {"events": now["events"].filter("id <> 7")}
    kept.apply(1, less, {"events": changes(now["events"], less["events"])})
    assert {r.increment: r.n for r in kept.sums._read("increments").groupBy("increment").agg(F.count("*").alias("n")).collect()} == {0: 50, 1: 1}
    assert {r.user_id: r.event_count for r in kept.table().collect()} == {u: 10 - (u == 7) for u in range(50)}


def joins_of(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_a_first_load_joins_each_table_once(spark):
    now = {n: spark.createDataFrame(rows, TYPES[n]).coalesce(1) for n, rows in world(3)(TYPES).items()}
    change = {n: changes(t.limit(0), t) for n, t in now.items()}
    assert joins_of(increments.sales_performance_changes(now, change)) == 2
    # tables that were there meet the changes of the others
    assert joins_of(increments.sales_performance_changes(now, {"products": change["products"], "orders": change["orders"].limit(5)})) == 2
    assert joins_of(increments.sales_performance_changes(now, {"order_items": change["order_items"].limit(5)})) == 2


def test_orders_that_keep_their_user_meet_no_items(spark):
    now = {n: spark.createDataFrame(rows, TYPES[n]).coalesce(1) for n, rows in world(3)(TYPES).items()}
    was = now["orders"].withColumn("num_of_item", F.lit(77)).withColumn("created_at", F.lit(dt(2023, 1, 1)))
    change = {"orders": changes(was, now["orders"])}
    assert joins_of(increments.user_statistics_changes(now, change)) == joins_of(increments.user_statistics_changes(now, {"users": changes(now["users"].limit(0), now["users"])}))


@pytest.mark.parametrize("name", ["sales_performance_kept", "user_statistics_kept", "user_engagement_kept"])
def test_the_history_is_told_row_by_row(spark, sf_dir, name, monkeypatch):
    """The signed rows fed in are the net difference of two times, and nothing else."""
    fed = []
    monkeypatch.setattr(kept.KeptGold, "apply", lambda self, number, now, change: fed.append((now, change)))
    registry.plans()[name](spark, sf_dir.replace("sf0.01", "sf0.001"))
    assert len(fed) == 3
    for k, (now, change) in enumerate(fed):
        for n, table in now.items():
            want = changes(fed[k - 1][0][n] if k else table.limit(0), table)
            got = change.get(n, table.limit(0).withColumn(SIGN, F.lit(1)))
            assert rows_of(netted(got).select(want.columns)) == rows_of(want)
            assert got.count() == want.agg(F.sum(F.abs(SIGN))).first()[0] or want.isEmpty() and got.isEmpty()


def test_sum_table_reads_base_and_later_increments(spark):
    t = SumTable(spark, folder() + "/sums", "k string", ["n"], "top int").create()
    assert t.rows().collect() == []
    t.compact()
    add = lambda number, *rows: t.add(number, spark.createDataFrame(rows, "k string, n int, top int"))
    add(0, ("a", 1, 5), (None, 2, 6))
    add(1, ("a", 3, None), ("b", 1, 1))
    assert rows_of(t.rows()) == sorted([("a", 4, None), (None, 2, 6), ("b", 1, 1)], key=str)
    add(2, ("b", -1, None))
    t.compact()
    assert rows_of(t.rows()) == sorted([("a", 4, None), (None, 2, 6)], key=str)
    add(3, ("b", 7, 9))
    assert rows_of(t.rows()) == sorted([("a", 4, None), (None, 2, 6), ("b", 7, 9)], key=str)


def test_from_bronze_to_gold(spark, shop):  # noqa: F811
    tables.initialize_namespaces(spark)
    rows = {n: ingest_snapshot(shop[n]) for n in ("orders", "order_items", "products")}
    silver = {n: medallion.with_audit(medallion.silver_rows(r, n)) for n, r in rows.items()}
    spark.sql("CREATE NAMESPACE IF NOT EXISTS kept")
    for n, df in silver.items():
        tables.overwrite_table(df, f"kept.{n}", tables.SILVER_LAYOUT[n])
    first = {}
    for n, df in silver.items():
        business = [c for c in df.columns if c != "updated_at"]
        changes(df.select(business).limit(0), spark.table(f"kept.{n}").select(business)).write.saveAsTable(f"kept.{n}_0")
        first[n] = f"kept.{n}_0"
    path = folder() + "/sales"
    refresh_gold(spark, "sales_performance", 0, path, first, "kept", "kept.sales")

    moved = (shop["orders"].filter("order_id = 10").withColumn("created_at", F.lit("2024-01-20").cast("timestamp"))
             .withColumn("updated_at", F.lit("2024-01-20").cast("timestamp")))
    ingest_snapshot(moved).withColumn("load_at", F.lit("2024-02-02").cast("timestamp")).write.saveAsTable("kept.bronze_orders")
    for _ in range(2):  # a rerun finds the change of the first attempt
        medallion.refresh_silver(spark, "orders", "2024-02-02", "kept.bronze_orders", "kept.orders", changes="kept.orders_1")
        spark.catalog.refreshTable("kept.orders")
        assert sorted((r.order_id, r.created_at.day, r[SIGN]) for r in spark.table("kept.orders_1").collect()) == [(10, 3, -1), (10, 20, 1)]
    refresh_gold(spark, "sales_performance", 1, path, {"orders": "kept.orders_1"}, "kept", "kept.sales")
    got = {(r.order_date.day, r.product_category): (r.total_revenue, r.total_items_sold) for r in spark.table("kept.sales").collect()}
    assert got == {(20, "A"): (10.0, 1), (20, "B"): (5.255, 1), (4, "A"): (2.0, 2)}
