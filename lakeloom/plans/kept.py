"""Business tables over the given tables, kept up over a history of three increments:
a first part of the rows, then the rest with corrections, then deletions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.increments import SIGN
from lakeloom.plans.increments import KeptGold
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star
from lakeloom.sources.frames import shared_folder, written_once


@dataclass(frozen=True)
class _Version:
    """What rows of a table looked like at a time: which were there, and their columns."""

    there: Column
    columns: dict[str, Column]

    def of(self, rows: DataFrame, where: Column | None = None) -> DataFrame:
        there = F.coalesce(self.there, F.lit(False))
        return rows.filter(there if where is None else there & where).select(*[v.alias(n) for n, v in self.columns.items()])


def _between(rows: DataFrame, was: _Version | None, now: _Version) -> DataFrame:
    """Signed rows that turn one version (None: nothing) into the next, each told from its own row."""
    if was is None:
        return now.of(rows).withColumn(SIGN, F.lit(1))
    moved = reduce(or_, (~v.eqNullSafe(now.columns[n]) for n, v in was.columns.items()))
    other = lambda v: ~F.coalesce(v.there, F.lit(False)) | moved
    return (was.of(rows, other(now)).withColumn(SIGN, F.lit(-1))
            .unionByName(now.of(rows, other(was)).withColumn(SIGN, F.lit(1))))


def _history(s: Star, used: tuple[str, ...]) -> Iterator[tuple[dict[str, DataFrame], dict[str, DataFrame]]]:
    """The ``used`` silver tables at three times, each with the changes since the time before. At first
    there are the orders before 1997, those in progress under a later day, large parts without their
    category, cheap lines at another price, and events before mid-January; then all rows as given; in the
    end returned lines have gone and error events have lost their user. With users, orders hold their
    number of lines. Whether a line's order is an early one is found once and written with the line."""
    c, always = F.col, F.lit(True)
    first = c("sold_at") < F.lit("1997-01-01").cast("timestamp_ntz")
    orders, tables = s.orders.select("order_id", "buyer_id", "sold_at", "status"), {}
    if "order_items" in used:
        early = written_once(orders.filter(first).select("order_id").distinct(), "early_orders").withColumn("early", always)
        columns = ["order_id", *(["item_id"] if "products" in used else []), "gross", "returned"]
        lines = written_once(s.lines.select(*columns).join(early, "order_id", "left"), "lines")
        given = {"order_id": c("order_id")} | ({"product_id": c("item_id")} if "products" in used else {}) | {"sale_price": c("gross")}
        cheap = given | {"sale_price": F.when(c("gross") < 5000, c("gross") * 2).otherwise(c("gross"))}
        tables["order_items"] = lines, _Version(c("early"), cheap), _Version(always, given), _Version(~c("returned"), given)
    if "orders" in used:
        given = {"order_id": c("order_id"), "user_id": c("buyer_id"), "created_at": c("sold_at")}
        less = given
        if "users" in used:
            counts = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("all_lines"), F.nullif(F.count_if(~c("returned")), F.lit(0)).alias("left_lines"))
            orders = written_once(orders.join(counts, "order_id", "left"), "orders")
            given, less = given | {"num_of_item": c("all_lines")}, given | {"num_of_item": c("left_lines")}
        later = F.when(c("status") == "P", c("sold_at") + F.expr("INTERVAL 3 DAYS")).otherwise(c("sold_at"))
        tables["orders"] = orders, _Version(first, given | {"created_at": later}), _Version(always, given), _Version(always, less)
    if "products" in used:
        given = {"id": c("item_id"), "category": c("item_class")}
        whole = _Version(always, given)
        unsorted = given | {"category": F.when(c("item_size") <= 25, c("item_class"))}
        tables["products"] = s.item, _Version(always, unsorted), whole, whole
    if "events" in used:
        given = {"id": c("event_id"), "user_id": c("user_id"), "created_at": c("ts")}
        lost = given | {"user_id": F.when(c("event_type") != "error", c("user_id"))}
        mid = c("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
        tables["events"] = s.events, _Version(mid, given), _Version(always, given), _Version(always, lost)
    if "users" in used:
        whole = _Version(always, {"id": c("c_custkey")})
        tables["users"] = s.table("customer"), whole, whole, whole
    for k in range(3):
        yield ({n: versions[k].of(rows) for n, (rows, *versions) in tables.items()},
               {n: _between(rows, versions[k - 1] if k else None, versions[k]) for n, (rows, *versions) in tables.items()
                if not k or versions[k] is not versions[k - 1]})


def _kept(s: Star, name: str, *used: str) -> DataFrame:
    kept = KeptGold(s.spark, name, f"{shared_folder(s.spark)}/kept-{uuid.uuid4().hex}/{name}", "timestamp_ntz")
    for number, (now, change) in enumerate(_history(s, used)):
        kept.apply(number, now, change)
    return kept.table()


@query("sales_performance_kept", """
SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS order_date, p_type AS product_category,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(20, 6))) AS DOUBLE), 2) AS total_revenue, count(*) AS total_items_sold
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE l_returnflag <> 'R' GROUP BY 1, 2""", star=False)
def sales_performance_kept(s: Star):
    out = _kept(s, "sales_performance", "order_items", "orders", "products")
    return out.withColumn("total_revenue", F.round("total_revenue", 2))


@query("user_engagement_kept", """
SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, count(*) AS event_count, max(ts) AS last_event_at
FROM events GROUP BY 1""", star=False)
def user_engagement_kept(s: Star):
    return _kept(s, "user_engagement", "events")


@query("user_statistics_kept", """
WITH kept AS (SELECT * FROM lineitem WHERE l_returnflag <> 'R'),
orders_of AS (
  SELECT o_custkey, count(*) AS total_orders, max(o_orderdate) AS last_order_at FROM orders GROUP BY o_custkey),
lines_of AS (
  SELECT o_custkey, count(*) AS total_items_purchased, CAST(sum(CAST(l_extendedprice AS DECIMAL(20, 6))) AS DOUBLE) AS spend
  FROM kept JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey),
events_of AS (
  SELECT user_id, count(*) AS total_events, max(ts) AS last_event_at FROM events WHERE event_type <> 'error' GROUP BY user_id)
SELECT c_custkey AS user_id, coalesce(total_orders, 0) AS total_orders, coalesce(total_items_purchased, 0) AS total_items_purchased,
       round(coalesce(spend, 0.0), 2) AS total_spend, coalesce(total_events, 0) AS total_events, last_order_at, last_event_at
FROM customer c LEFT JOIN orders_of o ON o.o_custkey = c_custkey LEFT JOIN lines_of l ON l.o_custkey = c_custkey
  LEFT JOIN events_of ON user_id = c_custkey""", star=False)
def user_statistics_kept(s: Star):
    return _kept(s, "user_statistics", "users", "orders", "order_items", "events")
