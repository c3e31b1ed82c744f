"""Business tables over the silver e-commerce tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sales_performance(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and items sold per order day and product category."""
    sold = (order_items.select("order_id", "product_id", "sale_price")
            .join(orders.select("order_id", F.date_trunc("day", "created_at").alias("order_date")), "order_id")
            .join(products.select(F.col("id").alias("product_id"), F.col("category").alias("product_category")), "product_id"))
    return sold.groupBy("order_date", "product_category").agg(
        F.sum("sale_price").alias("total_revenue"), F.count(F.lit(1)).alias("total_items_sold"))


def user_engagement(events: DataFrame) -> DataFrame:
    """Events and last event time per user; events without a user form one row."""
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("event_count"),
                                         F.max("created_at").alias("last_event_at"))


def user_statistics(users: DataFrame, orders: DataFrame, order_items: DataFrame, events: DataFrame) -> DataFrame:
    """Orders, items, spend and events per user, zero-filled; every user once.

    Spend goes to the user of the order. Items are summed per order before they
    meet the orders, so a large order crosses the shuffle as one row, and orders
    and spend are grouped by user in one aggregation."""
    spend = order_items.groupBy("order_id").agg(F.sum("sale_price").alias("order_spend"))
    per_user = (orders.select("order_id", "user_id", "num_of_item", "created_at").join(spend, "order_id", "left")
                .groupBy("user_id").agg(
                    F.count("order_id").alias("total_orders"), F.sum("num_of_item").alias("total_items_purchased"),
                    F.sum("order_spend").alias("total_spend"), F.max("created_at").alias("last_order_at")))
    activity = events.groupBy("user_id").agg(F.count("id").alias("total_events"), F.max("created_at").alias("last_event_at"))
    zero = F.lit(0).cast("bigint")
    return (users.select(F.col("id").alias("user_id")).join(per_user, "user_id", "left").join(activity, "user_id", "left")
            .select("user_id", F.coalesce("total_orders", zero).alias("total_orders"),
                    F.coalesce("total_items_purchased", zero).alias("total_items_purchased"),
                    F.round(F.coalesce("total_spend", F.lit(0.0)), 2).alias("total_spend"),
                    F.coalesce("total_events", zero).alias("total_events"), "last_order_at", "last_event_at"))
