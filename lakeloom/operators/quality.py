"""Row rules, reference checks and key checks as aggregations and anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rules_for(table: str) -> dict[str, Column]:
    """Row rules of the e-commerce tables. A rule that gives NULL passes."""
    c = F.col

    def not_before(later: str, earlier: str) -> Column:
        return c(later) >= c(earlier)

    lifecycle = {
        "updated_after_created": not_before("updated_at", "created_at"),
        "shipped_after_created": not_before("shipped_at", "created_at"),
        "delivered_after_shipped": not_before("delivered_at", "shipped_at"),
        "returned_after_delivered": c("returned_at").isNull()
        | (c("delivered_at").isNotNull() & not_before("returned_at", "delivered_at")),
    }
    # Bounds and domains of the source tables.
    rules = {
        "users": {
            "age_valid": c("age").between(12, 120),
            "updated_after_created": lifecycle["updated_after_created"],
        },
        "products": {"non_negative_prices": (c("cost") >= 0) & (c("retail_price") >= 0)},
        "inventory_items": {
            "cost_non_negative": c("cost") >= 0,
            "sold_after_created": not_before("sold_at", "created_at"),
        },
        "orders": {
            "num_items_positive": c("num_of_item") >= 1,
            "valid_status": c("status").isin("Processing", "Shipped", "Complete", "Returned", "Cancelled"),
            **lifecycle,
        },
        "order_items": {"sale_price_non_negative": c("sale_price") >= 0, **lifecycle},
        "events": {
            "sequence_positive": c("sequence_number") >= 1,
            "type_valid": c("event_type").isin(
                "home", "department", "category", "product", "cart", "purchase", "cancel", "return"),
        },
        "distribution_centers": {},
    }
    return rules[table]


# Child table -> (foreign key, parent table, parent key).
FOREIGN_KEYS = {
    "products": [("distribution_center_id", "distribution_centers", "id")],
    "inventory_items": [("product_id", "products", "id"),
                        ("product_distribution_center_id", "distribution_centers", "id")],
    "orders": [("user_id", "users", "id")],
    "order_items": [("order_id", "orders", "order_id"), ("user_id", "users", "id"),
                    ("product_id", "products", "id"), ("inventory_item_id", "inventory_items", "id")],
    "events": [("user_id", "users", "id")],
}


def violates(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(True))


def check_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with its number of violations, in one pass."""
    counted = df.agg(*[F.count_if(violates(r)).alias(n) for n, r in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def violating_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of the broken rules."""
    broken = F.array_compact(F.array(*[F.when(violates(r), F.lit(n)) for n, r in rules.items()]))
    return df.withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    ids = parent.select(F.col(parent_key or key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(ids, key, "left_anti").select(child.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "copies") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)
