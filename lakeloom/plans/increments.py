"""Business tables kept up from changes of the silver tables.

Each function takes the silver tables as they are now and their changes (signed rows of
`operators.increments.changes`; a table that is not named has not changed) and gives what is to be added to
the sums of the touched keys. The change of a join is a sum of joins, in each of which one side is a
change: a table already handled is taken as it is now, one still to come as it was before. Joins with a
table that was empty give nothing and are left out, as at a first load. Prices stay as given up to the sums."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.conform import with_audit
from lakeloom.operators.increments import SIGN, SumTable, before, exact, met, netted, signed
from lakeloom.sources import tables
from lakeloom.sources.frames import written_once

Tables = Mapping[str, DataFrame]


def _some(rows: DataFrame) -> DataFrame | None:
    return None if rows.isEmpty() else rows


def _narrow(now: Tables, change: Tables, name: str, *columns: Column) -> tuple[DataFrame, DataFrame | None]:
    """The wanted columns of a table and of its net changes; None where these have not changed."""
    table = now[name].select(*columns)
    if name not in change:
        return table, None
    return table, _some(written_once(netted(change[name].select(*columns, SIGN)), f"{name}_changes"))


def _slim(now: Tables, change: Tables, name: str, *columns: Column) -> tuple[DataFrame, DataFrame | None]:
    """As `_narrow`, for changes that are read once, into sums: these cancel there, so the changes of a
    large table are neither shuffled nor written beforehand."""
    return now[name].select(*columns), _some(change[name].select(*columns, SIGN)) if name in change else None


def _was(now: DataFrame, change: DataFrame | None, net: bool = False) -> DataFrame | None:
    """The table before its change; None if it was empty, which two counts tell. With ``net`` a row that
    has come is taken out before it can meet others, once as now and once as a change."""
    if change is None:
        return signed(now)
    came = change.agg(F.sum(SIGN)).first()[0]  # one number
    if now.count() == came:
        return None
    return netted(before(now, change)) if net else before(now, change)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value * F.col(SIGN)), F.lit(0))


def _united(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def sales_performance_changes(now: Tables, change: Tables) -> DataFrame | None:
    """Per touched (order_date, product_category): revenue, priced and items to be added."""
    c = F.col
    items, d_items = _slim(now, change, "order_items", c("order_id"), c("product_id"), c("sale_price"))
    day = F.date_trunc("day", "created_at").alias("order_date")
    products, d_products = _narrow(now, change, "products", c("id").alias("product_id"), c("category").alias("product_category"))
    parts, old_products = [], _was(products, d_products, net=True)
    if old_products is not None:
        orders, d_orders = _narrow(now, change, "orders", c("order_id"), day)
        if d_items is not None and (old_orders := _was(orders, d_orders, net=True)) is not None:
            parts.append(met(met(d_items, old_orders, "order_id"), old_products, "product_id"))
        if d_orders is not None:
            parts.append(met(met(d_orders, signed(items), "order_id"), old_products, "product_id"))
    if d_products is not None:
        parts.append(met(met(d_products, signed(items), "product_id"), signed(now["orders"].select("order_id", day)), "order_id"))
    rows = _united(parts)
    if rows is None:
        return None
    price = exact("sale_price")
    sums = rows.groupBy("order_date", "product_category").agg(
        _total(price).alias("revenue"), _total(price.isNotNull().cast("int")).alias("priced"), F.sum(SIGN).alias("items"))
    return sums.filter("revenue <> 0 OR priced <> 0 OR items <> 0")


def _newest(rows: DataFrame, touched: DataFrame, name: str) -> DataFrame:
    """Latest ``created_at`` of each touched user, from all rows of these users."""
    user = touched.select(F.col("user_id").alias("_user"))
    return (rows.select("user_id", "created_at").join(user, F.col("user_id").eqNullSafe(F.col("_user")), "left_semi")
            .groupBy(F.col("user_id").alias("_of")).agg(F.max("created_at").alias(name)))


def _with_newest(touched: DataFrame, **found: DataFrame) -> DataFrame:
    for name, rows in found.items():
        newest = _newest(rows, touched, name)
        touched = touched.join(newest, F.col("user_id").eqNullSafe(F.col("_of")), "left").drop("_of")
    return touched


def user_engagement_changes(now: Tables, change: Tables) -> DataFrame | None:
    """Per touched user (NULL is one): events to be added and the newest event."""
    _, d_events = _slim(now, change, "events", F.col("user_id"), F.col("created_at"))
    if d_events is None:
        return None
    touched = written_once(d_events.groupBy("user_id").agg(F.sum(SIGN).alias("events")), "touched")
    return _with_newest(touched, last_event_at=now["events"])


def user_statistics_changes(now: Tables, change: Tables) -> DataFrame | None:
    """Per touched user: rows of the user, orders, items, spend and events to be added, and the
    newest order and event."""
    c = F.col
    _, d_users = _narrow(now, change, "users", c("id").alias("user_id"))
    orders, d_orders = _narrow(now, change, "orders", c("order_id"), c("user_id"), c("num_of_item"), c("created_at"))
    items, d_items = _slim(now, change, "order_items", c("order_id"), c("sale_price"))
    _, d_events = _slim(now, change, "events", c("user_id"), c("created_at"))
    # spend follows the order's user alone: an order that has another day or number of items meets no items
    owners, d_owners = orders.select("order_id", "user_id"), None
    if d_orders is not None:
        d_owners = _some(written_once(netted(d_orders.select("order_id", "user_id", SIGN)), "owner_changes"))

    def summed(rows: DataFrame, **sums: Column) -> DataFrame:
        return rows.filter("user_id IS NOT NULL").groupBy("user_id").agg(*[v.alias(n) for n, v in sums.items()])

    parts = []
    if d_users is not None:
        parts.append(summed(d_users, users=F.sum(SIGN)))
    if d_orders is not None:
        parts.append(summed(d_orders, orders=_total(c("order_id").isNotNull().cast("int")), items=_total(c("num_of_item"))))
    if d_owners is not None:
        parts.append(summed(met(d_owners, signed(items), "order_id"), spend=_total(exact("sale_price"))))
    if d_items is not None and (old_owners := _was(owners, d_owners)) is not None:
        # sums of an order meet it as one row
        per_order = d_items.groupBy("order_id").agg(_total(exact("sale_price")).alias("price")).filter("price <> 0")
        parts.append(summed(met(signed(per_order), old_owners, "order_id"), spend=_total(c("price"))))
    if d_events is not None:
        parts.append(summed(d_events, events=F.sum(SIGN)))
    rows = _united(parts)
    if rows is None:
        return None
    held = {n: F.coalesce(F.sum(n), F.lit(0)) if n in rows.columns else F.first(F.lit(0))
            for n in ("users", "orders", "items", "spend", "events")}
    touched = rows.groupBy("user_id").agg(*[v.alias(n) for n, v in held.items()])
    return _with_newest(written_once(touched, "touched"), last_order_at=now["orders"], last_event_at=now["events"])


def _sales(rows: DataFrame) -> DataFrame:
    return rows.filter("items <> 0").select(
        "order_date", "product_category", F.when(F.col("priced") != 0, F.col("revenue").cast("double")).alias("total_revenue"),
        F.col("items").cast("bigint").alias("total_items_sold"))


def _engagement(rows: DataFrame) -> DataFrame:
    return rows.filter("events <> 0").select("user_id", F.col("events").cast("bigint").alias("event_count"), "last_event_at")


def _statistics(rows: DataFrame) -> DataFrame:
    counts = {"orders": "total_orders", "items": "total_items_purchased"}
    return rows.filter("users > 0").select(
        "user_id", *[F.col(n).cast("bigint").alias(as_) for n, as_ in counts.items()],
        F.round(F.col("spend").cast("double"), 2).alias("total_spend"), F.col("events").cast("bigint").alias("total_events"),
        "last_order_at", "last_event_at")


_KEPT: dict[str, tuple[Callable, Callable, str, tuple[str, ...], str]] = {
    "sales_performance": (sales_performance_changes, _sales, "order_date {time}, product_category string",
                          ("revenue", "priced", "items"), ""),
    "user_engagement": (user_engagement_changes, _engagement, "user_id bigint", ("events",), "last_event_at {time}"),
    "user_statistics": (user_statistics_changes, _statistics, "user_id bigint", ("users", "orders", "items", "spend", "events"),
                        "last_order_at {time}, last_event_at {time}"),
}


class KeptGold:
    """A business table kept up from changes, its sums in files under ``path``. ``time`` is
    the type of the tables' times."""

    def __init__(self, spark: SparkSession, name: str, path: str, time: str = "timestamp"):
        self._changes, self._shown, keys, sums, latest = _KEPT[name]
        self.name = name
        self.sums = SumTable(spark, path, keys.format(time=time), sums, latest.format(time=time)).create()

    def apply(self, increment: int, now: Tables, change: Tables) -> None:
        """Take in the changes that made the tables what they are ``now``. The first load is
        a change from empty tables. Increments are numbered upwards; the last one may be
        repeated."""
        rows = self._changes(now, change)
        if rows is not None:
            self.sums.add(increment, rows)

    def table(self) -> DataFrame:
        """The rows that a rebuild from the tables gives (without a column for the audit)."""
        return self._shown(self.sums.rows())


def refresh_gold(spark: SparkSession, name: str, increment: int, path: str, changed: Mapping[str, str],
                 silver: str = "silver", target: str | None = None) -> None:
    """Bring the changes that `medallion.refresh_silver` left in the tables ``changed``
    (silver table -> table of its changes) into a gold table. Only the sums of touched keys are worked
    out; the gold table, one row per key, is written from them."""
    now = {n: spark.read.table(f"{silver}.{n}") for n in ("users", "orders", "order_items", "products", "events")
           if spark.catalog.tableExists(f"{silver}.{n}")}
    kept = KeptGold(spark, name, path)
    kept.apply(increment, now, {n: spark.read.table(t) for n, t in changed.items()})
    tables.overwrite_table(with_audit(kept.table()), target or f"gold.{name}", tables.GOLD_LAYOUT[name])
