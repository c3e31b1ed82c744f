"""Semi, anti and existence joins, set operations, basket counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import avg_of, in_dates, sum2
from lakeloom.operators.membership import in_all, in_first_only, occurrence_flags, overlap_counts
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star

CHANNELS = ("store", "catalog", "web")


_YEAR_2000 = "sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2000-04-01'"


def _active(s: Star):
    recent = s.orders.filter(in_dates("sold_at", "2000-01-01", "2000-04-01"))
    return occurrence_flags(recent, ["buyer_id"], {ch: F.col("channel") == ch for ch in CHANNELS})


def _exists(ch: str) -> str:
    return (f"EXISTS (SELECT 1 FROM orders_v o WHERE o.buyer_id = b.buyer_id AND o.channel = '{ch}' AND {_YEAR_2000})")


@query("exists_or", f"""
SELECT segment, buyer_region, count(*) AS n_buyers
FROM buyer b WHERE {_exists('store')} AND ({_exists('web')} OR {_exists('catalog')})
GROUP BY 1, 2""")
def exists_or(s: Star):
    # three existence tests answered by one aggregation of orders per buyer
    active = _active(s).filter("store AND (web OR catalog)").select("buyer_id")
    return (s.buyer.join(active, "buyer_id", "left_semi").groupBy("segment", "buyer_region")
            .agg(F.count(F.lit(1)).alias("n_buyers")))


@query("exists_or_stats", f"""
SELECT buyer_nation, segment, count(*) AS n_buyers, max(balance) AS max_balance,
       round(round(sum(balance), 2) / count(balance), 6) AS avg_balance, round(stddev_samp(balance), 6) AS std_balance
FROM buyer b WHERE {_exists('store')} AND ({_exists('web')} OR {_exists('catalog')})
GROUP BY 1, 2 ORDER BY buyer_nation, segment LIMIT 100""")
def exists_or_stats(s: Star):
    active = _active(s).filter("store AND (web OR catalog)").select("buyer_id")
    return (s.buyer.join(active, "buyer_id", "left_semi").groupBy("buyer_nation", "segment")
            .agg(F.count(F.lit(1)).alias("n_buyers"), F.max("balance").alias("max_balance"),
                 F.round(avg_of("balance"), 6).alias("avg_balance"),
                 F.round(F.stddev_samp("balance"), 6).alias("std_balance"))
            .orderBy("buyer_nation", "segment").limit(100))


@query("exists_not", f"""
SELECT segment, buyer_region, count(*) AS n_buyers
FROM buyer b WHERE {_exists('store')} AND NOT {_exists('web')} AND NOT {_exists('catalog')}
GROUP BY 1, 2""")
def exists_not(s: Star):
    active = _active(s).filter("store AND NOT web AND NOT catalog").select("buyer_id")
    return (s.buyer.join(active, "buyer_id", "left_semi").groupBy("segment", "buyer_region")
            .agg(F.count(F.lit(1)).alias("n_buyers")))


_MULTI = """
SELECT count(DISTINCT order_id) AS order_count, round(sum(gross), 2) AS total_gross, round(sum(gross * tax), 4) AS total_tax
FROM sales s1 JOIN outlet USING (outlet_id)
WHERE channel = '{channel}' AND outlet_region = 'EUROPE'
  AND EXISTS (SELECT 1 FROM lines l2 WHERE l2.order_id = s1.order_id AND l2.outlet_id <> s1.outlet_id)
  AND {neg} EXISTS (SELECT 1 FROM lines r WHERE r.order_id = s1.order_id AND r.returned)"""


def _multi_source(s: Star, channel: str, want_returned: bool):
    """Lines of orders served from several outlets. An order qualifies when its
    smallest and largest outlet differ. That test, the returned flag and the sums
    over the wanted outlets all come from one aggregation per order: the lines are
    read and shuffled once, and counting orders needs no distinct."""
    europe = s.outlet.filter("outlet_region = 'EUROPE'").select("outlet_id", F.lit(True).alias("wanted"))
    here = F.coalesce("wanted", F.lit(False))
    per_order = (s.lines.join(europe, "outlet_id", "left").groupBy("order_id").agg(
        F.min("outlet_id").alias("lo"), F.max("outlet_id").alias("hi"), F.bool_or("returned").alias("has_return"),
        F.count_if(here).alias("n"), F.sum(F.when(here, F.col("gross"))).alias("g"),
        F.sum(F.when(here, F.col("gross") * F.col("tax"))).alias("t"))
        .filter((F.col("lo") != F.col("hi")) & (F.col("has_return") == want_returned) & (F.col("n") > 0)))
    orders = s.orders.filter(F.col("channel") == channel).select("order_id")
    return (per_order.join(orders, "order_id", "left_semi")
            .agg(F.count(F.lit(1)).alias("order_count"), F.round(F.sum("g"), 2).alias("total_gross"),
                 F.round(F.sum("t"), 4).alias("total_tax")))


@query("multi_source_orders", _MULTI.format(channel="catalog", neg="NOT"))
def multi_source_orders(s: Star):
    return _multi_source(s, "catalog", False)


@query("multi_source_orders_web", _MULTI.format(channel="web", neg="NOT"))
def multi_source_orders_web(s: Star):
    return _multi_source(s, "web", False)


@query("multi_source_returned", _MULTI.format(channel="web", neg=""))
def multi_source_returned(s: Star):
    return _multi_source(s, "web", True)


def _by_channel(df, keys):
    """Channels are values of one column here, so the membership flags of a set
    operation come from one scan."""
    return occurrence_flags(df, keys, {ch: F.col("channel") == ch for ch in CHANNELS})


_DAYS_SQL = "SELECT DISTINCT buyer_id, date_trunc('month', sold_on) AS m FROM orders_v WHERE channel = '{}'"


@query("intersect_channels", f"""
SELECT count(*) AS n FROM ({_DAYS_SQL.format('store')} INTERSECT {_DAYS_SQL.format('catalog')}
                           INTERSECT {_DAYS_SQL.format('web')}) x""")
def intersect_channels(s: Star):
    months = s.orders.select("channel", "buyer_id", F.trunc("sold_on", "month").alias("m"))
    flags = _by_channel(months, ["buyer_id", "m"])
    return flags.filter("store AND catalog AND web").agg(F.count(F.lit(1)).alias("n"))


@query("except_channels", f"""
SELECT count(*) AS n FROM ({_DAYS_SQL.format('store')} EXCEPT {_DAYS_SQL.format('catalog')}
                           EXCEPT {_DAYS_SQL.format('web')}) x""")
def except_channels(s: Star):
    months = s.orders.select("channel", "buyer_id", F.trunc("sold_on", "month").alias("m"))
    flags = _by_channel(months, ["buyer_id", "m"])
    return flags.filter("store AND NOT catalog AND NOT web").agg(F.count(F.lit(1)).alias("n"))


@query("overlap_counts", """
WITH pairs AS (
  SELECT bool_or(channel = 'store') AS in_store, bool_or(channel = 'catalog') AS in_catalog
  FROM sales WHERE buyer_id IS NOT NULL AND item_id IS NOT NULL GROUP BY buyer_id, item_id)
SELECT count(*) FILTER (WHERE in_store AND NOT in_catalog) AS store_only,
       count(*) FILTER (WHERE in_catalog AND NOT in_store) AS catalog_only,
       count(*) FILTER (WHERE in_store AND in_catalog) AS store_and_catalog
FROM pairs""")
def overlap(s: Star):
    flags = _by_channel(s.sales.select("channel", "buyer_id", "item_id"), ["buyer_id", "item_id"])
    return overlap_counts(flags, "store", "catalog").toDF("store_only", "catalog_only", "store_and_catalog")


@query("intersect_tables", """
SELECT nation FROM (SELECT buyer_nation AS nation FROM buyer WHERE segment = 'BUILDING' AND balance > 5000
  INTERSECT SELECT outlet_nation FROM outlet WHERE outlet_balance > 3000) x""")
def intersect_tables(s: Star):
    buyers = s.buyer.filter("segment = 'BUILDING' AND balance > 5000").select(F.col("buyer_nation").alias("nation"))
    outlets = s.outlet.filter("outlet_balance > 3000").select(F.col("outlet_nation").alias("nation"))
    return in_all({"buyers": buyers, "outlets": outlets}, ["nation"])


@query("except_tables", """
SELECT buyer_id FROM buyer EXCEPT SELECT user_id FROM events EXCEPT SELECT buyer_id FROM orders_v WHERE sold_at >= TIMESTAMP '2001-01-01'""")
def except_tables(s: Star):
    events = s.events.select(F.col("user_id").alias("buyer_id"))
    recent = s.orders.filter(F.col("sold_at") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return in_first_only({"all": s.buyer, "active": events, "recent": recent}, ["buyer_id"])


# Nation prefixes looked for.
_PREFIXES = ("NATION_1", "NATION_2", "NATION_5")


@query("prefix_join", """
WITH listed AS (SELECT DISTINCT substr(buyer_nation, 1, 8) AS p FROM buyer
                WHERE substr(buyer_nation, 1, 8) IN ('NATION_1', 'NATION_2', 'NATION_5')),
busy AS (SELECT substr(buyer_nation, 1, 8) AS p FROM buyer WHERE segment = 'BUILDING' GROUP BY 1 HAVING count(*) > 10),
both_p AS (SELECT p FROM listed INTERSECT SELECT p FROM busy)
SELECT outlet_name, outlet_id, round(sum(gross), 2) AS revenue
FROM sales JOIN outlet USING (outlet_id) JOIN both_p ON p = substr(outlet_nation, 1, 8)
WHERE sold_at >= TIMESTAMP '1998-04-01' AND sold_at < TIMESTAMP '1998-07-01' AND channel = 'store'
GROUP BY 1, 2 ORDER BY outlet_name, outlet_id LIMIT 100""")
def prefix_join(s: Star):
    p = F.substring("buyer_nation", 1, 8)
    listed = s.buyer.select(p.alias("p")).filter(F.col("p").isin(*_PREFIXES))
    busy = (s.buyer.filter("segment = 'BUILDING'").groupBy(p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 10").select("p"))
    prefixes = in_all({"listed": listed, "busy": busy}, ["p"])
    out = s.outlet.withColumn("p", F.substring("outlet_nation", 1, 8)).join(prefixes, "p", "left_semi")
    orders = s.orders.filter(in_dates("sold_at", "1998-04-01", "1998-07-01") & (F.col("channel") == "store"))
    return (s.lines.join(out.select("outlet_id", "outlet_name"), "outlet_id").join(orders, "order_id")
            .groupBy("outlet_name", "outlet_id").agg(sum2("gross").alias("revenue"))
            .orderBy("outlet_name", "outlet_id").limit(100))


_STOCKED = """
SELECT DISTINCT item_id, item_name, list_price FROM item JOIN stock USING (item_id)
WHERE list_price BETWEEN 920 AND 950 AND on_hand BETWEEN 10 AND 50
  AND stock_month BETWEEN DATE '2000-02-01' AND DATE '2000-03-01' AND brand IN ({brands})
  AND item_id IN (SELECT item_id FROM sales WHERE channel = '{channel}')
ORDER BY item_id LIMIT 100"""


def _stocked(s: Star, channel: str, brands: tuple[str, ...]):
    items = (s.item.filter(F.col("list_price").between(920, 950) & F.col("brand").isin(*brands))
             .select("item_id", "item_name", "list_price"))
    # the wanted months and items are filtered before the stock is summed
    shipped = (s.lines.filter(in_dates("shipped_at", "2000-02-01", "2000-04-01"))
               .join(items.select("item_id"), "item_id", "left_semi")
               .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
               .groupBy("item_id", "outlet_nation", F.trunc("shipped_on", "month").alias("stock_month"))
               .agg(F.sum("quantity").alias("on_hand")))
    stocked = shipped.filter(F.col("on_hand").between(10, 50)).select("item_id")
    sold = (s.lines.join(items.select("item_id"), "item_id", "left_semi")
            .join(s.orders.filter(F.col("channel") == channel), "order_id").select("item_id"))
    return (items.join(stocked, "item_id", "left_semi").join(sold, "item_id", "left_semi")
            .orderBy("item_id").limit(100))


@query("stocked_and_sold", _STOCKED.format(channel="catalog", brands="'Brand#1', 'Brand#5', 'Brand#9', 'Brand#13'"))
def stocked_and_sold(s: Star):
    return _stocked(s, "catalog", ("Brand#1", "Brand#5", "Brand#9", "Brand#13"))


@query("stocked_and_sold_store", _STOCKED.format(channel="store", brands="'Brand#2', 'Brand#6', 'Brand#17', 'Brand#21'"))
def stocked_and_sold_store(s: Star):
    return _stocked(s, "store", ("Brand#2", "Brand#6", "Brand#17", "Brand#21"))


@query("stock_totals", """
SELECT outlet_nation, sum(on_hand) AS total_stock, count(DISTINCT item_id) AS item_count
FROM stock WHERE stock_month BETWEEN DATE '2001-01-01' AND DATE '2001-12-01' GROUP BY 1""")
def stock_totals(s: Star):
    shipped = (s.lines.filter(in_dates("shipped_at", "2001-01-01", "2002-01-01"))
               .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id"))
    per_item = shipped.groupBy("outlet_nation", "item_id").agg(F.sum("quantity").alias("q"))
    return per_item.groupBy("outlet_nation").agg(F.sum("q").alias("total_stock"),
                                                 F.count("item_id").alias("item_count"))


_SEMI = """
WITH wanted AS (SELECT {key} FROM item WHERE {where}),
u AS (
  SELECT {key}, gross FROM sales JOIN item USING (item_id) JOIN buyer USING (buyer_id)
  WHERE channel = 'store' AND {common}
  UNION ALL SELECT {key}, gross FROM sales JOIN item USING (item_id) JOIN buyer USING (buyer_id)
  WHERE channel = 'catalog' AND {common}
  UNION ALL SELECT {key}, gross FROM sales JOIN item USING (item_id) JOIN buyer USING (buyer_id)
  WHERE channel = 'web' AND {common})
SELECT {key}, round(sum(gross), 2) AS total_sales FROM u WHERE {key} IN (SELECT {key} FROM wanted)
GROUP BY 1 ORDER BY {order} LIMIT 100"""
_COMMON = "sold_at >= TIMESTAMP '{}' AND sold_at < TIMESTAMP '{}' AND buyer_region = '{}'"


def _semi_union(s: Star, key: str, where: str, first: str, end: str, region: str, order):
    # the three channels are one scan of one fact table; the attribute semi-join
    # shrinks the item dimension before it meets the facts
    wanted = s.item.filter(where).select(F.col(key).alias("_k"))
    items = s.item.join(wanted, F.col(key) == F.col("_k"), "left_semi").select("item_id", *({key} - {"item_id"}))
    who = s.buyer.filter(F.col("buyer_region") == region).select("buyer_id")
    orders = (s.orders.filter(in_dates("sold_at", first, end) & F.col("channel").isin(*CHANNELS))
              .join(who, "buyer_id", "left_semi"))
    return (s.lines.join(orders, "order_id").join(items, "item_id")
            .groupBy(key).agg(sum2("gross").alias("total_sales")).orderBy(*order).limit(100))


@query("semi_union_sum", _SEMI.format(key="brand", where="item_class = 'PROMO' AND item_size = 5",
                                      common=_COMMON.format("1998-05-01", "1998-06-01", "ASIA"),
                                      order="total_sales, brand"))
def semi_union_sum(s: Star):
    return _semi_union(s, "brand", "item_class = 'PROMO' AND item_size = 5",
                       "1998-05-01", "1998-06-01", "ASIA", ["total_sales", "brand"])


@query("semi_union_items", _SEMI.format(key="item_id", where="item_name LIKE 'red%' OR item_name LIKE 'blue%'",
                                        common=_COMMON.format("2001-02-01", "2001-03-01", "EUROPE"),
                                        order="total_sales, item_id"))
def semi_union_items(s: Star):
    return _semi_union(s, "item_id", "item_name LIKE 'red%' OR item_name LIKE 'blue%'",
                       "2001-02-01", "2001-03-01", "EUROPE", ["total_sales", "item_id"])


@query("semi_union_class", _SEMI.format(key="item_id", where="item_class = 'LARGE'",
                                        common=_COMMON.format("1998-09-01", "1998-10-01", "AFRICA"),
                                        order="item_id, total_sales"))
def semi_union_class(s: Star):
    return _semi_union(s, "item_id", "item_class = 'LARGE'", "1998-09-01", "1998-10-01", "AFRICA",
                       ["item_id", "total_sales"])


_BASKET = """
WITH t AS (
  SELECT order_id, buyer_id, count(*) AS cnt FROM sales
  WHERE channel = 'store' AND (day(sold_on) BETWEEN {d1} OR day(sold_on) BETWEEN {d2})
  GROUP BY 1, 2)
SELECT buyer_name, buyer_id, segment, order_id, cnt FROM t JOIN buyer USING (buyer_id)
WHERE cnt BETWEEN {lo} AND {hi} AND CASE WHEN balance > 0 THEN 5000.0 / balance END > 1.2"""


def _basket(s: Star, lo: int, hi: int, days1, days2):
    day = F.dayofmonth("sold_on")
    orders = s.orders.filter((F.col("channel") == "store") & (day.between(*days1) | day.between(*days2)))
    # count lines per order before the join with orders: the join then sees one row per order
    counts = s.lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt").between(lo, hi))
    who = s.buyer.filter(F.when(F.col("balance") > 0, F.lit(5000.0) / F.col("balance")) > 1.2)
    return (orders.join(counts, "order_id").join(who, "buyer_id")
            .select("buyer_name", "buyer_id", "segment", "order_id", "cnt"))


@query("basket_counts", _BASKET.format(d1="1 AND 3", d2="25 AND 28", lo=7, hi=10))
def basket_counts(s: Star):
    return _basket(s, 7, 10, (1, 3), (25, 28))


@query("basket_counts_small", _BASKET.format(d1="1 AND 2", d2="1 AND 2", lo=1, hi=5))
def basket_counts_small(s: Star):
    return _basket(s, 1, 5, (1, 2), (1, 2))


_AWAY = """
WITH t AS (
  SELECT order_id, buyer_id, outlet_nation AS bought_nation, round(sum(gross), 2) AS amount,
         round(sum(gross * discount), 4) AS saved
  FROM sales JOIN outlet USING (outlet_id)
  WHERE channel = 'store' AND {where} GROUP BY 1, 2, 3)
SELECT buyer_name, buyer_id, buyer_nation, bought_nation, order_id, amount, saved
FROM t JOIN buyer USING (buyer_id) WHERE buyer_nation <> bought_nation
ORDER BY buyer_name, bought_nation, order_id LIMIT 100"""


def _away(s: Star, keep):
    orders = s.orders.filter((F.col("channel") == "store") & keep)
    tickets = (s.lines.join(orders, "order_id").join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
               .groupBy("order_id", "buyer_id", F.col("outlet_nation").alias("bought_nation"))
               .agg(sum2("gross").alias("amount"),
                    F.round(F.sum(F.col("gross") * F.col("discount")), 4).alias("saved")))
    return (tickets.join(s.buyer.select("buyer_id", "buyer_name", "buyer_nation"), "buyer_id")
            .filter("buyer_nation <> bought_nation")
            .select("buyer_name", "buyer_id", "buyer_nation", "bought_nation", "order_id", "amount", "saved")
            .orderBy("buyer_name", "bought_nation", "order_id").limit(100))


@query("away_purchases", _AWAY.format(where="dayofweek(sold_on) IN (0, 6)"))
def away_purchases(s: Star):
    return _away(s, F.dayofweek("sold_on").isin(1, 7))


@query("away_purchases_early", _AWAY.format(where="day(sold_on) BETWEEN 1 AND 2"))
def away_purchases_early(s: Star):
    return _away(s, F.dayofmonth("sold_on").between(1, 2))


@query("monday_tickets", """
WITH t AS (
  SELECT order_id, buyer_id, outlet_nation, round(sum(gross), 2) AS amount, sum(quantity) AS units
  FROM sales JOIN outlet USING (outlet_id)
  WHERE channel = 'store' AND dayofweek(sold_on) = 1 AND outlet_balance BETWEEN 1000 AND 8000 GROUP BY 1, 2, 3)
SELECT buyer_name, substr(outlet_nation, 1, 30) AS outlet_nation, order_id, amount, units
FROM t JOIN buyer USING (buyer_id)
ORDER BY buyer_name, outlet_nation, amount, order_id LIMIT 100""")
def monday_tickets(s: Star):
    orders = s.orders.filter((F.col("channel") == "store") & (F.dayofweek("sold_on") == 2))
    out = s.outlet.filter(F.col("outlet_balance").between(1000, 8000)).select("outlet_id", "outlet_nation")
    return (s.lines.join(orders, "order_id").join(out, "outlet_id")
            .groupBy("order_id", "buyer_id", "outlet_nation")
            .agg(sum2("gross").alias("amount"), F.sum("quantity").alias("units"))
            .join(s.buyer.select("buyer_id", "buyer_name"), "buyer_id")
            .select("buyer_name", F.substring("outlet_nation", 1, 30).alias("outlet_nation"), "order_id", "amount", "units")
            .orderBy("buyer_name", "outlet_nation", "amount", "order_id").limit(100))
