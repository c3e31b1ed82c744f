"""Several sales channels together: united, net of returns, rolled up, compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import in_dates, ratio, sum2
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star

CHANNELS = ("store", "catalog", "web")


def sold_lines(s: Star, orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Lines of the given orders (and items). The orders are joined first, so that what
    is shuffled is filtered, and a grouping by order and item that follows finds the
    rows of an order together and shuffles nothing more."""
    lines = s.lines.join(orders, "order_id")
    return lines if items is None else lines.join(items, "item_id")


def returns_per_line(sold: DataFrame) -> DataFrame:
    """Returned quantity and value per (order, item): one row per key."""
    return (sold.filter("returned").groupBy("order_id", "item_id")
            .agg(F.sum("quantity").alias("returned_quantity"), sum2("gross").alias("returned_value")))


def with_returns(sales: DataFrame, returns: DataFrame, keys=("order_id", "item_id")) -> DataFrame:
    """Sales with what was returned of them, 0 where nothing was."""
    out = sales.join(returns, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in returns.columns if c not in keys})


_LINES_SQL = """per_line AS (
  SELECT order_id, item_id, buyer_id, channel, sold_on, sold_at, round(sum(gross), 2) AS gross, sum(quantity) AS quantity
  FROM sales GROUP BY ALL),
ret AS (SELECT order_id, item_id, sum(quantity) AS returned_quantity, round(sum(gross), 2) AS returned_value
        FROM lines WHERE returned GROUP BY 1, 2)"""


def per_line(s: Star, orders: DataFrame, *keep: str, items: DataFrame | None = None) -> DataFrame:
    """Sold and returned quantity and value per (order, item) in one pass: sales and
    returns share a table here, so the left join to the returns is not needed. ``keep``
    are columns of the order or the item."""
    back = F.col("returned")
    return sold_lines(s, orders, items).groupBy("order_id", "item_id", *keep).agg(
        sum2("gross").alias("gross"), F.sum("quantity").alias("quantity"),
        F.sum(F.when(back, F.col("quantity")).otherwise(0.0)).alias("returned_quantity"),
        sum2(F.when(back, F.col("gross")).otherwise(0.0)).alias("returned_value"))


@query("net_sales", f"""
WITH {_LINES_SQL},
kept AS (
  SELECT item_class, brand, year(sold_on) = 2000 AS latest, quantity - coalesce(returned_quantity, 0) AS n,
         gross - coalesce(returned_value, 0.0) AS amount
  FROM per_line JOIN item USING (item_id) LEFT JOIN ret USING (order_id, item_id)
  WHERE item_class IN ('PROMO', 'LARGE') AND year(sold_on) IN (1999, 2000)),
both_years AS (
  SELECT item_class, brand, sum(n) FILTER (WHERE NOT latest) AS prev_count, sum(n) FILTER (WHERE latest) AS curr_count,
         round(round(sum(amount) FILTER (WHERE latest), 2) - round(sum(amount) FILTER (WHERE NOT latest), 2), 2) AS amount_change
  FROM kept GROUP BY item_class, brand)
SELECT CAST(1999 AS BIGINT) AS prev_year, CAST(2000 AS BIGINT) AS sold_year, both_years.*
FROM both_years WHERE curr_count / prev_count < 0.9""")
def net_sales(s: Star):
    items = s.item.filter(F.col("item_class").isin("PROMO", "LARGE")).select("item_id", "item_class", "brand")
    orders = s.orders.filter(in_dates("sold_at", "1999-01-01", "2001-01-01"))
    lines = per_line(s, orders, "sold_on", "item_class", "brand", items=items)
    net_q = F.col("quantity") - F.col("returned_quantity")
    net_v = F.col("gross") - F.col("returned_value")
    year = F.year("sold_on")
    # both years in one aggregation instead of a self-join
    both = lines.groupBy("item_class", "brand").agg(
        F.sum(F.when(year == 1999, net_q)).alias("prev_count"), F.sum(F.when(year == 2000, net_q)).alias("curr_count"),
        F.round(F.sum(F.when(year == 1999, net_v)), 2).alias("p"), F.round(F.sum(F.when(year == 2000, net_v)), 2).alias("c"))
    return (both.filter(ratio("curr_count", "prev_count") < 0.9)
            .select(F.lit(1999).cast("bigint").alias("prev_year"), F.lit(2000).cast("bigint").alias("sold_year"),
                    "item_class", "brand", "prev_count", "curr_count",
                    F.round(F.col("c") - F.col("p"), 2).alias("amount_change")))


@query("net_sales_buyer", f"""
WITH {_LINES_SQL}
SELECT buyer_id, round(sum(CASE WHEN returned_quantity IS NOT NULL THEN (quantity - returned_quantity) * gross
                                ELSE quantity * gross END), 2) AS actual_sales
FROM per_line LEFT JOIN ret USING (order_id, item_id)
WHERE sold_at >= TIMESTAMP '1997-01-01' AND sold_at < TIMESTAMP '1997-07-01'
GROUP BY 1 ORDER BY actual_sales, buyer_id LIMIT 100""")
def net_sales_buyer(s: Star):
    orders = s.orders.filter(in_dates("sold_at", "1997-01-01", "1997-07-01"))
    lines = per_line(s, orders, "buyer_id")
    kept = (F.col("quantity") - F.col("returned_quantity")) * F.col("gross")
    return (lines.groupBy("buyer_id").agg(F.round(F.sum(kept), 2).alias("actual_sales"))
            .orderBy("actual_sales", "buyer_id").limit(100))


@query("web_brand_returns", f"""
WITH {_LINES_SQL}
SELECT brand, round(sum(gross), 2) AS web_sales, round(sum(coalesce(returned_value, 0.0)), 2) AS web_returns
FROM per_line LEFT JOIN ret USING (order_id, item_id) JOIN item USING (item_id)
WHERE channel = 'web' AND sold_at >= TIMESTAMP '2001-01-01' AND sold_at < TIMESTAMP '2002-01-01'
GROUP BY 1 ORDER BY web_sales DESC, brand LIMIT 50""")
def web_brand_returns(s: Star):
    orders = s.orders.filter(in_dates("sold_at", "2001-01-01", "2002-01-01") & (F.col("channel") == "web"))
    lines = sold_lines(s, orders)
    sold = lines.groupBy("order_id", "item_id").agg(sum2("gross").alias("gross"))
    returns = returns_per_line(lines).select("order_id", "item_id", "returned_value")
    return (with_returns(sold, returns).join(s.item.select("item_id", "brand"), "item_id")
            .groupBy("brand").agg(sum2("gross").alias("web_sales"), sum2("returned_value").alias("web_returns"))
            .orderBy(F.desc("web_sales"), "brand").limit(50))


@query("unreturned", f"""
WITH {_LINES_SQL},
kept AS (
  SELECT item_id, buyer_id, sum(quantity) FILTER (WHERE channel = 'store') AS store_qty,
         round(sum(gross) FILTER (WHERE channel = 'store'), 2) AS store_amt,
         coalesce(sum(quantity) FILTER (WHERE channel <> 'store'), 0.0) AS other_qty
  FROM per_line LEFT JOIN ret USING (order_id, item_id)
  WHERE returned_quantity IS NULL AND year(sold_on) = 2000 GROUP BY item_id, buyer_id)
SELECT *, round(store_qty / other_qty, 2) AS qty_ratio FROM kept WHERE store_qty IS NOT NULL AND other_qty > 0""")
def unreturned(s: Star):
    """Store quantities that were not returned against the other channels. The
    catalog side is joined on item too (a join on buyer and year alone would be
    a tautology on the item)."""
    orders = s.orders.filter(in_dates("sold_at", "2000-01-01", "2001-01-01"))
    # the anti join with the returns of the same (order, item): no line came back
    kept = (sold_lines(s, orders).groupBy("order_id", "item_id", "channel", "sold_on", "buyer_id")
            .agg(sum2("gross").alias("gross"), F.sum("quantity").alias("quantity"), F.bool_or("returned").alias("back"))
            .filter("NOT back"))
    in_ch = {ch: F.col("channel") == ch for ch in CHANNELS}
    q = {ch: F.sum(F.when(cond, F.col("quantity"))).alias(f"q_{ch}") for ch, cond in in_ch.items()}
    # three grouped frames and two joins become one grouping on the shared key
    sums = kept.groupBy(F.year("sold_on").alias("y"), "item_id", "buyer_id").agg(
        *q.values(), F.round(F.sum(F.when(in_ch["store"], F.col("gross"))), 2).alias("store_amt"))
    other = F.coalesce("q_web", F.lit(0.0)) + F.coalesce("q_catalog", F.lit(0.0))
    return (sums.filter(F.col("q_store").isNotNull())
            .filter((F.coalesce("q_web", F.lit(0.0)) > 0) | (F.coalesce("q_catalog", F.lit(0.0)) > 0))
            .select("item_id", "buyer_id", F.col("q_store").alias("store_qty"), "store_amt",
                    other.alias("other_qty"), F.round(ratio("q_store", other), 2).alias("qty_ratio")))


@query("channel_rollup", """
WITH w AS (SELECT * FROM sales WHERE sold_at >= TIMESTAMP '1998-08-04' AND sold_at < TIMESTAMP '1998-09-03'),
g AS (
  SELECT channel, channel || '-' || outlet_nation AS id, round(sum(gross), 2) AS sales,
         round(sum(CASE WHEN returned THEN gross ELSE 0.0 END), 2) AS returns,
         round(sum(CASE WHEN returned THEN -gross * tax ELSE gross * (1.0 - discount) END), 4) AS profit
  FROM w JOIN outlet USING (outlet_id) GROUP BY 1, 2)
SELECT channel, id, round(sum(sales), 2) AS sales, round(sum(returns), 2) AS returns, round(sum(profit), 4) AS profit
FROM g GROUP BY ROLLUP (channel, id) ORDER BY channel NULLS LAST, id NULLS LAST LIMIT 100""")
def channel_rollup(s: Star):
    """Sales, returns and profit per channel and outlet nation with subtotals.
    Facts are first summed to (channel, nation), so the rollup expands only those."""
    gone = F.col("returned")
    profit = F.when(gone, -F.col("gross") * F.col("tax")).otherwise(F.col("gross") * (F.lit(1.0) - F.col("discount")))
    base = (s.sold_between("1998-08-04", "1998-09-03").join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .groupBy("channel", F.concat("channel", F.lit("-"), "outlet_nation").alias("id"))
            .agg(sum2("gross").alias("s"), F.round(F.sum(F.when(gone, F.col("gross")).otherwise(0.0)), 2).alias("r"),
                 F.round(F.sum(profit), 4).alias("p")))
    return (base.rollup("channel", "id").agg(sum2("s").alias("sales"), sum2("r").alias("returns"),
                                             F.round(F.sum("p"), 4).alias("profit"))
            .orderBy(F.asc_nulls_last("channel"), F.asc_nulls_last("id")).limit(100))


@query("channel_rollup_net", f"""
WITH {_LINES_SQL},
g AS (
  SELECT channel, brand AS id, round(sum(gross), 2) AS sales, round(sum(coalesce(returned_value, 0.0)), 2) AS returns,
         round(sum(gross - coalesce(returned_value, 0.0)), 2) AS profit
  FROM per_line LEFT JOIN ret USING (order_id, item_id) JOIN item USING (item_id)
  WHERE sold_at >= TIMESTAMP '1998-08-04' AND sold_at < TIMESTAMP '1998-09-03' AND list_price > 950
  GROUP BY 1, 2)
SELECT channel, id, round(sum(sales), 2) AS sales, round(sum(returns), 2) AS returns, round(sum(profit), 2) AS profit
FROM g GROUP BY ROLLUP (channel, id) ORDER BY channel NULLS LAST, id NULLS LAST LIMIT 100""")
def channel_rollup_net(s: Star):
    items = s.item.filter("list_price > 950").select("item_id", "brand")
    orders = s.orders.filter(in_dates("sold_at", "1998-08-04", "1998-09-03"))
    lines = per_line(s, orders, "channel", "brand", items=items)
    base = lines.groupBy("channel", F.col("brand").alias("id")).agg(
        sum2("gross").alias("s"), sum2("returned_value").alias("r"),
        sum2(F.col("gross") - F.col("returned_value")).alias("p"))
    return (base.rollup("channel", "id").agg(sum2("s").alias("sales"), sum2("r").alias("returns"), sum2("p").alias("profit"))
            .orderBy(F.asc_nulls_last("channel"), F.asc_nulls_last("id")).limit(100))


@query("channel_rollup_outer", """
WITH nations AS (
  SELECT channel, outlet_nation AS id, round(sum(gross), 2) AS sold, round(sum(gross) FILTER (WHERE returned), 2) AS back
  FROM sales JOIN outlet USING (outlet_id)
  WHERE sold_at >= TIMESTAMP '1998-08-04' AND sold_at < TIMESTAMP '1998-09-03' GROUP BY ALL),
met AS (
  SELECT seller.channel, seller.id, seller.sold, coalesce(returner.back, 0.0) AS back
  FROM nations seller JOIN nations returner
    ON returner.channel = seller.channel AND CASE seller.channel WHEN 'store' THEN returner.id = seller.id
                                                  WHEN 'catalog' THEN returner.back IS NOT NULL ELSE FALSE END),
by_nation AS (SELECT channel, id, round(sum(sold), 2) AS sales, round(sum(back), 2) AS returns FROM met GROUP BY channel, id),
by_channel AS (SELECT channel, round(sum(sales), 2) AS sales, round(sum(returns), 2) AS returns FROM by_nation GROUP BY channel)
SELECT * FROM by_nation
UNION ALL SELECT channel, NULL, sales, returns FROM by_channel
UNION ALL SELECT NULL, NULL, round(sum(sales), 2), round(sum(returns), 2) FROM by_channel""")
def channel_rollup_outer(s: Star):
    """Store sales keep their own returns; catalog sales pair every nation's sales
    with every nation's returns. The pairs are not formed: a nation's sales occur
    once per returning nation, and each nation meets the total of all returns."""
    w = s.sold_between("1998-08-04", "1998-09-03").join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
    gone = F.col("returned")
    per = (w.filter(F.col("channel").isin("store", "catalog"))
           .groupBy("channel", F.col("outlet_nation").alias("id"))
           .agg(sum2("gross").alias("sales"), F.round(F.sum(F.when(gone, F.col("gross"))), 2).alias("ret")))
    catalog_returns = per.filter("channel = 'catalog' AND ret IS NOT NULL")
    n = catalog_returns.agg(F.count(F.lit(1))).scalar()
    total = catalog_returns.agg(F.coalesce(sum2("ret"), F.lit(0.0))).scalar()
    store = per.filter("channel = 'store'").select("channel", "id", "sales", F.coalesce("ret", F.lit(0.0)).alias("returns"))
    catalog = per.filter("channel = 'catalog'").select("channel", "id", (F.col("sales") * n).alias("sales"), total.alias("returns"))
    return (store.unionByName(catalog).rollup("channel", "id")
            .agg(sum2("sales").alias("sales"), sum2("returns").alias("returns")))


_WEEK = "sold_at >= TIMESTAMP '2000-01-02' AND sold_at < TIMESTAMP '2000-02-06'"


@query("three_way_compare", f"""
WITH c AS (SELECT channel, brand, round(sum(gross), 2) AS rev FROM sales JOIN item USING (item_id) WHERE {_WEEK} GROUP BY 1, 2),
j AS (SELECT a.brand AS brand, a.rev AS store_rev, b.rev AS catalog_rev, w.rev AS web_rev,
             round((a.rev + b.rev + w.rev) / 3, 6) AS average
      FROM c a JOIN c b ON a.brand = b.brand JOIN c w ON a.brand = w.brand
      WHERE a.channel = 'store' AND b.channel = 'catalog' AND w.channel = 'web')
SELECT *, round(store_rev / average * 100, 4) AS store_dev, round(catalog_rev / average * 100, 4) AS catalog_dev,
       round(web_rev / average * 100, 4) AS web_dev
FROM j WHERE store_rev BETWEEN 0.7 * catalog_rev AND 1.3 * catalog_rev""")
def three_way_compare(s: Star):
    sold = s.sold_between("2000-01-02", "2000-02-06").join(s.item.select("item_id", "brand"), "item_id")
    rev = {ch: F.round(F.sum(F.when(F.col("channel") == ch, F.col("gross"))), 2).alias(f"{ch}_rev") for ch in CHANNELS}
    wide = sold.groupBy("brand").agg(*rev.values())
    for ch in CHANNELS:
        wide = wide.filter(F.col(f"{ch}_rev").isNotNull())
    wide = wide.withColumn("average", F.round((F.col("store_rev") + F.col("catalog_rev") + F.col("web_rev")) / 3, 6))
    devs = {f"{ch}_dev": F.round(ratio(f"{ch}_rev", "average") * 100, 4) for ch in CHANNELS}
    return (wide.filter(F.col("store_rev").between(0.7 * F.col("catalog_rev"), 1.3 * F.col("catalog_rev")))
            .withColumns(devs))


@query("three_way_returns", """
WITH wk AS (SELECT DISTINCT date_trunc('week', sold_on) AS wk FROM orders_v
            WHERE sold_on IN (DATE '2000-06-30', DATE '2000-09-27', DATE '2000-11-17')),
c AS (SELECT channel, item_id, sum(quantity) AS qty FROM sales
      WHERE returned AND date_trunc('week', sold_on) IN (SELECT wk FROM wk) GROUP BY 1, 2)
SELECT item_id, coalesce(max(qty) FILTER (WHERE channel = 'store'), 0.0) AS store_qty,
       coalesce(max(qty) FILTER (WHERE channel = 'catalog'), 0.0) AS catalog_qty,
       coalesce(max(qty) FILTER (WHERE channel = 'web'), 0.0) AS web_qty,
       round(coalesce(max(qty) FILTER (WHERE channel = 'store'), 0.0) / sum(qty) / 3.0 * 100, 6) AS store_share
FROM c GROUP BY 1 HAVING count(*) >= 2""")
def three_way_returns(s: Star):
    """Returned quantities per item in the weeks of three given days, for items
    returned in at least two channels."""
    week = F.date_trunc("week", F.col("sold_on").cast("timestamp"))
    weeks = (s.orders.filter(F.col("sold_on").isin(*[F.to_date(F.lit(d)) for d in ("2000-06-30", "2000-09-27", "2000-11-17")]))
             .select(week.alias("wk")).distinct())
    orders = s.orders.withColumn("wk", week).join(weeks, "wk", "left_semi")
    qty = {ch: F.coalesce(F.sum(F.when(F.col("channel") == ch, F.col("quantity"))), F.lit(0.0)).alias(f"{ch}_qty")
           for ch in CHANNELS}
    n_channels = sum((F.max(F.when(F.col("channel") == ch, 1).otherwise(0)) for ch in CHANNELS[1:]),
                     F.max(F.when(F.col("channel") == CHANNELS[0], 1).otherwise(0)))
    return (s.lines.filter("returned").join(orders, "order_id").groupBy("item_id")
            .agg(*qty.values(), F.sum("quantity").alias("all_qty"), n_channels.alias("n_channels"))
            .filter("n_channels >= 2")
            .withColumn("store_share", F.round(ratio(ratio("store_qty", "all_qty"), F.lit(3.0)) * 100, 6))
            .select("item_id", "store_qty", "catalog_qty", "web_qty", "store_share"))


@query("null_key_counts", """
WITH base AS (
  SELECT o.channel AS channel, CAST(year(o.sold_on) AS BIGINT) AS sold_year, CAST(quarter(o.sold_on) AS BIGINT) AS qtr,
         l.item_id AS item_id, o.order_total AS order_total
  FROM orders_v o LEFT JOIN lines l ON l.order_id = o.order_id)
SELECT channel, 'item_id' AS missing, sold_year, qtr, count(*) AS n, round(sum(order_total), 2) AS amount
FROM base WHERE item_id IS NULL GROUP BY 1, 3, 4
ORDER BY channel, sold_year, qtr LIMIT 100""")
def null_key_counts(s: Star):
    # orders without lines: an anti join, so no line is carried through
    missing = s.orders.join(s.lines.select("order_id"), "order_id", "left_anti")
    return (missing.groupBy("channel", F.lit("item_id").alias("missing"), F.year("sold_on").cast("bigint").alias("sold_year"),
                            F.quarter("sold_on").cast("bigint").alias("qtr"))
            .agg(F.count(F.lit(1)).alias("n"), sum2("order_total").alias("amount"))
            .orderBy("channel", "sold_year", "qtr").limit(100))


@query("union_distinct", """
WITH u AS (
  SELECT CAST(year(sold_on) AS BIGINT) AS sold_year, brand, quantity, gross FROM sales JOIN item USING (item_id) WHERE channel = 'catalog'
  UNION SELECT CAST(year(sold_on) AS BIGINT), brand, quantity, gross FROM sales JOIN item USING (item_id) WHERE channel = 'store'
  UNION SELECT CAST(year(sold_on) AS BIGINT), brand, quantity, gross FROM sales JOIN item USING (item_id) WHERE channel = 'web')
SELECT sold_year, brand, sum(quantity) AS sales_cnt, round(sum(gross), 2) AS sales_amt FROM u GROUP BY 1, 2""")
def union_distinct(s: Star):
    """Equal sale records of any channel count once (UNION, not UNION ALL): the
    distinct of one scan over all channels."""
    rows = (s.sales.join(s.item.select("item_id", "brand"), "item_id")
            .select(F.year("sold_on").cast("bigint").alias("sold_year"), "brand", "quantity", "gross").distinct())
    return rows.groupBy("sold_year", "brand").agg(F.sum("quantity").alias("sales_cnt"), sum2("gross").alias("sales_amt"))
