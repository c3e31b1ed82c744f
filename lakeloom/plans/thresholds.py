"""Comparisons with group averages, scalar sub-results and shares of totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import avg_of, count_when, in_dates, sum2
from lakeloom.operators.groups import above_group_avg, deviating, share_of_group, with_group_aggs
from lakeloom.operators.membership import occurrence_flags
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star


@query("above_group_avg", """
WITH a AS (SELECT item_id, round(sum(discount), 2) / count(discount) AS avg_value FROM lines GROUP BY 1)
SELECT order_id, line_no, l.item_id AS item_id, outlet_id, discount + 0.0 AS discount, avg_value
FROM lines l JOIN a ON a.item_id = l.item_id WHERE discount > 1.3 * avg_value""")
def above_item_avg(s: Star):
    lines = s.lines.select("order_id", "line_no", "item_id", "outlet_id", "discount")
    return (above_group_avg(lines, ["item_id"], "discount", 1.3)
            .select("order_id", "line_no", "item_id", "outlet_id", (F.col("discount") + 0.0).alias("discount"), "avg_value"))


_EXCESS = """
WITH w AS (SELECT * FROM sales WHERE channel = '{channel}' AND sold_at >= TIMESTAMP '2000-01-27' AND sold_at < TIMESTAMP '2000-04-27'),
a AS (SELECT item_id AS k, round(sum(discount), 2) / count(discount) AS avg_value FROM w GROUP BY 1)
SELECT round(sum(gross * discount), 4) AS excess_discount
FROM w JOIN a ON k = item_id JOIN item USING (item_id)
WHERE discount > 1.3 * avg_value AND item_size BETWEEN 1 AND {size}"""


def _excess(s: Star, channel: str, size: int):
    items = s.item.filter(F.col("item_size").between(1, size)).select("item_id")
    orders = s.orders.filter(in_dates("sold_at", "2000-01-27", "2000-04-27") & (F.col("channel") == channel))
    sold = s.lines.join(items, "item_id", "left_semi").join(orders, "order_id")
    return (above_group_avg(sold.select("item_id", "gross", "discount"), ["item_id"], "discount", 1.3)
            .agg(F.round(F.sum(F.col("gross") * F.col("discount")), 4).alias("excess_discount")))


@query("excess_discount", _EXCESS.format(channel="catalog", size=20))
def excess_discount(s: Star):
    return _excess(s, "catalog", 20)


@query("excess_discount_web", _EXCESS.format(channel="web", size=35))
def excess_discount_web(s: Star):
    return _excess(s, "web", 35)


@query("above_avg_returners", """
WITH r AS (SELECT buyer_id, outlet_id, round(sum(gross), 2) AS refund FROM sales
           WHERE returned AND sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01' GROUP BY 1, 2),
a AS (SELECT outlet_id AS k, round(sum(refund), 2) / count(refund) AS avg_refund FROM r GROUP BY 1)
SELECT buyer_name, r.buyer_id AS buyer_id, r.outlet_id AS outlet_id, refund
FROM r JOIN a ON k = outlet_id JOIN buyer USING (buyer_id) JOIN outlet USING (outlet_id)
WHERE refund > 1.2 * avg_refund AND outlet_region = 'AFRICA'
ORDER BY buyer_name, outlet_id LIMIT 100""")
def above_avg_returners(s: Star):
    out = s.outlet.filter("outlet_region = 'AFRICA'").select("outlet_id")
    refunds = (s.lines.filter("returned").join(out, "outlet_id", "left_semi")
               .join(s.orders.filter(in_dates("sold_at", "2000-01-01", "2001-01-01")), "order_id")
               .groupBy("buyer_id", "outlet_id").agg(sum2("gross").alias("refund")))
    return (above_group_avg(refunds, ["outlet_id"], "refund", 1.2)
            .join(s.buyer.select("buyer_id", "buyer_name"), "buyer_id")
            .select("buyer_name", "buyer_id", "outlet_id", "refund")
            .orderBy("buyer_name", "outlet_id").limit(100))


_STATE_AVG = """
WITH r AS (SELECT buyer_id, buyer_nation, round(sum(gross), 2) AS refund FROM sales JOIN buyer USING (buyer_id)
           WHERE returned AND channel = '{channel}' GROUP BY 1, 2),
a AS (SELECT buyer_nation AS k, round(sum(refund), 2) / count(refund) AS avg_refund FROM r GROUP BY 1)
SELECT buyer_id, buyer_nation, refund FROM r JOIN a ON k = buyer_nation WHERE refund > 1.2 * avg_refund
ORDER BY buyer_id LIMIT 100"""


def _state_returners(s: Star, channel: str):
    refunds = (s.lines.filter("returned").join(s.orders.filter(F.col("channel") == channel), "order_id")
               .groupBy("buyer_id").agg(sum2("gross").alias("refund"))
               .join(s.buyer.select("buyer_id", "buyer_nation"), "buyer_id"))
    return (above_group_avg(refunds, ["buyer_nation"], "refund", 1.2)
            .select("buyer_id", "buyer_nation", "refund").orderBy("buyer_id").limit(100))


@query("above_avg_returners_web", _STATE_AVG.format(channel="web"))
def above_avg_returners_web(s: Star):
    return _state_returners(s, "web")


@query("above_avg_returners_catalog", _STATE_AVG.format(channel="catalog"))
def above_avg_returners_catalog(s: Star):
    return _state_returners(s, "catalog")


@query("above_class_price", """
WITH a AS (SELECT item_class AS k, round(sum(list_price), 2) / count(list_price) AS avg_price FROM item GROUP BY 1)
SELECT buyer_nation, count(*) AS n_lines
FROM sales JOIN buyer USING (buyer_id) JOIN item USING (item_id) JOIN a ON k = item_class
WHERE list_price > 1.02 * avg_price AND sold_at >= TIMESTAMP '2001-01-01' AND sold_at < TIMESTAMP '2001-02-01'
GROUP BY 1 HAVING count(*) >= 10 ORDER BY n_lines, buyer_nation LIMIT 100""")
def above_class_price(s: Star):
    dear = above_group_avg(s.item.select("item_id", "item_class", "list_price"), ["item_class"], "list_price", 1.02)
    return (s.sold_between("2001-01-01", "2001-02-01").join(dear.select("item_id"), "item_id", "left_semi")
            .join(s.buyer.select("buyer_id", "buyer_nation"), "buyer_id")
            .groupBy("buyer_nation").agg(F.count(F.lit(1)).alias("n_lines")).filter("n_lines >= 10")
            .orderBy("n_lines", "buyer_nation").limit(100))


_RATIO = """
WITH r AS (
  SELECT item_id, item_name, item_class, list_price, round(sum(gross), 2) AS revenue
  FROM sales JOIN item USING (item_id)
  WHERE channel = '{channel}' AND item_class IN ('PROMO', 'ECONOMY', 'LARGE')
    AND sold_at >= TIMESTAMP '1999-02-22' AND sold_at < TIMESTAMP '1999-03-25'
  GROUP BY 1, 2, 3, 4)
SELECT *, round(revenue * 100 / round(sum(revenue) OVER (PARTITION BY item_class), 2), 6) AS revenue_ratio
FROM r {tail}"""


def _revenue_ratio(s: Star, channel: str):
    items = s.item.filter(F.col("item_class").isin("PROMO", "ECONOMY", "LARGE"))
    orders = s.orders.filter(in_dates("sold_at", "1999-02-22", "1999-03-25") & (F.col("channel") == channel))
    sold = (s.lines.join(orders, "order_id").groupBy("item_id").agg(sum2("gross").alias("revenue"))
            .join(items.select("item_id", "item_name", "item_class", "list_price"), "item_id"))
    return (share_of_group(sold, ["item_class"], "revenue", "revenue_ratio")
            .select("item_id", "item_name", "item_class", "list_price", "revenue", "revenue_ratio"))


_TOP = "ORDER BY item_class, item_id LIMIT 100"


@query("revenue_ratio", _RATIO.format(channel="store", tail=""))
def revenue_ratio(s: Star):
    return _revenue_ratio(s, "store")


@query("revenue_ratio_web", _RATIO.format(channel="web", tail=_TOP))
def revenue_ratio_web(s: Star):
    return _revenue_ratio(s, "web").orderBy("item_class", "item_id").limit(100)


@query("revenue_ratio_catalog", _RATIO.format(channel="catalog", tail=_TOP))
def revenue_ratio_catalog(s: Star):
    return _revenue_ratio(s, "catalog").orderBy("item_class", "item_id").limit(100)


_DEVIATION = """
WITH g AS (
  SELECT {keys}, CAST({step}(sold_on) AS BIGINT) AS step, round(sum(gross), 2) AS sum_sales
  FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id)
  WHERE sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01' AND {where}
  GROUP BY ALL),
a AS (SELECT *, round(sum(sum_sales) OVER w, 2) / count(sum_sales) OVER w AS avg_value FROM g
      WINDOW w AS (PARTITION BY {group}))
SELECT {keys}, step, sum_sales, round(avg_value, 6) AS avg_value FROM a
WHERE avg_value > 0 AND abs(sum_sales - avg_value) / avg_value > 0.1"""


def _deviation(s: Star, keys, group, step, item_filter):
    sold = (s.sold_between("2000-01-01", "2001-01-01").join(s.item.filter(item_filter), "item_id")
            .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .groupBy(*keys, step("sold_on").cast("bigint").alias("step")).agg(sum2("gross").alias("sum_sales")))
    return (deviating(sold, group, "sum_sales", 0.1)
            .select(*keys, "step", "sum_sales", F.round("avg_value", 6).alias("avg_value")))


@query("deviation", _DEVIATION.format(keys="brand", group="brand", step="quarter",
                                      where="(item_class IN ('PROMO', 'SMALL') AND item_size < 25"
                                            " OR item_class IN ('LARGE', 'MEDIUM') AND item_size >= 25)"))
def deviation(s: Star):
    keep = ("(item_class IN ('PROMO', 'SMALL') AND item_size < 25) "
            "OR (item_class IN ('LARGE', 'MEDIUM') AND item_size >= 25)")
    return _deviation(s, ["brand"], ["brand"], F.quarter, keep)


@query("deviation_monthly", _DEVIATION.format(keys="item_size", group="item_size", step="month",
                                              where="item_class IN ('PROMO', 'STANDARD')"))
def deviation_monthly(s: Star):
    return _deviation(s, ["item_size"], ["item_size"], F.month, "item_class IN ('PROMO', 'STANDARD')")


@query("deviation_outlet", _DEVIATION.format(keys="item_class, brand, outlet_nation",
                                             group="item_class, brand, outlet_nation", step="month",
                                             where="item_class IN ('ECONOMY', 'LARGE')")
       + " ORDER BY sum_sales - avg_value, outlet_nation, item_class, brand, step LIMIT 100")
def deviation_outlet(s: Star):
    keys = ["item_class", "brand", "outlet_nation"]
    return (_deviation(s, keys, keys, F.month, "item_class IN ('ECONOMY', 'LARGE')")
            .orderBy(F.col("sum_sales") - F.col("avg_value"), "outlet_nation", "item_class", "brand", "step").limit(100))


@query("threshold_customers", """
WITH frequent AS (SELECT item_id FROM sales GROUP BY item_id HAVING count(DISTINCT sold_on) > 32),
spent AS (SELECT buyer_id, round(sum(quantity * gross), 2) AS spend FROM sales WHERE channel = 'store' GROUP BY 1),
best AS (SELECT buyer_id FROM spent WHERE spend > 0.5 * (SELECT max(spend) FROM spent))
SELECT channel, round(sum(quantity * gross), 2) AS total
FROM sales WHERE channel IN ('catalog', 'web') AND sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01'
  AND item_id IN (SELECT item_id FROM frequent) AND buyer_id IN (SELECT buyer_id FROM best)
GROUP BY 1""")
def threshold_customers(s: Star):
    frequent = (s.sales.select("item_id", "sold_on").distinct()
                .groupBy("item_id").agg(F.count("sold_on").alias("days")).filter("days > 32").select("item_id"))
    worth = F.col("quantity") * F.col("gross")
    spent = (s.lines.join(s.orders.filter("channel = 'store'"), "order_id")
             .groupBy("buyer_id").agg(F.round(F.sum(worth), 2).alias("spend")))
    best = spent.filter(F.col("spend") > 0.5 * spent.agg(F.max("spend")).scalar()).select("buyer_id")
    orders = s.orders.filter(in_dates("sold_at", "2000-01-01", "2001-01-01") & F.col("channel").isin("catalog", "web"))
    return (s.lines.join(orders.join(best, "buyer_id", "left_semi"), "order_id")
            .join(frequent, "item_id", "left_semi")
            .groupBy("channel").agg(F.round(F.sum(worth), 2).alias("total")))


@query("having_scalar", """
WITH t AS (
  SELECT buyer_id, outlet_nation, item_class, round(sum(gross), 2) AS paid
  FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id) JOIN buyer USING (buyer_id)
  WHERE channel = 'store' AND upper(buyer_nation) = upper(outlet_nation)
  GROUP BY 1, 2, 3)
SELECT buyer_id, outlet_nation, round(sum(paid), 2) AS total_paid FROM t WHERE item_class = 'PROMO'
GROUP BY 1, 2 HAVING round(sum(paid), 2) > 1.05 * (SELECT round(sum(paid), 2) / count(paid) FROM t)""")
def having_scalar(s: Star):
    paid = (s.lines.join(s.orders.filter("channel = 'store'"), "order_id")
            .join(s.item.select("item_id", "item_class"), "item_id")
            .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .join(s.buyer.select("buyer_id", "buyer_nation"), "buyer_id")
            .filter(F.upper("buyer_nation") == F.upper("outlet_nation"))
            .groupBy("buyer_id", "outlet_nation", "item_class").agg(sum2("gross").alias("paid")))
    mean = paid.agg(avg_of("paid")).scalar()
    return (paid.filter("item_class = 'PROMO'").groupBy("buyer_id", "outlet_nation")
            .agg(sum2("paid").alias("total_paid")).filter(F.col("total_paid") > 1.05 * mean))


@query("low_share_items", """
WITH r AS (SELECT outlet_id, item_id, round(sum(gross), 2) AS revenue FROM sales
           WHERE sold_at >= TIMESTAMP '1999-01-01' AND sold_at < TIMESTAMP '2000-01-01' GROUP BY 1, 2),
a AS (SELECT outlet_id AS k, round(sum(revenue), 2) / count(revenue) AS ave FROM r GROUP BY 1)
SELECT outlet_name, item_name, item_id, revenue, list_price, brand
FROM r JOIN a ON k = outlet_id JOIN outlet USING (outlet_id) JOIN item USING (item_id)
WHERE revenue <= 0.1 * ave ORDER BY outlet_name, item_id LIMIT 100""")
def low_share_items(s: Star):
    # the later joins imply these tests; stated here, both uses of `sold` are one plan
    sold = (s.sold_between("1999-01-01", "2000-01-01").filter("outlet_id IS NOT NULL AND item_id IS NOT NULL")
            .groupBy("outlet_id", "item_id")
            .agg(sum2("gross").alias("revenue")))
    low = with_group_aggs(sold, ["outlet_id"], ave=avg_of("revenue")).filter(F.col("revenue") <= 0.1 * F.col("ave"))
    return (low.join(s.outlet.select("outlet_id", "outlet_name"), "outlet_id")
            .join(s.item.select("item_id", "item_name", "list_price", "brand"), "item_id")
            .select("outlet_name", "item_name", "item_id", "revenue", "list_price", "brand")
            .orderBy("outlet_name", "item_id").limit(100))


@query("revenue_segments", """
WITH target AS (
  SELECT DISTINCT buyer_id FROM sales JOIN item USING (item_id)
  WHERE channel IN ('catalog', 'web') AND item_class = 'PROMO'
    AND sold_at >= TIMESTAMP '1998-12-01' AND sold_at < TIMESTAMP '1999-01-01'),
rev AS (
  SELECT buyer_id, round(sum(gross), 2) AS revenue FROM sales JOIN target USING (buyer_id)
  WHERE channel = 'store' AND CAST(year(sold_on) * 12 + month(sold_on) AS BIGINT)
    BETWEEN (SELECT DISTINCT CAST(year(sold_on) * 12 + month(sold_on) AS BIGINT) + 1 FROM orders_v WHERE sold_on = DATE '1998-12-15')
        AND (SELECT DISTINCT CAST(year(sold_on) * 12 + month(sold_on) AS BIGINT) + 3 FROM orders_v WHERE sold_on = DATE '1998-12-15')
  GROUP BY 1)
SELECT CAST(floor(revenue / 50) AS BIGINT) AS segment, count(*) AS n_buyers,
       CAST(floor(revenue / 50) AS BIGINT) * 50 AS segment_base
FROM rev GROUP BY 1, 3 ORDER BY segment, n_buyers LIMIT 100""")
def revenue_segments(s: Star):
    promo = s.item.filter("item_class = 'PROMO'").select("item_id")
    orders = s.orders.filter(in_dates("sold_at", "1998-12-01", "1999-01-01") & F.col("channel").isin("catalog", "web"))
    target = (s.lines.join(promo, "item_id", "left_semi").join(orders, "order_id").select("buyer_id").distinct())
    month_seq = (F.year("sold_on") * 12 + F.month("sold_on")).cast("bigint")
    # scalar sub-result: the month number of one calendar day
    start = s.orders.filter(F.col("sold_on") == F.lit("1998-12-15").cast("date")).agg(F.max(month_seq)).scalar()
    store = s.orders.filter((F.col("channel") == "store") & month_seq.between(start + 1, start + 3))
    revenue = (s.lines.join(store.join(target, "buyer_id", "left_semi"), "order_id")
               .groupBy("buyer_id").agg(sum2("gross").alias("revenue")))
    step = F.floor(F.col("revenue") / 50).cast("bigint")
    return (revenue.groupBy(step.alias("segment")).agg(F.count(F.lit(1)).alias("n_buyers"))
            .withColumn("segment_base", F.col("segment") * 50).orderBy("segment", "n_buyers").limit(100))


@query("correlated_exists", """
SELECT DISTINCT item_name FROM item i1
WHERE item_size BETWEEN 10 AND 30
  AND (SELECT count(*) FROM item i2 WHERE i2.brand = i1.brand
       AND ((i2.item_class = 'PROMO' AND i2.item_size IN (3, 4, 5) AND i2.list_price < 950)
         OR (i2.item_class = 'LARGE' AND i2.item_size IN (41, 42) AND i2.list_price >= 950))) > 0
ORDER BY item_name LIMIT 100""")
def correlated_exists(s: Star):
    c = F.col
    variant = ((c("item_class") == "PROMO") & c("item_size").isin(3, 4, 5) & (c("list_price") < 950)
               | (c("item_class") == "LARGE") & c("item_size").isin(41, 42) & (c("list_price") >= 950))
    return (s.item.filter(c("item_size").between(10, 30))
            .join(s.item.filter(variant).select("brand"), "brand", "left_semi")
            .select("item_name").distinct().orderBy("item_name").limit(100))


@query("cross_items", """
WITH shared AS (
  SELECT brand, item_class, item_size FROM sales JOIN item USING (item_id) WHERE channel = 'store'
  INTERSECT SELECT brand, item_class, item_size FROM sales JOIN item USING (item_id) WHERE channel = 'catalog'
  INTERSECT SELECT brand, item_class, item_size FROM sales JOIN item USING (item_id) WHERE channel = 'web'),
x AS (SELECT item_id FROM item JOIN shared USING (brand, item_class, item_size)),
a AS (SELECT round(sum(quantity * gross), 2) / count(*) AS mean FROM sales),
g AS (
  SELECT channel, brand, item_class, round(sum(quantity * gross), 2) AS sales, count(*) AS n_sales
  FROM sales JOIN item USING (item_id)
  WHERE item_id IN (SELECT item_id FROM x) AND sold_at >= TIMESTAMP '2000-11-01' AND sold_at < TIMESTAMP '2000-12-01'
  GROUP BY 1, 2, 3 HAVING sum(quantity * gross) > (SELECT mean FROM a))
SELECT channel, brand, item_class, round(sum(sales), 2) AS sum_sales, CAST(sum(n_sales) AS BIGINT) AS number_sales
FROM g GROUP BY ROLLUP (channel, brand, item_class)
ORDER BY channel NULLS LAST, brand NULLS LAST, item_class NULLS LAST LIMIT 100""")
def cross_items(s: Star):
    kind = ["brand", "item_class", "item_size"]
    items = s.item.select("item_id", *kind)
    # which channels sold each item: one pass over the facts, then per kind
    per_item = occurrence_flags(s.sales, ["item_id"], {
        ch: F.col("channel") == ch for ch in ("store", "catalog", "web")})
    by_kind = per_item.join(items, "item_id").groupBy(*kind).agg(
        *[F.bool_or(ch).alias(ch) for ch in ("store", "catalog", "web")])
    shared = items.join(by_kind.filter("store AND catalog AND web"), kind, "left_semi")
    worth = F.col("quantity") * F.col("gross")
    mean = s.sales.agg(F.try_divide(F.round(F.sum(worth), 2), F.count(F.lit(1)))).scalar()
    groups = (s.sold_between("2000-11-01", "2000-12-01").join(shared.select("item_id", "brand", "item_class"), "item_id")
              .groupBy("channel", "brand", "item_class")
              .agg(F.round(F.sum(worth), 2).alias("sales"), F.count(F.lit(1)).alias("n_sales"))
              .filter(F.col("sales") > mean))
    nl = [F.asc_nulls_last(c) for c in ("channel", "brand", "item_class")]
    return (groups.rollup("channel", "brand", "item_class")
            .agg(sum2("sales").alias("sum_sales"), F.sum("n_sales").alias("number_sales"))
            .orderBy(*nl).limit(100))


@query("shared_item_days", """
WITH d AS (SELECT DISTINCT item_class, sold_on FROM sales JOIN item USING (item_id) WHERE channel = 'web')
SELECT item_class, count(*) AS active_days, count(*) FILTER (WHERE dayofweek(sold_on) IN (0, 6)) AS weekend_days
FROM d GROUP BY 1""")
def shared_item_days(s: Star):
    days = (s.lines.join(s.orders.filter("channel = 'web'"), "order_id")
            .join(s.item.select("item_id", "item_class"), "item_id").select("item_class", "sold_on").distinct())
    return days.groupBy("item_class").agg(
        F.count(F.lit(1)).alias("active_days"),
        count_when(F.dayofweek("sold_on").isin(1, 7)).alias("weekend_days"))
