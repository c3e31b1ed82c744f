"""Star joins: filtered dimensions, grouped sums and averages, top-k reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import avg_of, in_dates, net_of, sum2, sum4
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star


def _year(c="sold_on"):
    return F.year(c).cast("bigint")


@query("star_topk", """
SELECT CAST(year(sold_on) AS BIGINT) AS sold_year, brand, round(sum(gross * (1.0 - discount)), 4) AS revenue
FROM sales JOIN item USING (item_id)
WHERE item_class = 'PROMO' AND month(sold_on) = 11
GROUP BY 1, 2 ORDER BY sold_year, revenue DESC, brand LIMIT 100""")
def star_topk(s: Star):
    items = s.item.filter("item_class = 'PROMO'").select("item_id", "brand")
    return (s.lines.join(s.orders.filter(F.month("sold_on") == 11), "order_id").join(items, "item_id")
            .groupBy(_year().alias("sold_year"), "brand").agg(sum4(net_of()).alias("revenue"))
            .orderBy("sold_year", F.desc("revenue"), "brand").limit(100))


@query("star_topk_abroad", """
SELECT brand, item_class, round(sum(gross), 2) AS revenue
FROM sales JOIN item USING (item_id) JOIN buyer USING (buyer_id) JOIN outlet USING (outlet_id)
WHERE sold_at >= TIMESTAMP '1998-11-01' AND sold_at < TIMESTAMP '1998-12-01'
  AND substr(buyer_nation, 1, 8) <> substr(outlet_nation, 1, 8) AND item_size BETWEEN 1 AND 10
GROUP BY brand, item_class ORDER BY revenue DESC, brand, item_class LIMIT 100""")
def star_topk_abroad(s: Star):
    items = s.item.filter(F.col("item_size").between(1, 10)).select("item_id", "brand", "item_class")
    sold = s.sold_between("1998-11-01", "1998-12-01").join(items, "item_id")
    return (sold.join(s.buyer.select("buyer_id", "buyer_nation"), "buyer_id")
            .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .filter(F.substring("buyer_nation", 1, 8) != F.substring("outlet_nation", 1, 8))
            .groupBy("brand", "item_class").agg(sum2("gross").alias("revenue"))
            .orderBy(F.desc("revenue"), "brand", "item_class").limit(100))


def _monthly(s: Star, first: str, end: str, keys: list[str], items=None):
    items = s.item if items is None else items
    return (s.sold_between(first, end).join(items.select("item_id", *keys), "item_id")
            .groupBy(_year().alias("sold_year"), *keys).agg(sum2("gross").alias("revenue")))


@query("star_topk_class", """
SELECT CAST(year(sold_on) AS BIGINT) AS sold_year, item_class, round(sum(gross), 2) AS revenue
FROM sales JOIN item USING (item_id)
WHERE sold_at >= TIMESTAMP '1998-11-01' AND sold_at < TIMESTAMP '1998-12-01'
GROUP BY 1, 2 ORDER BY revenue DESC, sold_year, item_class LIMIT 100""")
def star_topk_class(s: Star):
    return (_monthly(s, "1998-11-01", "1998-12-01", ["item_class"])
            .orderBy(F.desc("revenue"), "sold_year", "item_class").limit(100))


@query("star_topk_brand", """
SELECT CAST(year(sold_on) AS BIGINT) AS sold_year, brand, round(sum(gross), 2) AS revenue
FROM sales JOIN item USING (item_id)
WHERE sold_at >= TIMESTAMP '2000-11-01' AND sold_at < TIMESTAMP '2000-12-01'
GROUP BY 1, 2 ORDER BY sold_year, revenue DESC, brand LIMIT 100""")
def star_topk_brand(s: Star):
    return (_monthly(s, "2000-11-01", "2000-12-01", ["brand"])
            .orderBy("sold_year", F.desc("revenue"), "brand").limit(100))


@query("star_topk_size", """
SELECT CAST(year(sold_on) AS BIGINT) AS sold_year, brand, round(sum(gross), 2) AS revenue
FROM sales JOIN item USING (item_id)
WHERE sold_at >= TIMESTAMP '1999-11-01' AND sold_at < TIMESTAMP '1999-12-01' AND item_size = 28
GROUP BY 1, 2 ORDER BY revenue DESC, brand LIMIT 100""")
def star_topk_size(s: Star):
    return (_monthly(s, "1999-11-01", "1999-12-01", ["brand"], s.item.filter("item_size = 28"))
            .orderBy(F.desc("revenue"), "brand").limit(100))


@query("star_yearly_outlets", """
SELECT outlet_region, CAST(year(sold_on) AS BIGINT) AS sold_year, count(*) AS sold_lines,
       count(DISTINCT order_id) AS sold_orders, round(sum(gross), 2) AS revenue
FROM sales JOIN outlet USING (outlet_id)
GROUP BY 1, 2""")
def star_yearly_outlets(s: Star):
    return (s.sales.join(s.outlet.select("outlet_id", "outlet_region"), "outlet_id")
            .groupBy("outlet_region", _year().alias("sold_year"))
            .agg(F.count(F.lit(1)).alias("sold_lines"), F.count_distinct("order_id").alias("sold_orders"),
                 sum2("gross").alias("revenue")))


_AVG = """
SELECT item_id, round(round(sum(quantity), 2) / count(quantity), 6) AS avg_quantity,
       round(round(sum(gross), 2) / count(gross), 6) AS avg_gross,
       round(round(sum(discount), 2) / count(discount), 6) AS avg_discount,
       round(round(sum(tax), 2) / count(tax), 6) AS avg_tax
FROM sales JOIN buyer USING (buyer_id)
WHERE channel = '{channel}' AND segment = '{segment}'
  AND sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01'
  AND (tax <= 0.04 OR discount <= 0.03)
GROUP BY item_id ORDER BY item_id LIMIT 100"""


def _item_averages(s: Star, channel: str, segment: str):
    orders = s.orders.filter(in_dates("sold_at", "2000-01-01", "2001-01-01") & (F.col("channel") == channel))
    buyers = s.buyer.filter(F.col("segment") == segment).select("buyer_id")
    return (s.lines.filter("tax <= 0.04D OR discount <= 0.03D").join(orders, "order_id")
            .join(buyers, "buyer_id", "left_semi")
            .groupBy("item_id").agg(*[F.round(avg_of(c), 6).alias(f"avg_{c}")
                                      for c in ("quantity", "gross", "discount", "tax")])
            .orderBy("item_id").limit(100))


@query("star_avg", _AVG.format(channel="store", segment="BUILDING"))
def star_avg(s: Star):
    return _item_averages(s, "store", "BUILDING")


@query("star_avg_catalog", _AVG.format(channel="catalog", segment="MACHINERY"))
def star_avg_catalog(s: Star):
    return _item_averages(s, "catalog", "MACHINERY")


# Nation numbers looked for by the two OR filters.
_NATIONS = ("NATION_3", "NATION_7", "NATION_11", "NATION_19")


@query("or_filters", """
SELECT buyer_nation, round(sum(gross), 2) AS revenue
FROM sales JOIN buyer USING (buyer_id)
WHERE channel = 'catalog' AND sold_at >= TIMESTAMP '2000-04-01' AND sold_at < TIMESTAMP '2000-07-01'
  AND (substr(buyer_nation, 8, 1) IN ('3', '7') OR buyer_region IN ('ASIA', 'EUROPE') OR gross > 90000)
GROUP BY buyer_nation ORDER BY buyer_nation LIMIT 100""")
def or_filters(s: Star):
    wanted = (F.substring("buyer_nation", 8, 1).isin("3", "7")
              | F.col("buyer_region").isin("ASIA", "EUROPE") | (F.col("gross") > 90000))
    orders = s.orders.filter(in_dates("sold_at", "2000-04-01", "2000-07-01") & (F.col("channel") == "catalog"))
    return (s.lines.join(orders, "order_id").join(s.buyer, "buyer_id").filter(wanted)
            .groupBy("buyer_nation").agg(sum2("gross").alias("revenue"))
            .orderBy("buyer_nation").limit(100))


@query("or_filters_items", """
SELECT buyer_nation, segment, round(sum(gross), 2) AS revenue
FROM sales JOIN buyer USING (buyer_id)
WHERE channel = 'web' AND sold_at >= TIMESTAMP '1999-04-01' AND sold_at < TIMESTAMP '1999-07-01'
  AND (buyer_nation IN ('NATION_3', 'NATION_7', 'NATION_11', 'NATION_19')
       OR item_id IN (SELECT item_id FROM item WHERE item_size IN (2, 3, 5, 7, 11, 13, 17, 19)))
GROUP BY buyer_nation, segment ORDER BY buyer_nation, segment LIMIT 100""")
def or_filters_items(s: Star):
    # IN inside OR: left join on the unique listed keys and test the flag
    listed = (s.item.filter(F.col("item_size").isin(2, 3, 5, 7, 11, 13, 17, 19))
              .select("item_id", F.lit(True).alias("listed")))
    orders = s.orders.filter(in_dates("sold_at", "1999-04-01", "1999-07-01") & (F.col("channel") == "web"))
    return (s.lines.join(orders, "order_id").join(s.buyer, "buyer_id").join(listed, "item_id", "left")
            .filter(F.col("buyer_nation").isin(*_NATIONS) | F.col("listed").isNotNull())
            .groupBy("buyer_nation", "segment").agg(sum2("gross").alias("revenue"))
            .orderBy("buyer_nation", "segment").limit(100))


@query("name_lookup", """
SELECT buyer_id, buyer_name || ', ' || segment AS full_label, count(*) AS returned_lines
FROM sales JOIN buyer USING (buyer_id)
WHERE returned AND buyer_nation = 'NATION_4' AND balance BETWEEN 0 AND 5000
GROUP BY 1, 2 ORDER BY buyer_id LIMIT 100""")
def name_lookup(s: Star):
    who = (s.buyer.filter((F.col("buyer_nation") == "NATION_4") & F.col("balance").between(0, 5000))
           .select("buyer_id", F.concat("buyer_name", F.lit(", "), "segment").alias("full_label")))
    return (s.lines.filter("returned").join(s.orders.join(who, "buyer_id"), "order_id")
            .groupBy("buyer_id", "full_label").agg(F.count(F.lit(1)).alias("returned_lines"))
            .orderBy("buyer_id").limit(100))


@query("like_sum", """
SELECT outlet_nation, outlet_name, round(sum(gross), 2) AS returned_value
FROM sales JOIN buyer USING (buyer_id) JOIN outlet USING (outlet_id)
WHERE returned AND sold_at >= TIMESTAMP '1998-11-01' AND sold_at < TIMESTAMP '1998-12-01'
  AND segment LIKE 'BUILD%' AND outlet_name IS NOT NULL
GROUP BY 1, 2 ORDER BY returned_value DESC, outlet_name""")
def like_sum(s: Star):
    who = s.buyer.filter(F.col("segment").like("BUILD%")).select("buyer_id")
    orders = s.orders.filter(in_dates("sold_at", "1998-11-01", "1998-12-01")).join(who, "buyer_id", "left_semi")
    out = s.outlet.filter(F.col("outlet_name").isNotNull())
    return (s.lines.filter("returned").join(orders, "order_id").join(out, "outlet_id")
            .groupBy("outlet_nation", "outlet_name").agg(sum2("gross").alias("returned_value"))
            .orderBy(F.desc("returned_value"), "outlet_name"))


@query("hourly_union", """
WITH u AS (
  SELECT event_type, ts, value FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT event_type, ts, value FROM events WHERE event_type = 'click'
  UNION ALL SELECT event_type, ts, value FROM events WHERE event_type = 'view')
SELECT event_type, CAST(hour(ts) AS BIGINT) AS event_hour, CAST(minute(ts) AS BIGINT) AS event_minute,
       count(*) AS n_events, round(sum(value), 2) AS total_value
FROM u WHERE hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 18 AND 20
GROUP BY 1, 2, 3""")
def hourly_union(s: Star):
    # the three parts differ only by a filter on one table: one scan serves them all
    hour = F.hour("ts")
    return (s.events.filter(F.col("event_type").isin("purchase", "click", "view")
                            & (hour.between(7, 9) | hour.between(18, 20)))
            .groupBy("event_type", hour.cast("bigint").alias("event_hour"),
                     F.minute("ts").cast("bigint").alias("event_minute"))
            .agg(F.count(F.lit(1)).alias("n_events"), sum2("value").alias("total_value")))
