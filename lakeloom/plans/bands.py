"""Conditional aggregates: value bands, pivots, delay buckets, many aggregates in
one pass. Every plan reads its fact table once."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import avg_of, day_of_week, in_dates, ratio, sum2, sum_when
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star


def _big(c):
    return c.cast("bigint")


@query("band_agg", """
SELECT count(*) AS n_lines, round(round(sum(quantity), 2) / count(quantity), 6) AS avg_quantity,
       round(round(sum(gross), 2) / count(gross), 6) AS avg_gross, round(sum(gross), 2) AS total_gross
FROM sales JOIN buyer USING (buyer_id)
WHERE sold_at >= TIMESTAMP '1999-01-01' AND sold_at < TIMESTAMP '2000-01-01'
  AND ((segment = 'BUILDING' AND quantity BETWEEN 1 AND 20 AND balance BETWEEN 0 AND 3000)
    OR (segment = 'MACHINERY' AND quantity BETWEEN 10 AND 30 AND balance BETWEEN 3000 AND 6000)
    OR (segment = 'HOUSEHOLD' AND quantity BETWEEN 20 AND 50 AND balance BETWEEN 6000 AND 9999))
  AND ((buyer_region = 'ASIA' AND gross BETWEEN 1000 AND 40000)
    OR (buyer_region IN ('EUROPE', 'AMERICA') AND gross BETWEEN 20000 AND 60000)
    OR (buyer_nation IN ('NATION_0', 'NATION_5') AND gross BETWEEN 50000 AND 90000))""")
def band_agg(s: Star):
    c = F.col
    who = ((c("segment") == "BUILDING") & c("quantity").between(1, 20) & c("balance").between(0, 3000)
           | (c("segment") == "MACHINERY") & c("quantity").between(10, 30) & c("balance").between(3000, 6000)
           | (c("segment") == "HOUSEHOLD") & c("quantity").between(20, 50) & c("balance").between(6000, 9999))
    where = ((c("buyer_region") == "ASIA") & c("gross").between(1000, 40000)
             | c("buyer_region").isin("EUROPE", "AMERICA") & c("gross").between(20000, 60000)
             | c("buyer_nation").isin("NATION_0", "NATION_5") & c("gross").between(50000, 90000))
    return (s.sold_between("1999-01-01", "2000-01-01").join(s.buyer, "buyer_id").filter(who & where)
            .agg(F.count(F.lit(1)).alias("n_lines"), F.round(avg_of("quantity"), 6).alias("avg_quantity"),
                 F.round(avg_of("gross"), 6).alias("avg_gross"), sum2("gross").alias("total_gross")))


@query("band_quantity", """
SELECT sum(quantity) AS total_quantity
FROM sales JOIN buyer USING (buyer_id)
WHERE sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01'
  AND ((segment = 'FURNITURE' AND gross BETWEEN 10000 AND 15000)
    OR (segment = 'AUTOMOBILE' AND gross BETWEEN 5000 AND 10000)
    OR (segment = 'BUILDING' AND gross BETWEEN 15000 AND 20000))""")
def band_quantity(s: Star):
    c = F.col
    band = ((c("segment") == "FURNITURE") & c("gross").between(10000, 15000)
            | (c("segment") == "AUTOMOBILE") & c("gross").between(5000, 10000)
            | (c("segment") == "BUILDING") & c("gross").between(15000, 20000))
    return (s.sold_between("2000-01-01", "2001-01-01").join(s.buyer.select("buyer_id", "segment"), "buyer_id")
            .filter(band).agg(F.sum("quantity").alias("total_quantity")))


@query("band_return_reasons", """
SELECT substr(segment, 1, 5) AS reason, round(round(sum(quantity), 2) / count(quantity), 6) AS avg_quantity,
       round(round(sum(gross), 2) / count(gross), 6) AS avg_refund
FROM sales JOIN buyer USING (buyer_id) JOIN outlet USING (outlet_id)
WHERE returned AND channel = 'web'
  AND ((buyer_region = outlet_region AND gross BETWEEN 100 AND 30000)
    OR (buyer_region <> outlet_region AND gross BETWEEN 30000 AND 80000 AND tax < 0.05))
GROUP BY 1 ORDER BY 1 LIMIT 100""")
def band_return_reasons(s: Star):
    c = F.col
    near = c("buyer_region") == c("outlet_region")
    band = near & c("gross").between(100, 30000) | ~near & c("gross").between(30000, 80000) & (c("tax") < 0.05)
    return (s.lines.filter("returned").join(s.orders.filter("channel = 'web'"), "order_id")
            .join(s.buyer, "buyer_id").join(s.outlet, "outlet_id").filter(band)
            .groupBy(F.substring("segment", 1, 5).alias("reason"))
            .agg(F.round(avg_of("quantity"), 6).alias("avg_quantity"), F.round(avg_of("gross"), 6).alias("avg_refund"))
            .orderBy("reason").limit(100))


# Weekday number -> column prefix.
DAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")


def by_weekday(date_col: str, value: str):
    return [F.round(sum_when(day_of_week(date_col) == i, value), 2).alias(f"{d}_sales") for i, d in enumerate(DAYS)]


_DAY_SQL = ",\n".join(
    f"  round(sum(CASE WHEN dayofweek(sold_on) = {i} THEN gross END), 2) AS {d}_sales" for i, d in enumerate(DAYS))


@query("weekday_pivot", f"""
SELECT outlet_name, outlet_id,
{_DAY_SQL}
FROM sales JOIN outlet USING (outlet_id)
WHERE sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01' AND outlet_region = 'ASIA'
GROUP BY 1, 2 ORDER BY outlet_name, outlet_id LIMIT 100""")
def weekday_pivot(s: Star):
    out = s.outlet.filter("outlet_region = 'ASIA'").select("outlet_id", "outlet_name")
    return (s.sold_between("2000-01-01", "2001-01-01").join(out, "outlet_id")
            .groupBy("outlet_name", "outlet_id").agg(*by_weekday("sold_on", "gross"))
            .orderBy("outlet_name", "outlet_id").limit(100))


_MONTHS = range(1, 13)
_MONTH_SQL = ",\n".join(
    f"  round(sum(CASE WHEN month(sold_on) = {m} THEN gross * quantity END), 2) AS sales_m{m}" for m in _MONTHS)
_RATE_SQL = ",\n".join(f"  round(sales_m{m} / n_suppliers, 6) AS per_supplier_m{m}" for m in _MONTHS)


@query("month_pivot", f"""
WITH size AS (SELECT outlet_nation, count(*) AS n_suppliers FROM outlet GROUP BY 1),
united AS (SELECT * FROM sales WHERE channel = 'web' UNION ALL SELECT * FROM sales WHERE channel = 'catalog'),
m AS (
  SELECT outlet_nation, outlet_region, CAST(year(sold_on) AS BIGINT) AS sold_year,
{_MONTH_SQL}
  FROM united JOIN outlet USING (outlet_id)
  WHERE sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01' AND status IN ('F', 'O')
  GROUP BY 1, 2, 3)
SELECT outlet_region || ',' || outlet_nation AS carriers, sold_year, n_suppliers,
{", ".join(f"sales_m{m}" for m in _MONTHS)},
{_RATE_SQL}
FROM m JOIN size USING (outlet_nation) ORDER BY carriers LIMIT 100""")
def month_pivot(s: Star):
    # both channels are filters on one fact table, so one scan with IN unites them
    orders = s.orders.filter(in_dates("sold_at", "2000-01-01", "2001-01-01")
                             & F.col("channel").isin("web", "catalog") & F.col("status").isin("F", "O"))
    month = F.month("sold_on")
    worth = F.col("gross") * F.col("quantity")
    sums = [F.round(sum_when(month == m, worth), 2).alias(f"sales_m{m}") for m in _MONTHS]
    pivoted = (s.lines.join(orders, "order_id").join(s.outlet, "outlet_id")
               .groupBy("outlet_nation", "outlet_region", _big(F.year("sold_on")).alias("sold_year")).agg(*sums))
    size = s.outlet.groupBy("outlet_nation").agg(F.count(F.lit(1)).alias("n_suppliers"))
    rates = [F.round(ratio(f"sales_m{m}", "n_suppliers"), 6).alias(f"per_supplier_m{m}") for m in _MONTHS]
    return (pivoted.join(size, "outlet_nation")
            .select(F.concat("outlet_region", F.lit(","), "outlet_nation").alias("carriers"), "sold_year", "n_suppliers",
                    *[f"sales_m{m}" for m in _MONTHS], *rates)
            .orderBy("carriers").limit(100))


def delay_buckets_of(days):
    """Counts of delays by 30-day step; negative delays have their own bucket."""
    bounds = [(0, 30, "d30"), (30, 60, "d31_60"), (60, 90, "d61_90"), (90, 120, "d91_120")]
    return ([F.count_if(days < 0).alias("before_order"), F.count_if((days >= 0) & (days <= 30)).alias("d30")]
            + [F.count_if((days > lo) & (days <= hi)).alias(n) for lo, hi, n in bounds[1:]]
            + [F.count_if(days > 120).alias("d_over_120")])


_DELAY = """
SELECT {keys},
  count(*) FILTER (WHERE d < 0) AS before_order, count(*) FILTER (WHERE d BETWEEN 0 AND 30) AS d30,
  count(*) FILTER (WHERE d > 30 AND d <= 60) AS d31_60, count(*) FILTER (WHERE d > 60 AND d <= 90) AS d61_90,
  count(*) FILTER (WHERE d > 90 AND d <= 120) AS d91_120, count(*) FILTER (WHERE d > 120) AS d_over_120
FROM (SELECT *, date_diff('day', sold_on, shipped_on) AS d FROM sales) x JOIN outlet USING (outlet_id)
WHERE {where}
GROUP BY {keys}"""


@query("delay_buckets", _DELAY.format(keys="outlet_nation, channel", where="channel IN ('web', 'catalog')"))
def delay_buckets(s: Star):
    orders = s.orders.filter(F.col("channel").isin("web", "catalog"))
    return (s.lines.join(orders, "order_id").join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .groupBy("outlet_nation", "channel").agg(*delay_buckets_of(F.datediff("shipped_on", "sold_on"))))


@query("return_delay_buckets", _DELAY.format(
    keys="outlet_name, outlet_id", where="returned AND sold_at >= TIMESTAMP '1997-08-01' AND sold_at < TIMESTAMP '1997-09-01'"))
def return_delay_buckets(s: Star):
    return (s.lines.filter("returned").join(s.orders.filter(in_dates("sold_at", "1997-08-01", "1997-09-01")), "order_id")
            .join(s.outlet.select("outlet_id", "outlet_name"), "outlet_id")
            .groupBy("outlet_name", "outlet_id").agg(*delay_buckets_of(F.datediff("shipped_on", "sold_on"))))


@query("before_after", """
SELECT * FROM (
  SELECT outlet_nation, item_id,
         sum(CASE WHEN stock_month < DATE '1998-06-01' THEN on_hand ELSE 0 END) AS stock_before,
         sum(CASE WHEN stock_month >= DATE '1998-06-01' THEN on_hand ELSE 0 END) AS stock_after
  FROM stock JOIN item USING (item_id)
  WHERE stock_month BETWEEN DATE '1998-01-01' AND DATE '1998-12-01' AND list_price BETWEEN 910 AND 960
  GROUP BY 1, 2)
WHERE CASE WHEN stock_before > 0 THEN stock_after / stock_before END BETWEEN 2.0 / 3.0 AND 3.0 / 2.0
ORDER BY outlet_nation, item_id LIMIT 100""")
def before_after(s: Star):
    items = s.item.filter(F.col("list_price").between(910, 960)).select("item_id")
    late = F.col("stock_month") >= F.lit("1998-06-01").cast("date")
    level = F.col("on_hand")
    # no need for the monthly table: both sums come straight from the lines
    month = F.trunc("shipped_on", "month").alias("stock_month")
    moved = (s.lines.filter(in_dates("shipped_at", "1998-01-01", "1999-01-01"))
             .join(items, "item_id", "left_semi").join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
             .select("outlet_nation", "item_id", month, F.col("quantity").alias("on_hand")))
    both = moved.groupBy("outlet_nation", "item_id").agg(
        F.sum(F.when(~late, level).otherwise(F.lit(0.0))).alias("stock_before"),
        F.sum(F.when(late, level).otherwise(F.lit(0.0))).alias("stock_after"))
    change = F.when(F.col("stock_before") > 0, ratio("stock_after", "stock_before"))
    return (both.filter(change.between(F.lit(2.0) / F.lit(3.0), F.lit(3.0) / F.lit(2.0)))
            .orderBy("outlet_nation", "item_id").limit(100))


@query("before_after_sales", """
SELECT outlet_nation, item_id,
       round(sum(CASE WHEN sold_on < DATE '1999-03-11' THEN kept ELSE 0 END), 2) AS sales_before,
       round(sum(CASE WHEN sold_on >= DATE '1999-03-11' THEN kept ELSE 0 END), 2) AS sales_after
FROM (SELECT *, CASE WHEN returned THEN 0.0 ELSE gross END AS kept FROM sales) x JOIN outlet USING (outlet_id)
  JOIN item USING (item_id)
WHERE channel = 'catalog' AND sold_at >= TIMESTAMP '1999-02-09' AND sold_at < TIMESTAMP '1999-04-11'
  AND list_price BETWEEN 900 AND 950
GROUP BY 1, 2 ORDER BY outlet_nation, item_id LIMIT 100""")
def before_after_sales(s: Star):
    items = s.item.filter(F.col("list_price").between(900, 950)).select("item_id")
    orders = s.orders.filter(in_dates("sold_at", "1999-02-09", "1999-04-11") & (F.col("channel") == "catalog"))
    kept = F.when(F.col("returned"), 0.0).otherwise(F.col("gross"))
    early = F.col("sold_on") < F.lit("1999-03-11").cast("date")
    return (s.lines.join(items, "item_id", "left_semi").join(orders, "order_id")
            .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .groupBy("outlet_nation", "item_id")
            .agg(F.round(F.sum(F.when(early, kept).otherwise(0.0)), 2).alias("sales_before"),
                 F.round(F.sum(F.when(~early, kept).otherwise(0.0)), 2).alias("sales_after"))
            .orderBy("outlet_nation", "item_id").limit(100))


# Quantity bands of the bucket report.
BANDS = ((1, 10), (11, 20), (21, 30), (31, 40), (41, 50))
_CASE_SQL = ",\n".join(
    f"""  CASE WHEN (SELECT count(*) FROM lines WHERE quantity BETWEEN {lo} AND {hi}) > 1000
       THEN (SELECT round(round(sum(discount), 2) / count(discount), 6) FROM lines WHERE quantity BETWEEN {lo} AND {hi})
       ELSE (SELECT round(round(sum(gross), 2) / count(gross), 6) FROM lines WHERE quantity BETWEEN {lo} AND {hi})
  END AS bucket{i}""" for i, (lo, hi) in enumerate(BANDS, 1))


@query("bucket_case", f"SELECT\n{_CASE_SQL}")
def bucket_case(s: Star):
    def bucket(lo: int, hi: int):
        mine = F.col("quantity").between(lo, hi)
        return F.when(F.count_if(mine) > 1000, F.round(avg_of(F.when(mine, F.col("discount"))), 6)) \
            .otherwise(F.round(avg_of(F.when(mine, F.col("gross"))), 6))

    return s.lines.agg(*[bucket(lo, hi).alias(f"bucket{i}") for i, (lo, hi) in enumerate(BANDS, 1)])


_BAND = """(SELECT round(round(sum(gross), 2) / count(gross), 6) AS b{i}_avg, count(gross) AS b{i}_count,
        count(DISTINCT gross) AS b{i}_distinct
      FROM lines WHERE quantity BETWEEN {lo} AND {hi} AND (discount BETWEEN 0.02 AND 0.06 OR tax > 0.06)) t{i}"""


@query("side_by_side", "SELECT * FROM " + ", ".join(
    _BAND.format(i=i, lo=lo, hi=hi) for i, (lo, hi) in enumerate(BANDS, 1)))
def side_by_side(s: Star):
    """Five one-row aggregates next to each other. Distinct counts come from a
    first aggregation on (band, value), so no row is multiplied per distinct."""
    band = F.when(F.col("quantity").between(*BANDS[0]), 1)
    for i, (lo, hi) in enumerate(BANDS[1:], 2):
        band = band.when(F.col("quantity").between(lo, hi), i)
    kept = s.lines.filter(F.col("discount").between(0.02, 0.06) | (F.col("tax") > 0.06))
    values = kept.groupBy(band.alias("band"), "gross").agg(F.count(F.lit(1)).alias("n")).filter("band IS NOT NULL")
    cols = []
    for i in range(1, len(BANDS) + 1):
        mine = F.when(F.col("band") == i, F.col("n"))
        total = F.round(F.sum(F.col("gross") * mine), 2)
        n = F.coalesce(F.sum(F.when(F.col("gross").isNotNull(), mine)), F.lit(0))
        cols += [F.round(F.try_divide(total, n), 6).alias(f"b{i}_avg"), n.alias(f"b{i}_count"),
                 F.count(F.when(F.col("gross").isNotNull(), mine)).alias(f"b{i}_distinct")]
    return values.agg(*cols)


@query("ratio_counts", """
SELECT count(*) FILTER (WHERE hour(ts) BETWEEN 8 AND 9) AS am_count,
       count(*) FILTER (WHERE hour(ts) BETWEEN 19 AND 20) AS pm_count,
       round(CAST(count(*) FILTER (WHERE hour(ts) BETWEEN 8 AND 9) AS DOUBLE)
             / nullif(count(*) FILTER (WHERE hour(ts) BETWEEN 19 AND 20), 0), 6) AS am_pm_ratio
FROM events WHERE event_type IN ('purchase', 'view')""")
def ratio_counts(s: Star):
    hour = F.hour("ts")
    am, pm = F.count_if(hour.between(8, 9)), F.count_if(hour.between(19, 20))
    return s.events.filter(F.col("event_type").isin("purchase", "view")).agg(
        am.alias("am_count"), pm.alias("pm_count"), F.round(ratio(am, pm), 6).alias("am_pm_ratio"))


_SLOTS = [(h, half) for h in range(9, 13) for half in (0, 1)]


@query("half_hour_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE hour(ts) = {h} AND minute(ts) {'<' if half == 0 else '>='} 30) AS h{h}_{half * 30:02d}"
    for h, half in _SLOTS) + " FROM events WHERE event_type <> 'error'")
def half_hour_counts(s: Star):
    hour, minute = F.hour("ts"), F.minute("ts")
    cols = [F.count_if((hour == h) & ((minute < 30) if half == 0 else (minute >= 30))).alias(f"h{h}_{half * 30:02d}")
            for h, half in _SLOTS]
    return s.events.filter("event_type <> 'error'").agg(*cols)


@query("one_slot_count", """
SELECT count(*) AS n_events FROM events e JOIN customer ON c_custkey = user_id
WHERE hour(ts) = 20 AND minute(ts) >= 30 AND c_mktsegment = 'BUILDING'""")
def one_slot_count(s: Star):
    who = s.buyer.filter("segment = 'BUILDING'").select(F.col("buyer_id").alias("user_id"))
    return (s.events.filter((F.hour("ts") == 20) & (F.minute("ts") >= 30)).join(who, "user_id", "left_semi")
            .agg(F.count(F.lit(1)).alias("n_events")))


@query("promo_share", """
SELECT round(sum(CASE WHEN item_class = 'PROMO' THEN gross END), 2) AS promotions, round(sum(gross), 2) AS total,
       round(round(sum(CASE WHEN item_class = 'PROMO' THEN gross END), 2) / nullif(round(sum(gross), 2), 0) * 100, 6)
         AS promo_pct
FROM sales JOIN item USING (item_id) JOIN buyer USING (buyer_id)
WHERE sold_at >= TIMESTAMP '1998-11-01' AND sold_at < TIMESTAMP '1998-12-01' AND buyer_region = 'EUROPE'""")
def promo_share(s: Star):
    promo = F.round(sum_when(F.col("item_class") == "PROMO", "gross"), 2)
    who = s.buyer.filter("buyer_region = 'EUROPE'").select("buyer_id")
    return (s.sold_between("1998-11-01", "1998-12-01").join(s.item.select("item_id", "item_class"), "item_id")
            .join(who, "buyer_id", "left_semi")
            .agg(promo.alias("promotions"), sum2("gross").alias("total"),
                 F.round(ratio(promo, sum2("gross")) * 100, 6).alias("promo_pct")))
