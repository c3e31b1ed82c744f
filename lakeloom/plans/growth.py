"""Period against period: growth by channel, same week a year later, two years
of a wide join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import in_dates, ratio, sum2, sum4
from lakeloom.operators.series import against_offset
from lakeloom.plans.bands import _DAY_SQL, DAYS, by_weekday
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star


def cells(df: DataFrame, keys: list[str], value: Column, dims: dict[str, Column]) -> DataFrame:
    """One column per named condition with the rounded sum of ``value``. Replaces
    the self-joins of one aggregate by channel and year."""
    return df.groupBy(*keys).agg(*[F.round(F.sum(F.when(c, value)), 4).alias(n) for n, c in dims.items()])


def _year_cells(*channels: str):
    """A column per channel and year; growth is measured from 1999 to 2000."""
    return {f"{ch}_{y}": (F.col("channel") == ch) & (F.year("sold_on") == y) for ch in channels for y in (1999, 2000)}


def _span_cells(*channels: str):
    """A column per channel and span of three years, before and from 1998 on."""
    early = F.col("sold_on") < F.lit("1998-01-01").cast("date")
    return {f"{ch}_{name}": (F.col("channel") == ch) & c
            for ch in channels for name, c in (("early", early), ("late", ~early))}


# Growth of each channel of a buyer is one row: later sum over earlier sum, both present.
_GROWTH = """
WITH valued AS (
  SELECT buyer_id, channel, sold_on >= DATE '{later}' AS is_late, {value} AS paid
  FROM sales WHERE sold_at >= TIMESTAMP '{first}' AND sold_at < TIMESTAMP '2001-01-01' AND channel IN ({channels})),
sums AS (
  SELECT buyer_id, channel, round(sum(paid) FILTER (WHERE is_late), 4) AS late, round(sum(paid) FILTER (WHERE NOT is_late), 4) AS early
  FROM valued GROUP BY buyer_id, channel),
growth AS (SELECT buyer_id, channel, late / early AS times FROM sums WHERE early > 0 AND late IS NOT NULL),
fastest AS (
  SELECT buyer_id FROM growth GROUP BY buyer_id
  HAVING count(*) = {n} AND max(times) FILTER (WHERE channel = '{best}') > max(times) FILTER (WHERE channel <> '{best}'))
SELECT {columns} FROM fastest JOIN buyer USING (buyer_id) ORDER BY buyer_id LIMIT 100"""


def _growth_sql(best: str, channels: tuple[str, ...], value: str, first: str, later: str, columns: str) -> str:
    """Buyers whose sales in channel ``best`` grew more than in each of the others."""
    return _GROWTH.format(best=best, channels=", ".join(f"'{c}'" for c in channels), n=len(channels), value=value,
                          first=first, later=later, columns=columns)


@query("growth_compare", _growth_sql(
    "catalog", ("store", "catalog", "web"), "(gross - gross * discount + gross * tax) / 2", "1995-01-01", "1998-01-01",
    "buyer_id, buyer_name, segment"))
def growth_compare(s: Star):
    g = F.col("gross")
    value = (g - g * F.col("discount") + g * F.col("tax")) / 2
    channels = ("store", "catalog", "web")
    c = cells(s.sold_between("1995-01-01", "2001-01-01"), ["buyer_id"], value, _span_cells(*channels))
    # a comparison with a missing cell is NULL, so buyers without all six cells drop out
    grew = {ch: F.when(F.col(f"{ch}_early") > 0, ratio(f"{ch}_late", f"{ch}_early")) for ch in channels}
    return (c.filter((grew["catalog"] > grew["store"]) & (grew["catalog"] > grew["web"]))
            .join(s.buyer.select("buyer_id", "buyer_name", "segment"), "buyer_id")
            .select("buyer_id", "buyer_name", "segment").orderBy("buyer_id").limit(100))


def _web_over_store_sql(value: str) -> str:
    return _growth_sql("web", ("store", "web"), value, "1999-01-01", "2000-01-01", "buyer_id, buyer_name")


def _web_over_store(s: Star, value):
    c = cells(s.sold_between("1999-01-01", "2001-01-01").filter(F.col("channel").isin("store", "web")),
              ["buyer_id"], value, _year_cells("store", "web"))
    web = F.when(F.col("web_1999") > 0, ratio("web_2000", "web_1999"))
    store = F.when(F.col("store_1999") > 0, ratio("store_2000", "store_1999"))
    return (c.filter(web > store).join(s.buyer.select("buyer_id", "buyer_name"), "buyer_id")
            .select("buyer_id", "buyer_name").orderBy("buyer_id").limit(100))


@query("growth_compare_web", _web_over_store_sql("gross - gross * discount"))
def growth_compare_web(s: Star):
    return _web_over_store(s, F.col("gross") - F.col("gross") * F.col("discount"))


@query("growth_compare_paid", _web_over_store_sql("gross"))
def growth_compare_paid(s: Star):
    return _web_over_store(s, F.col("gross"))


@query("growth_compare_nation", """
WITH q AS (
  SELECT buyer_nation, channel, quarter(sold_on) AS q, round(sum(gross), 2) AS total
  FROM sales JOIN buyer USING (buyer_id)
  WHERE sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01' GROUP BY 1, 2, 3),
p AS (
  SELECT buyer_nation,
    max(total) FILTER (WHERE channel = 'web' AND q = 1) AS w1, max(total) FILTER (WHERE channel = 'web' AND q = 2) AS w2,
    max(total) FILTER (WHERE channel = 'web' AND q = 3) AS w3, max(total) FILTER (WHERE channel = 'store' AND q = 1) AS s1,
    max(total) FILTER (WHERE channel = 'store' AND q = 2) AS s2, max(total) FILTER (WHERE channel = 'store' AND q = 3) AS s3
  FROM q GROUP BY 1)
SELECT buyer_nation, round(w2 / w1, 6) AS web_q1_q2, round(s2 / s1, 6) AS store_q1_q2,
       round(w3 / w2, 6) AS web_q2_q3, round(s3 / s2, 6) AS store_q2_q3
FROM p WHERE w2 / w1 > s2 / s1 OR w3 / w2 > s3 / s2""")
def growth_compare_nation(s: Star):
    by_nation = s.sold_between("2000-01-01", "2001-01-01").join(s.buyer.select("buyer_id", "buyer_nation"), "buyer_id")
    dims = {f"{ch[0]}{q}": (F.col("channel") == ch) & (F.quarter("sold_on") == q) for ch in ("web", "store") for q in (1, 2, 3)}
    c = cells(by_nation, ["buyer_nation"], F.col("gross"), dims)
    r = {(ch, q): ratio(f"{ch}{q + 1}", f"{ch}{q}") for ch in "ws" for q in (1, 2)}
    return (c.filter((r["w", 1] > r["s", 1]) | (r["w", 2] > r["s", 2]))
            .select("buyer_nation", F.round(r["w", 1], 6).alias("web_q1_q2"), F.round(r["s", 1], 6).alias("store_q1_q2"),
                    F.round(r["w", 2], 6).alias("web_q2_q3"), F.round(r["s", 2], 6).alias("store_q2_q3")))


# 1995-01-01 was a Sunday: weeks run Sunday to Saturday, numbered from there.
def week_no(c="sold_on"):
    return F.floor(F.datediff(c, F.lit("1995-01-01").cast("date")) / 7).cast("bigint")


_WEEK_SQL = "CAST(floor(date_diff('day', DATE '1995-01-01', sold_on) / 7.0) AS BIGINT)"
_WEEK_RATIO = ", ".join(f"round(a.{d}_sales / b.{d}_sales, 2) AS {d}_ratio" for d in DAYS)


@query("week_over_year", f"""
WITH wk AS (
  SELECT {_WEEK_SQL} AS week_no,
{_DAY_SQL}
  FROM (SELECT * FROM sales WHERE channel = 'web' UNION ALL SELECT * FROM sales WHERE channel = 'catalog') u
  WHERE sold_at >= TIMESTAMP '1998-01-01' AND sold_at < TIMESTAMP '2000-01-16' GROUP BY 1)
SELECT a.week_no AS week_no, {_WEEK_RATIO}
FROM wk a JOIN wk b ON a.week_no = b.week_no - 53""")
def week_over_year(s: Star):
    orders = s.orders.filter(in_dates("sold_at", "1998-01-01", "2000-01-16") & F.col("channel").isin("web", "catalog"))
    weeks = (s.lines.join(orders, "order_id").groupBy(week_no().alias("week_no")).agg(*by_weekday("sold_on", "gross")))
    names = [f"{d}_sales" for d in DAYS]
    both = against_offset(weeks, [], "week_no", 53, names)
    return both.select("week_no", *[F.round(ratio(n, n + "_later"), 2).alias(f"{d}_ratio") for d, n in zip(DAYS, names)])


@query("week_over_year_outlet", f"""
WITH wk AS (
  SELECT {_WEEK_SQL} AS week_no, outlet_nation,
{_DAY_SQL}
  FROM sales JOIN outlet USING (outlet_id)
  WHERE channel = 'store' AND sold_at >= TIMESTAMP '1999-01-01' AND sold_at < TIMESTAMP '2001-01-01' GROUP BY 1, 2)
SELECT a.outlet_nation AS outlet_nation, a.week_no AS week_no, {_WEEK_RATIO}
FROM wk a JOIN wk b ON a.week_no = b.week_no - 52 AND a.outlet_nation = b.outlet_nation
ORDER BY outlet_nation, week_no LIMIT 100""")
def week_over_year_outlet(s: Star):
    orders = s.orders.filter(in_dates("sold_at", "1999-01-01", "2001-01-01") & (F.col("channel") == "store"))
    weeks = (s.lines.join(orders, "order_id").join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
             .groupBy(week_no().alias("week_no"), "outlet_nation").agg(*by_weekday("sold_on", "gross")))
    names = [f"{d}_sales" for d in DAYS]
    both = against_offset(weeks, ["outlet_nation"], "week_no", 52, names)
    return (both.select("outlet_nation", "week_no",
                        *[F.round(ratio(n, n + "_later"), 2).alias(f"{d}_ratio") for d, n in zip(DAYS, names)])
            .orderBy("outlet_nation", "week_no").limit(100))


@query("wide_join_yoy", """
WITH liked AS (
  SELECT item_id FROM lines GROUP BY item_id
  HAVING round(sum(gross), 2) > 2 * round(sum(CASE WHEN returned THEN gross ELSE 0.0 END), 2)),
x AS (
  SELECT item_id, item_name, outlet_nation, buyer_region, year(sold_on) AS y, count(*) AS cnt,
         round(sum(gross), 2) AS s1, round(sum(gross * (1.0 - discount)), 4) AS s2
  FROM sales JOIN item USING (item_id) JOIN buyer USING (buyer_id) JOIN outlet USING (outlet_id)
  WHERE item_id IN (SELECT item_id FROM liked) AND buyer_nation <> outlet_nation
    AND list_price BETWEEN 920 AND 980 AND sold_at >= TIMESTAMP '1999-01-01' AND sold_at < TIMESTAMP '2001-01-01'
  GROUP BY 1, 2, 3, 4, 5)
SELECT a.item_id AS item_id, a.item_name AS item_name, a.outlet_nation AS outlet_nation, a.buyer_region AS buyer_region,
       a.cnt AS cnt_1999, b.cnt AS cnt_2000, a.s1 AS gross_1999, b.s1 AS gross_2000, a.s2 AS net_1999, b.s2 AS net_2000
FROM x a JOIN x b ON a.item_id = b.item_id AND a.outlet_nation = b.outlet_nation AND a.buyer_region = b.buyer_region
WHERE a.y = 1999 AND b.y = 2000 AND b.cnt <= a.cnt""")
def wide_join_yoy(s: Star):
    """Items sold to other nations in two years; both years come from one pass
    over the wide join, one aggregation per year being a conditional sum."""
    gone = F.when(F.col("returned"), F.col("gross")).otherwise(F.lit(0.0))
    liked = (s.lines.groupBy("item_id").agg(sum2("gross").alias("g"), F.round(F.sum(gone), 2).alias("r"))
             .filter(F.col("g") > 2 * F.col("r")).select("item_id"))
    items = (s.item.filter(F.col("list_price").between(920, 980)).select("item_id", "item_name")
             .join(liked, "item_id", "left_semi"))
    wide = (s.sold_between("1999-01-01", "2001-01-01").join(items, "item_id")
            .join(s.buyer.select("buyer_id", "buyer_nation", "buyer_region"), "buyer_id")
            .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
            .filter("buyer_nation <> outlet_nation"))
    year = F.year("sold_on")
    cols = []
    for y in (1999, 2000):
        cols += [F.count_if(year == y).alias(f"cnt_{y}"),
                 sum2(F.when(year == y, F.col("gross"))).alias(f"gross_{y}"),
                 sum4(F.when(year == y, F.col("gross") * (F.lit(1.0) - F.col("discount")))).alias(f"net_{y}")]
    return (wide.groupBy("item_id", "item_name", "outlet_nation", "buyer_region").agg(*cols)
            .filter("cnt_1999 > 0 AND cnt_2000 > 0 AND cnt_2000 <= cnt_1999"))
