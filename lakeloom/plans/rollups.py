"""Subtotals over column hierarchies and ranks inside each level.

Facts are first summed to the finest group; the rollup expands only those rows.
Counts and sums of a finer group add up to those of a coarser one."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.functions import in_dates, ratio, sum2
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star


def rollup_averages(base, keys: list[str], values: list[str]):
    """AVG per level from sums and counts of the finest group."""
    return base.rollup(*keys).agg(
        F.grouping_id().cast("bigint").alias("level_id"),
        *[F.round(F.try_divide(F.round(F.sum(f"{v}_s"), 2), F.sum(f"{v}_n")), 6).alias(f"avg_{v}") for v in values])


def _sums(df, keys: list[str], values: list[str]):
    return df.groupBy(*keys).agg(*[c for v in values for c in
                                   (sum2(v).alias(f"{v}_s"), F.count(v).alias(f"{v}_n"))])


@query("rollup_avg", """
SELECT item_class, outlet_nation, CAST(grouping(outlet_nation) AS BIGINT) AS g_nation,
       round(round(sum(quantity), 2) / count(quantity), 6) AS avg_quantity,
       round(round(sum(gross), 2) / count(gross), 6) AS avg_gross
FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id)
WHERE channel = 'store' AND outlet_region IN ('ASIA', 'AFRICA')
GROUP BY ROLLUP (item_class, outlet_nation)
ORDER BY item_class NULLS LAST, outlet_nation NULLS LAST LIMIT 100""")
def rollup_avg(s: Star):
    out = s.outlet.filter(F.col("outlet_region").isin("ASIA", "AFRICA")).select("outlet_id", "outlet_nation")
    rows = (s.lines.join(s.orders.filter("channel = 'store'"), "order_id").join(out, "outlet_id")
            .join(s.item.select("item_id", "item_class"), "item_id"))
    keys, values = ["item_class", "outlet_nation"], ["quantity", "gross"]
    avg = [F.round(F.try_divide(F.round(F.sum(f"{v}_s"), 2), F.sum(f"{v}_n")), 6).alias(f"avg_{v}") for v in values]
    return (_sums(rows, keys, values).rollup(*keys)
            .agg(F.grouping("outlet_nation").cast("bigint").alias("g_nation"), *avg)
            .orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(100))


@query("rollup_avg_deep", """
SELECT brand, outlet_region, buyer_region, segment,
       CAST(grouping(brand, outlet_region, buyer_region, segment) AS BIGINT) AS level_id,
       round(round(sum(quantity), 2) / count(quantity), 6) AS avg_quantity,
       round(round(sum(gross), 2) / count(gross), 6) AS avg_gross,
       round(round(sum(discount), 2) / count(discount), 6) AS avg_discount
FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id) JOIN buyer USING (buyer_id)
WHERE channel = 'catalog' AND sold_at >= TIMESTAMP '1998-01-01' AND sold_at < TIMESTAMP '1999-01-01'
GROUP BY ROLLUP (brand, outlet_region, buyer_region, segment)""")
def rollup_avg_deep(s: Star):
    orders = s.orders.filter((F.col("channel") == "catalog") & in_dates("sold_at", "1998-01-01", "1999-01-01"))
    rows = (s.lines.join(orders, "order_id").join(s.item.select("item_id", "brand"), "item_id")
            .join(s.outlet.select("outlet_id", "outlet_region"), "outlet_id")
            .join(s.buyer.select("buyer_id", "buyer_region", "segment"), "buyer_id"))
    keys, values = ["brand", "outlet_region", "buyer_region", "segment"], ["quantity", "gross", "discount"]
    return rollup_averages(_sums(rows, keys, values), keys, values)


@query("rollup_stock", """
SELECT item_name, brand, item_class, round(round(sum(on_hand), 2) / count(on_hand), 6) AS avg_stock
FROM stock JOIN item USING (item_id)
WHERE stock_month BETWEEN DATE '2000-01-01' AND DATE '2000-12-01'
GROUP BY ROLLUP (item_name, brand, item_class)
ORDER BY avg_stock, item_name NULLS LAST, brand NULLS LAST, item_class NULLS LAST LIMIT 100""")
def rollup_stock(s: Star):
    monthly = (s.lines.filter(in_dates("shipped_at", "2000-01-01", "2001-01-01"))
               .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
               .groupBy("item_id", "outlet_nation", F.trunc("shipped_on", "month").alias("m"))
               .agg(F.sum("quantity").alias("on_hand")))
    keys = ["item_name", "brand", "item_class"]
    rows = monthly.join(s.item.select("item_id", *keys), "item_id")
    return (rollup_averages(_sums(rows, keys, ["on_hand"]), keys, ["on_hand"])
            .select(*keys, F.col("avg_on_hand").alias("avg_stock"))
            .orderBy("avg_stock", *[F.asc_nulls_last(k) for k in keys]).limit(100))


# The three levels are grouped one by one and ranked by counting better rows.
_RANK = """
WITH base AS (SELECT * FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id) WHERE {where}),
level AS (
  SELECT {a}, {b}, CAST(0 AS BIGINT) AS depth, {measure} AS measure FROM base GROUP BY 1, 2
  UNION ALL SELECT {a}, NULL, 1, {measure} FROM base GROUP BY 1
  UNION ALL SELECT NULL, NULL, 2, {measure} FROM base)
SELECT l.{a} AS {a}, l.{b} AS {b}, l.depth AS depth, l.measure AS measure,
  1 + (SELECT count(*) FROM level o WHERE o.depth = l.depth AND (l.depth > 0 OR o.{a} = l.{a}) AND o.measure {better} l.measure)
    AS rank_in_level
FROM level l"""


def rank_in_level(levels, parent: str, measure: str, ascending: bool):
    """rank() of a measure among the rows of one level and parent. A level holds one
    row per pair of dimension values, so its groups are small whatever the facts."""
    order = F.col(measure).asc() if ascending else F.col(measure).desc()
    inside = Window.partitionBy("depth", F.when(F.col("depth") == 0, F.col(parent))).orderBy(order)
    return levels.withColumn("rank_in_level", F.rank().over(inside).cast("bigint"))


def _levels(base, a: str, b: str, measure):
    return base.rollup(a, b).agg((F.grouping(a) + F.grouping(b)).cast("bigint").alias("depth"),
                                 measure.alias("measure"))


@query("rollup_rank", _RANK.format(a="item_class", b="brand", better="<", where="channel = 'store'",
                                   measure="round(round(sum(gross * discount), 4) / round(sum(gross), 2), 6)"))
def rollup_rank(s: Star):
    rows = (s.lines.join(s.orders.filter("channel = 'store'"), "order_id")
            .join(s.item.select("item_id", "item_class", "brand"), "item_id"))
    base = rows.groupBy("item_class", "brand").agg(
        F.round(F.sum(F.col("gross") * F.col("discount")), 4).alias("d"), sum2("gross").alias("g"))
    margin = F.round(ratio(F.round(F.sum("d"), 4), sum2("g")), 6)
    return rank_in_level(_levels(base, "item_class", "brand", margin), "item_class", "measure", True)


@query("rollup_rank_web", _RANK.format(a="item_class", b="brand", better=">", measure="round(sum(gross), 2)",
                                       where="channel = 'web' AND sold_at >= TIMESTAMP '1999-01-01' AND sold_at < TIMESTAMP '2000-01-01'"))
def rollup_rank_web(s: Star):
    orders = s.orders.filter((F.col("channel") == "web") & in_dates("sold_at", "1999-01-01", "2000-01-01"))
    base = (s.lines.join(orders, "order_id").groupBy("item_id").agg(sum2("gross").alias("g"))
            .join(s.item.select("item_id", "item_class", "brand"), "item_id")
            .groupBy("item_class", "brand").agg(sum2("g").alias("g")))
    return rank_in_level(_levels(base, "item_class", "brand", sum2("g")), "item_class", "measure", False)


@query("rollup_rank_outlet", _RANK.format(a="outlet_region", b="outlet_nation", better=">", measure="round(sum(gross), 2)",
                                          where="""outlet_region IN (
    SELECT outlet_region FROM (
      SELECT outlet_region, rank() OVER (ORDER BY round(sum(gross), 2) DESC) AS ranking
      FROM sales JOIN outlet USING (outlet_id) WHERE sold_at >= TIMESTAMP '1998-01-01' AND sold_at < TIMESTAMP '1999-01-01'
      GROUP BY outlet_region) WHERE ranking <= 3)
    AND sold_at >= TIMESTAMP '1998-01-01' AND sold_at < TIMESTAMP '1999-01-01'"""))
def rollup_rank_outlet(s: Star):
    """Subtotals for the three regions with the largest sales (a rank over all
    regions; one inside a region would keep every region)."""
    base = (s.sold_between("1998-01-01", "1999-01-01").groupBy("outlet_id").agg(F.sum("gross").alias("g"))
            .join(s.outlet.select("outlet_id", "outlet_region", "outlet_nation"), "outlet_id")
            .groupBy("outlet_region", "outlet_nation").agg(sum2("g").alias("g")))
    regions = base.groupBy("outlet_region").agg(sum2("g").alias("total"))
    # one row per region: the window group limit leaves three of them per task
    best = (regions.withColumn("ranking", F.rank().over(Window.orderBy(F.desc("total"))))
            .filter("ranking <= 3").select("outlet_region"))
    kept = base.join(best, "outlet_region", "left_semi")
    return rank_in_level(_levels(kept, "outlet_region", "outlet_nation", sum2("g")), "outlet_region", "measure", False)


_EIGHT = ["item_class", "brand", "item_name", "outlet_region", "y", "q", "m", "outlet_nation"]


@query("rollup_topn", """
WITH r AS (
  SELECT item_class, brand, item_name, outlet_region, CAST(year(sold_on) AS BIGINT) AS y, CAST(quarter(sold_on) AS BIGINT) AS q,
         CAST(month(sold_on) AS BIGINT) AS m, outlet_nation, round(sum(gross), 2) AS sumsales
  FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id)
  WHERE sold_at >= TIMESTAMP '2000-01-01' AND sold_at < TIMESTAMP '2001-01-01'
  GROUP BY ROLLUP (item_class, brand, item_name, outlet_region, y, q, m, outlet_nation))
SELECT * FROM (SELECT *, rank() OVER (PARTITION BY item_class ORDER BY sumsales DESC) AS rk FROM r) WHERE rk <= 20""")
def rollup_topn(s: Star):
    rows = (s.sold_between("2000-01-01", "2001-01-01")
            .join(s.item.select("item_id", "item_class", "brand", "item_name"), "item_id")
            .join(s.outlet.select("outlet_id", "outlet_region", "outlet_nation"), "outlet_id"))
    b = lambda c: c.cast("bigint")
    base = (rows.groupBy("item_class", "brand", "item_name", "outlet_region", b(F.year("sold_on")).alias("y"),
                         b(F.quarter("sold_on")).alias("q"), b(F.month("sold_on")).alias("m"), "outlet_nation")
            .agg(sum2("gross").alias("g")))
    levels = base.rollup(*_EIGHT).agg(sum2("g").alias("sumsales"))
    # one sum per row and a short list: the window group limit prunes each task's rows
    best = Window.partitionBy("item_class").orderBy(F.desc("sumsales"))
    return levels.withColumn("rk", F.rank().over(best).cast("bigint")).filter("rk <= 20")
