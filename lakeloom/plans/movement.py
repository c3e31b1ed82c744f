"""Variation of stock, sale-return-repurchase chains, demand against stock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.functions import in_dates, ratio
from lakeloom.operators.moments import merged_beside, parts, weighted
from lakeloom.operators.series import against_offset
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star


@query("cov", """
SELECT item_id, count(quantity) AS n, round(round(sum(quantity), 2) / count(quantity), 6) AS avg_quantity,
       round(stddev_samp(quantity), 6) AS std_quantity,
       round(stddev_samp(quantity) / (round(sum(quantity), 2) / count(quantity)), 6) AS cov
FROM lines GROUP BY 1""")
def cov(s: Star):
    mean = F.try_divide(F.round(F.sum("quantity"), 2), F.count("quantity"))
    std = F.stddev_samp("quantity")
    return s.lines.groupBy("item_id").agg(
        F.count("quantity").alias("n"), F.round(mean, 6).alias("avg_quantity"),
        F.round(std, 6).alias("std_quantity"), F.round(ratio(std, mean), 6).alias("cov"))


_MONTH_NO = "CAST(year(shipped_on) * 12 + month(shipped_on) AS BIGINT)"


@query("cov_pairs", f"""
WITH m AS (
  SELECT brand, outlet_region, {_MONTH_NO} AS month_no,
         round(round(sum(quantity), 2) / count(quantity), 6) AS mean, round(stddev_samp(quantity), 6) AS std
  FROM lines JOIN outlet USING (outlet_id) JOIN item USING (item_id)
  WHERE shipped_at >= TIMESTAMP '1999-01-01' AND shipped_at < TIMESTAMP '2000-01-01' GROUP BY 1, 2, 3),
v AS (SELECT *, round(CASE WHEN mean = 0 THEN NULL ELSE std / mean END, 4) AS cov FROM m
      WHERE CASE WHEN mean = 0 THEN 0 ELSE std / mean END > 0.7)
SELECT a.brand AS brand, a.outlet_region AS outlet_region, a.month_no AS month_no, a.mean AS mean, a.cov AS cov,
       b.mean AS mean_later, b.cov AS cov_later
FROM v a JOIN v b ON b.brand = a.brand AND b.outlet_region = a.outlet_region AND b.month_no = a.month_no + 1""")
def cov_pairs(s: Star):
    lines = (s.lines.filter(in_dates("shipped_at", "1999-01-01", "2000-01-01"))
             .join(s.outlet.select("outlet_id", "outlet_region"), "outlet_id")
             .join(s.item.select("item_id", "brand"), "item_id"))
    month_no = (F.year("shipped_on") * 12 + F.month("shipped_on")).cast("bigint")
    mean = F.round(F.try_divide(F.round(F.sum("quantity"), 2), F.count("quantity")), 6)
    monthly = (lines.groupBy("brand", "outlet_region", month_no.alias("month_no"))
               .agg(mean.alias("mean"), F.round(F.stddev_samp("quantity"), 6).alias("std")))
    share = ratio("std", "mean")
    varied = monthly.filter(share > 0.7).withColumn("cov", F.round(share, 4)).drop("std")
    return against_offset(varied, ["brand", "outlet_region"], "month_no", 1, ["mean", "cov"])


def moments(sides: dict[str, Column], value: str) -> list[Column]:
    """Count and sum of a value per condition: what is needed to get the sums of a
    many-to-many join without forming its pairs."""
    out = []
    for name, cond in sides.items():
        v = F.when(cond, F.col(value))
        out += [F.count(v).alias(f"{name}_n"), F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{name}_s")]
    return out


def _stats(prefix: str) -> list[Column]:
    n, mean = F.col(f"{prefix}_n"), F.col(f"{prefix}_mean")
    std = F.sqrt(F.try_divide(f"{prefix}_m2", (n - 1).cast("double")))
    return [n.alias(f"{prefix}_count"), F.round(mean, 6).alias(f"{prefix}_avg"), F.round(std, 6).alias(f"{prefix}_std"),
            F.round(ratio(std, mean), 6).alias(f"{prefix}_cov")]


@query("repurchase_chain", """
WITH sold AS (SELECT buyer_id, item_id, outlet_id, quantity FROM sales
              WHERE channel = 'store' AND NOT returned),
back AS (SELECT buyer_id, item_id, quantity AS returned_quantity FROM sales WHERE returned),
again AS (SELECT buyer_id, item_id, quantity AS again_quantity FROM sales WHERE channel = 'catalog' AND NOT returned)
SELECT item_class, outlet_nation,
  count(quantity) AS sold_count, round(avg(quantity), 6) AS sold_avg, round(stddev_samp(quantity), 6) AS sold_std,
  round(stddev_samp(quantity) / avg(quantity), 6) AS sold_cov,
  count(returned_quantity) AS back_count, round(avg(returned_quantity), 6) AS back_avg,
  round(stddev_samp(returned_quantity), 6) AS back_std, round(stddev_samp(returned_quantity) / avg(returned_quantity), 6) AS back_cov,
  count(again_quantity) AS again_count, round(avg(again_quantity), 6) AS again_avg,
  round(stddev_samp(again_quantity), 6) AS again_std, round(stddev_samp(again_quantity) / avg(again_quantity), 6) AS again_cov
FROM sold JOIN back USING (buyer_id, item_id) JOIN again USING (buyer_id, item_id)
  JOIN item USING (item_id) JOIN outlet USING (outlet_id)
GROUP BY 1, 2""")
def repurchase_chain(s: Star):
    """Statistics over sale x return x repurchase of the same buyer and item.
    Every side is first reduced to moments per (buyer, item); a pair's multiplicity
    then weights the sums, so no pairs are emitted. All three sides come from one
    scan; the window adds up at most one row per outlet."""
    kept = ~F.col("returned")
    sides = {"sold": (F.col("channel") == "store") & kept, "back": F.col("returned"),
             "again": (F.col("channel") == "catalog") & kept}
    per_outlet = s.sales.groupBy("buyer_id", "item_id", "outlet_id").agg(*parts(sides, "quantity"))
    for side in ("back", "again"):
        per_outlet = merged_beside(per_outlet, ["buyer_id", "item_id"], side)
    j = (per_outlet.filter("sold_n > 0 AND back_n > 0 AND again_n > 0")
         .join(s.item.select("item_id", "item_class"), "item_id")
         .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id"))
    weight = {"sold": F.col("back_n") * F.col("again_n"), "back": F.col("sold_n") * F.col("again_n"),
              "again": F.col("sold_n") * F.col("back_n")}
    g = weighted(j, ["item_class", "outlet_nation"], weight)
    return g.select("item_class", "outlet_nation", *[c for side in sides for c in _stats(side)])


@query("repurchase_extremes", """
WITH sold AS (SELECT buyer_id, item_id, outlet_id, gross * (1.0 - discount) AS profit FROM sales WHERE channel = 'store'),
back AS (SELECT buyer_id, item_id, gross AS loss FROM sales WHERE returned),
again AS (SELECT buyer_id, item_id, gross * (1.0 - discount) AS again_profit FROM sales WHERE channel = 'catalog')
SELECT item_id, outlet_id, round(max(profit), 4) AS max_profit, max(loss) AS max_loss, round(max(again_profit), 4) AS max_again_profit
FROM sold JOIN back USING (buyer_id, item_id) JOIN again USING (buyer_id, item_id)
GROUP BY 1, 2 ORDER BY item_id, outlet_id LIMIT 100""")
def repurchase_extremes(s: Star):
    # the largest value over pairs is the largest value of each side
    profit = F.col("gross") * (F.lit(1.0) - F.col("discount"))
    per_outlet = s.sales.groupBy("buyer_id", "item_id", "outlet_id").agg(
        F.max(F.when(F.col("channel") == "store", profit)).alias("p"),
        F.max(F.when(F.col("returned"), F.col("gross"))).alias("l"),
        F.max(F.when(F.col("channel") == "catalog", profit)).alias("a"))
    pair = Window.partitionBy("buyer_id", "item_id")
    return (per_outlet.withColumns({"l": F.max("l").over(pair), "a": F.max("a").over(pair)})
            .filter("p IS NOT NULL AND l IS NOT NULL AND a IS NOT NULL").groupBy("item_id", "outlet_id")
            .agg(F.round(F.max("p"), 4).alias("max_profit"), F.max("l").alias("max_loss"),
                 F.round(F.max("a"), 4).alias("max_again_profit"))
            .orderBy("item_id", "outlet_id").limit(100))


@query("repurchase_quantities", """
WITH sold AS (SELECT buyer_id, item_id, outlet_id, quantity AS q1 FROM sales
              WHERE channel = 'store' AND sold_at >= TIMESTAMP '1996-01-01' AND sold_at < TIMESTAMP '1999-01-01'),
back AS (SELECT buyer_id, item_id, quantity AS q2 FROM sales WHERE returned AND sold_at >= TIMESTAMP '1996-01-01'),
again AS (SELECT buyer_id, item_id, quantity AS q3 FROM sales WHERE channel = 'catalog' AND sold_at >= TIMESTAMP '1997-01-01')
SELECT item_id, outlet_id, sum(q1) AS sold_quantity, sum(q2) AS returned_quantity, sum(q3) AS again_quantity
FROM sold JOIN back USING (buyer_id, item_id) JOIN again USING (buyer_id, item_id)
GROUP BY 1, 2 ORDER BY item_id, outlet_id LIMIT 100""")
def repurchase_quantities(s: Star):
    """Quantities summed over all sale, return and repurchase pairs, each with its
    own date range, from counts and sums per (buyer, item)."""
    at = F.col("sold_at")
    since = lambda d: at >= F.lit(d).cast("timestamp_ntz")
    sides = {"sold": (F.col("channel") == "store") & in_dates("sold_at", "1996-01-01", "1999-01-01"),
             "back": F.col("returned") & since("1996-01-01"), "again": (F.col("channel") == "catalog") & since("1997-01-01")}
    per_outlet = s.sales.filter(since("1996-01-01")).groupBy("buyer_id", "item_id", "outlet_id").agg(*moments(sides, "quantity"))
    pair = Window.partitionBy("buyer_id", "item_id")
    j = per_outlet.withColumns({c: F.sum(c).over(pair) for c in ("back_n", "back_s", "again_n", "again_s")}).filter(
        "sold_n > 0 AND back_n > 0 AND again_n > 0")
    return (j.groupBy("item_id", "outlet_id").agg(
        F.sum(F.col("sold_s") * F.col("back_n") * F.col("again_n")).alias("sold_quantity"),
        F.sum(F.col("back_s") * F.col("sold_n") * F.col("again_n")).alias("returned_quantity"),
        F.sum(F.col("again_s") * F.col("sold_n") * F.col("back_n")).alias("again_quantity"))
        .orderBy("item_id", "outlet_id").limit(100))


@query("returned_and_paid", """
SELECT outlet_name, round(sum(CASE WHEN returned THEN gross ELSE 0.0 END), 2) AS returned_amount,
       round(sum(gross), 2) AS net_paid
FROM sales JOIN outlet USING (outlet_id)
WHERE order_id IN (SELECT order_id FROM lines WHERE returned AND shipped_at >= TIMESTAMP '2000-11-01' AND shipped_at < TIMESTAMP '2000-12-01')
  AND channel = 'store'
GROUP BY 1""")
def returned_and_paid(s: Star):
    came_back = s.lines.filter(F.col("returned") & in_dates("shipped_at", "2000-11-01", "2000-12-01")).select("order_id")
    orders = s.orders.filter("channel = 'store'").join(came_back, "order_id", "left_semi")
    return (s.lines.join(orders, "order_id").join(s.outlet.select("outlet_id", "outlet_name"), "outlet_id")
            .groupBy("outlet_name")
            .agg(F.round(F.sum(F.when(F.col("returned"), F.col("gross")).otherwise(0.0)), 2).alias("returned_amount"),
                 F.round(F.sum("gross"), 2).alias("net_paid")))


@query("theta_stock", """
WITH demand AS (
  SELECT item_id, date_trunc('month', sold_on) AS m, quantity, discount > 0.05 AS promoted
  FROM sales WHERE channel = 'catalog' AND date_diff('day', sold_on, shipped_on) > 5
    AND sold_at >= TIMESTAMP '1999-01-01' AND sold_at < TIMESTAMP '2000-01-01')
SELECT item_class, outlet_nation, CAST(stock_month AS DATE) AS stock_month,
       count(*) FILTER (WHERE NOT promoted) AS no_promo, count(*) FILTER (WHERE promoted) AS promo, count(*) AS total_cnt
FROM demand d JOIN stock s ON s.item_id = d.item_id AND CAST(s.stock_month AS DATE) = CAST(d.m AS DATE) AND s.on_hand < d.quantity
  JOIN item ON item.item_id = d.item_id
GROUP BY 1, 2, 3""")
def theta_stock(s: Star):
    """Catalog demand above the month's stock. Demand is reduced to counts per
    (item, month, quantity) before it meets the stock rows, so an often ordered
    item does not multiply with its stock."""
    key = ["item_id", "stock_month"]
    orders = s.orders.filter((F.col("channel") == "catalog") & in_dates("sold_at", "1999-01-01", "2000-01-01"))
    demand = (s.lines.join(orders, "order_id").filter(F.datediff("shipped_on", "sold_on") > 5)
              .groupBy("item_id", F.trunc("sold_on", "month").alias("stock_month"), "quantity")
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("discount") > 0.05).alias("n_promo")))
    stock = (s.lines.filter(in_dates("shipped_at", "1999-01-01", "2000-01-01"))
             .join(s.outlet.select("outlet_id", "outlet_nation"), "outlet_id")
             .groupBy("item_id", "outlet_nation", F.trunc("shipped_on", "month").alias("stock_month"))
             .agg(F.sum("quantity").alias("on_hand")))
    return (demand.join(stock, key).filter("on_hand < quantity")
            .join(s.item.select("item_id", "item_class"), "item_id")
            .groupBy("item_class", "outlet_nation", "stock_month")
            .agg(F.sum(F.col("n") - F.col("n_promo")).alias("no_promo"), F.sum("n_promo").alias("promo"),
                 F.sum("n").alias("total_cnt")))
