"""Neighbouring periods, cumulative sums, best and worst lists."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.functions import in_dates, ratio, sum2
from lakeloom.operators.groups import with_group_aggs
from lakeloom.operators.ranking import top_ranked
from lakeloom.operators.series import running, with_neighbours
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star
from lakeloom.sources.frames import written_once

# Months beside each other are looked up by lag() and lead(); the mean of a year is
# joined from a grouping of its own.
_LAG = """
WITH months AS (
  SELECT {keys}, CAST(year(sold_on) AS BIGINT) AS sold_year, CAST(month(sold_on) AS BIGINT) AS sold_month,
         round(sum(gross), 2) AS month_sales
  FROM sales JOIN item USING (item_id) JOIN outlet USING (outlet_id)
  WHERE channel = '{channel}' AND sold_at >= TIMESTAMP '1998-12-01' AND sold_at < TIMESTAMP '2000-02-01'
  GROUP BY ALL),
means AS (SELECT {keys}, sold_year, round(sum(month_sales), 2) / count(*) AS mean_sales FROM months GROUP BY ALL),
beside AS (
  SELECT *, lag(month_sales) OVER seq AS previous_sales, lead(month_sales) OVER seq AS next_sales
  FROM months WINDOW seq AS (PARTITION BY {keys} ORDER BY sold_year * 12 + sold_month))
SELECT {keys}, sold_year, sold_month, round(mean_sales, 6) AS mean_sales, month_sales, previous_sales, next_sales
FROM beside JOIN means USING ({keys}, sold_year)
WHERE sold_year = 1999 AND previous_sales IS NOT NULL AND next_sales IS NOT NULL
  AND mean_sales > 0 AND abs(month_sales - mean_sales) > 0.1 * mean_sales"""


def _lag_sql(channel: str, *keys: str) -> str:
    return _LAG.format(keys=", ".join(keys), channel=channel)


def _lag_lead(s: Star, channel: str, keys: list[str]):
    orders = s.orders.filter((F.col("channel") == channel) & in_dates("sold_at", "1998-12-01", "2000-02-01"))
    items, outs = {"brand", "item_class"} & set(keys), {"outlet_nation", "outlet_name"} & set(keys)
    monthly = (s.lines.join(orders, "order_id").join(s.item.select("item_id", *sorted(items)), "item_id")
               .join(s.outlet.select("outlet_id", *sorted(outs)), "outlet_id")
               .groupBy(*keys, F.year("sold_on").cast("bigint").alias("sold_year"),
                        F.month("sold_on").cast("bigint").alias("sold_month"))
               .agg(sum2("gross").alias("month_sales")))
    # at most 14 months per group: both windows share one shuffle on the group
    year = Window.partitionBy(*keys, "sold_year")
    mean = F.try_divide(F.round(F.sum("month_sales").over(year), 2), F.count("month_sales").over(year))
    near = with_neighbours(monthly.withColumn("mean_sales", mean), keys, ["sold_year", "sold_month"], "month_sales",
                           "previous_sales", "next_sales")
    apart = F.abs(F.col("month_sales") - F.col("mean_sales")) > 0.1 * F.col("mean_sales")
    return (near.filter((F.col("sold_year") == 1999) & (F.col("mean_sales") > 0) & apart)
            .select(*keys, "sold_year", "sold_month", F.round("mean_sales", 6).alias("mean_sales"), "month_sales",
                    "previous_sales", "next_sales"))


@query("lag_lead", _lag_sql("store", "item_class", "brand", "outlet_nation"))
def lag_lead(s: Star):
    return _lag_lead(s, "store", ["item_class", "brand", "outlet_nation"])


@query("lag_lead_catalog", _lag_sql("catalog", "brand", "outlet_name"))
def lag_lead_catalog(s: Star):
    return _lag_lead(s, "catalog", ["brand", "outlet_name"])


@query("cumulative_cross", """
WITH daily AS (
  SELECT item_id, sold_on, sum(gross) FILTER (WHERE channel = 'web') AS web_day, sum(gross) FILTER (WHERE channel = 'store') AS store_day
  FROM sales WHERE channel <> 'catalog' AND year(sold_on) = 1999 GROUP BY item_id, sold_on),
summed AS (
  SELECT item_id, sold_on,
    CASE WHEN web_day IS NOT NULL THEN round(sum(web_day) OVER so_far, 2) END AS web_sales,
    CASE WHEN store_day IS NOT NULL THEN round(sum(store_day) OVER so_far, 2) END AS store_sales
  FROM daily WINDOW so_far AS (PARTITION BY item_id ORDER BY sold_on ROWS UNBOUNDED PRECEDING)),
highest AS (
  SELECT s.*, (SELECT max(e.web_sales) FROM summed e WHERE e.item_id = s.item_id AND e.sold_on <= s.sold_on) AS web_so_far,
         (SELECT max(e.store_sales) FROM summed e WHERE e.item_id = s.item_id AND e.sold_on <= s.sold_on) AS store_so_far
  FROM summed s)
SELECT * FROM highest WHERE web_so_far > store_so_far ORDER BY item_id, sold_on LIMIT 100""")
def cumulative_cross(s: Star):
    """Days on which an item's cumulative web sales exceed its cumulative store
    sales. Both channels are summed per (item, day) in one pass, which also is
    the full outer join of the two daily series."""
    orders = s.orders.filter(in_dates("sold_at", "1999-01-01", "2000-01-01") & F.col("channel").isin("web", "store"))
    cols = []
    for ch in ("web", "store"):
        cols += [F.sum(F.when(F.col("channel") == ch, F.col("gross"))).alias(f"{ch}_day"),
                 (F.count_if(F.col("channel") == ch) > 0).alias(f"{ch}_has")]
    days = s.lines.join(orders, "order_id").groupBy("item_id", "sold_on").agg(*cols)
    for ch in ("web", "store"):
        days = running(days, ["item_id"], "sold_on", f"{ch}_day", f"{ch}_run")
        days = days.withColumn(f"{ch}_sales", F.when(F.col(f"{ch}_has"), F.round(f"{ch}_run", 2)))
    for ch in ("web", "store"):
        days = running(days, ["item_id"], "sold_on", f"{ch}_sales", f"{ch}_so_far", how="max")
    return (days.filter("web_so_far > store_so_far")
            .select("item_id", "sold_on", "web_sales", "store_sales", "web_so_far", "store_so_far")
            .orderBy("item_id", "sold_on").limit(100))


@query("best_worst", """
WITH asian AS (SELECT item_id, gross FROM lines JOIN outlet USING (outlet_id) WHERE outlet_region = 'ASIA'),
means AS (SELECT item_id, round(sum(gross), 2) / count(gross) AS raw FROM asian GROUP BY item_id),
enough AS (SELECT item_id, round(raw, 6) AS mean FROM means WHERE raw > (SELECT 0.9 * (round(sum(gross), 2) / count(gross)) FROM asian)),
placed AS (
  SELECT item_id, item_name, (SELECT count(*) FROM enough o WHERE o.mean < e.mean) AS n_lower,
         (SELECT count(*) FROM enough o WHERE o.mean > e.mean) AS n_higher
  FROM enough e JOIN item USING (item_id))
SELECT 1 + low.n_lower AS rnk, low.item_name AS worst_name, low.item_id AS worst_id, high.item_name AS best_name, high.item_id AS best_id
FROM placed low JOIN placed high ON high.n_higher = low.n_lower WHERE low.n_lower < 10""")
def best_worst(s: Star):
    """Ten best and ten worst items by mean value, paired by rank."""
    asian = s.outlet.filter("outlet_region = 'ASIA'").select("outlet_id")
    per_item = written_once(s.lines.filter("item_id IS NOT NULL").join(asian, "outlet_id", "left_semi").groupBy("item_id").agg(
        sum2("gross").alias("s"), F.count("gross").alias("n")), "per_item")
    floor = per_item.agg(F.try_divide(sum2("s"), F.sum("n"))).scalar()
    raw = F.try_divide("s", "n")
    means = per_item.filter(raw > 0.9 * floor).select("item_id", F.round(raw, 6).alias("mean"))
    names = s.item.select("item_id", "item_name")

    def side(ascending: bool, prefix: str):
        best = top_ranked(means, [], "mean", 10, ascending=ascending).join(names, "item_id")
        return best.select("rnk", F.col("item_name").alias(f"{prefix}_name"), F.col("item_id").alias(f"{prefix}_id"))

    return side(True, "worst").join(side(False, "best"), "rnk")


@query("dual_rank", """
WITH rates AS (
  SELECT channel, item_id,
    round(CAST(sum(quantity) FILTER (WHERE returned) AS DOUBLE) / sum(quantity), 9) AS return_ratio,
    round(round(sum(gross) FILTER (WHERE returned), 2) / round(sum(gross), 2), 9) AS currency_ratio
  FROM sales
  WHERE gross > 1000 AND quantity > 0 AND sold_at >= TIMESTAMP '2000-12-01' AND sold_at < TIMESTAMP '2001-01-01'
  GROUP BY channel, item_id HAVING bool_or(returned)),
placed AS (
  SELECT r.*, 1 + (SELECT count(*) FROM rates o WHERE o.channel = r.channel AND o.return_ratio < r.return_ratio) AS return_rank,
    1 + (SELECT count(*) FROM rates o WHERE o.channel = r.channel AND o.currency_ratio < r.currency_ratio) AS currency_rank
  FROM rates r)
SELECT channel, item_id, return_ratio, currency_ratio, return_rank, currency_rank
FROM placed WHERE least(return_rank, currency_rank) <= 10""")
def dual_rank(s: Star):
    """Items among the ten lowest by either of two return ratios, per channel.

    Each measure's own top list is pruned per task; only for the items on one of them
    the rank by the other measure is found, by counting how many items lie between
    two listed values and adding these counts up."""
    orders = s.orders.filter(in_dates("sold_at", "2000-12-01", "2001-01-01"))
    gone = F.col("returned")
    sold = s.lines.filter("gross > 1000 AND quantity > 0").join(orders, "order_id").groupBy("channel", "item_id").agg(
        F.sum(F.when(gone, F.col("quantity")).otherwise(0.0)).alias("rq"), F.sum("quantity").alias("q"),
        F.round(F.sum(F.when(gone, F.col("gross")).otherwise(0.0)), 2).alias("rv"), sum2("gross").alias("v"),
        F.count_if(gone).alias("n_back"))
    by_item = written_once(
        sold.filter("n_back > 0").select("channel", "item_id", F.round(ratio("rq", "q"), 9).alias("return_ratio"),
                                         F.round(ratio("rv", "v"), 9).alias("currency_ratio")), "by_item")
    measures = ("return", "currency")

    def lowest(m: str):
        return top_ranked(by_item, ["channel"], f"{m}_ratio", 10, ascending=True, name="_r").drop("_r")

    listed = lowest("return").unionByName(lowest("currency")).distinct()
    # at most ten values and their ties per measure, so one short array per channel
    values = listed.groupBy("channel").agg(*[F.array_sort(F.collect_set(f"{m}_ratio")).alias(f"{m}_values") for m in measures])

    def passed(m: str):
        return F.size(F.filter(f"{m}_values", lambda x: x <= F.col(f"{m}_ratio"))).alias(f"{m}_passed")

    def rank_by(m: str):
        place = F.array_position(f"{m}_values", F.col(f"{m}_ratio"))
        before = F.transform("counts", lambda c: F.when(c[f"{m}_passed"] < place, c["n"]).otherwise(0))
        return (1 + F.aggregate(before, F.lit(0).cast("bigint"), lambda a, n: a + n)).alias(f"{m}_rank")

    between = (by_item.join(values, "channel").select("channel", *map(passed, measures))
               .groupBy("channel", *[f"{m}_passed" for m in measures]).agg(F.count("*").alias("n")))
    lists = between.groupBy("channel").agg(F.collect_list(F.struct("return_passed", "currency_passed", "n")).alias("counts"))
    placed = listed.join(values, "channel").join(lists, "channel")
    return placed.select("channel", "item_id", "return_ratio", "currency_ratio", *map(rank_by, measures))


@query("group_share_running", """
SELECT item_class, CAST(date_trunc('month', sold_on) AS DATE) AS m, round(sum(gross), 2) AS sales,
       round(sum(round(sum(gross), 2)) OVER (PARTITION BY item_class ORDER BY date_trunc('month', sold_on) ROWS UNBOUNDED PRECEDING), 2) AS running_sales,
       round(round(sum(gross), 2) * 100 / round(sum(round(sum(gross), 2)) OVER (PARTITION BY item_class), 2), 6) AS share_pct
FROM sales JOIN item USING (item_id) GROUP BY item_class, date_trunc('month', sold_on)""")
def group_share_running(s: Star):
    monthly = (s.sales.join(s.item.select("item_id", "item_class"), "item_id")
               .groupBy("item_class", F.trunc("sold_on", "month").alias("m")).agg(sum2("gross").alias("sales")))
    out = with_group_aggs(running(monthly, ["item_class"], "m", "sales", "run"), ["item_class"], total=sum2("sales"))
    return out.select("item_class", "m", "sales", F.round("run", 2).alias("running_sales"),
                      F.round(ratio(F.col("sales") * 100, "total"), 6).alias("share_pct"))
