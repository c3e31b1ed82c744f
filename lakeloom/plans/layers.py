"""Layer operators on the given tables: gold, silver, quality, upsert, checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import compare, runs
from lakeloom.operators.conform import any_by_key, cast_failures, conform, latest_by_key
from lakeloom.operators.quality import check_rows, duplicate_keys, orphans
from lakeloom.operators.upsert import upsert
from lakeloom.plans import gold
from lakeloom.plans.registry import query
from lakeloom.plans.star import Star
from lakeloom.sources.seed import shift_dates
from lakeloom.sources.snapshot import ingest_snapshot
from lakeloom.sources.streams import parse_click_events, parse_gps
from lakeloom.sources.tables import trimmed


def _order_items(s: Star):
    return s.lines.select("order_id", F.col("item_id").alias("product_id"), F.col("gross").alias("sale_price"))


def _products(s: Star):
    return s.item.select(F.col("item_id").alias("id"), F.col("item_class").alias("category"))


@query("sales_performance", """
SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS order_date, p_type AS product_category,
       round(sum(l_extendedprice), 2) AS total_revenue, count(*) AS total_items_sold
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2""", star=False)
def sales_performance(s: Star):
    out = gold.sales_performance(_order_items(s), s.orders.withColumnRenamed("sold_at", "created_at"), _products(s))
    return out.select(F.col("order_date").cast("timestamp_ntz").alias("order_date"), "product_category",
                      F.round("total_revenue", 2).alias("total_revenue"), "total_items_sold")


@query("user_engagement", """
SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, count(*) AS event_count, max(ts) AS last_event_at
FROM events GROUP BY 1""", star=False)
def user_engagement(s: Star):
    # error events count as events without a user, so the NULL group is exercised
    return gold.user_engagement(s.events.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), F.col("ts").alias("created_at")))


@query("user_statistics", """
WITH n AS (SELECT l_orderkey, count(*) AS num_of_item, sum(l_extendedprice) AS spend FROM lineitem GROUP BY 1),
o AS (SELECT o_custkey, count(o_orderkey) AS total_orders, sum(num_of_item) AS items, sum(spend) AS spend, max(o_orderdate) AS last_order_at
      FROM orders LEFT JOIN n ON l_orderkey = o_orderkey GROUP BY 1),
e AS (SELECT user_id, count(event_id) AS total_events, max(ts) AS last_event_at FROM events GROUP BY 1)
SELECT c_custkey AS user_id, coalesce(total_orders, 0) AS total_orders, CAST(coalesce(items, 0) AS BIGINT) AS total_items_purchased,
       round(coalesce(spend, 0.0), 2) AS total_spend, coalesce(total_events, 0) AS total_events, last_order_at, last_event_at
FROM customer LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN e ON user_id = c_custkey""", star=False)
def user_statistics(s: Star):
    counts = s.lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("num_of_item"))
    orders = s.orders.join(counts, "order_id", "left").select(
        "order_id", F.col("buyer_id").alias("user_id"), "num_of_item", F.col("sold_at").alias("created_at"))
    events = s.events.select(F.col("event_id").alias("id"), "user_id", F.col("ts").alias("created_at"))
    return gold.user_statistics(s.table("customer").select(F.col("c_custkey").alias("id")), orders, _order_items(s), events)


_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
         "l_linestatus"]


@query("silver_latest_by_key", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {" DESC, ".join(_LINE)} DESC) AS rn
  FROM lineitem) WHERE rn = 1""", star=False)
def silver_latest_by_key(s: Star):
    return latest_by_key(s.table("lineitem"), ["l_orderkey", "l_linenumber"], _LINE)


@query("silver_any_by_key", "SELECT l_orderkey, l_linenumber, TRUE AS is_a_row FROM lineitem GROUP BY 1, 2", star=False)
def silver_any_by_key(s: Star):
    """Any whole row per key: each is compared with the rows of the table."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = s.table("lineitem").select(*keys, *_LINE)
    row = F.struct(*keys, *_LINE)
    kept = any_by_key(lines, keys).select(row.alias("_row"), F.lit(1).alias("_kept"))
    every = lines.select(row.alias("_row"), F.lit(0).alias("_kept"))
    found = (kept.unionByName(every).groupBy("_row").agg(F.sum("_kept").alias("_kept"), F.count_if(F.col("_kept") == 0).alias("_n"))
             .filter("_kept > 0"))
    return found.select("_row.l_orderkey", "_row.l_linenumber", (F.col("_n") > 0).alias("is_a_row"))


_TEXT_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())])


def _as_text(s: Star):
    # error events carry a time that is no time
    bad = F.col("event_type") == "error"
    return s.events.select(F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"),
                           F.when(bad, F.concat(F.lit("t"), F.col("event_id"))).otherwise(F.col("ts").cast("string")).alias("ts"),
                           F.col("value").cast("string").alias("value"))


@query("silver_conform", """
SELECT event_id, CAST(user_id AS INTEGER) AS user_id, CASE WHEN event_type <> 'error' THEN ts END AS ts, value FROM events""", star=False)
def silver_conform(s: Star):
    return conform(_as_text(s), _TEXT_EVENTS)


@query("silver_rejects", """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'ts' AS failed_column FROM events WHERE event_type = 'error'""", star=False)
def silver_rejects(s: Star):
    return cast_failures(_as_text(s), _TEXT_EVENTS).select("event_id", F.explode("failed_columns").alias("failed_column"))


@query("bronze_snapshot", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status, o_totalprice AS total, o_orderpriority AS priority,
       o_orderdate AS source_updated_at FROM orders""", star=False)
def bronze_snapshot(s: Star):
    source = s.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("updated_at"))
    return ingest_snapshot(source).drop("load_at")


@query("parse_waypoints", """
SELECT event_id, event_type AS "msgType", CAST(user_id AS VARCHAR) AS vehicle, event_type <> 'error' AS working,
       CAST(value AS FLOAT) AS speed, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x,
       date_trunc('second', ts) AS "timestamp", CAST(ts AS DATE) AS date
FROM events""", star=False)
def parse_waypoints(s: Star):
    """Events written as nested position messages and read back with the stream's
    parser."""
    point = F.struct(
        F.col("user_id").cast("string").alias("vehicle"), F.col("event_id").cast("string").alias("driver"),
        F.col("value").cast("float").alias("speed"), (F.col("event_type") != "error").alias("working"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("int").alias("datetime"),
        F.get_json_object("props", "$.k").cast("double").alias("x"))
    messages = s.events.select(F.to_json(F.struct(F.col("event_type").alias("msgType"), point.alias("msgBusWayPoint")))
                               .cast("binary").alias("value"))
    return parse_gps(messages, stamp=False).select(
        F.col("driver").cast("bigint").alias("event_id"), "msgType", "vehicle", "working", "speed", "x",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "date")


@query("parse_json_events", """
SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS sequence_number, event_type, ts AS created_at
FROM events""", star=False)
def parse_json_events(s: Star):
    """Events written as JSON messages and read back with the stream's parser."""
    payload = F.struct(
        F.col("event_id").alias("id"), F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("sequence_number"), "event_type",
        F.col("ts").cast("string").alias("created_at"))
    messages = s.events.select(F.to_json(payload).cast("binary").alias("value"), F.col("ts").alias("timestamp"))
    out = parse_click_events(messages, stamp=False)
    return out.select("id", "user_id", "sequence_number", "event_type",
                      F.col("created_at").try_cast("timestamp_ntz").alias("created_at"))


@query("quality_violations", """
SELECT 'quantity_range' AS rule, count(*) FILTER (WHERE NOT quantity BETWEEN 1 AND 45) AS violations FROM sales
UNION ALL SELECT 'gross_non_negative', count(*) FILTER (WHERE NOT gross >= 0) FROM sales
UNION ALL SELECT 'valid_status', count(*) FILTER (WHERE NOT status IN ('O', 'F')) FROM sales
UNION ALL SELECT 'shipped_after_order', count(*) FILTER (WHERE NOT shipped_at >= sold_at) FROM sales
UNION ALL SELECT 'returned_after_order', count(*) FILTER (WHERE NOT (NOT returned OR shipped_at >= sold_at)) FROM sales""")
def quality_violations(s: Star):
    c = F.col
    return check_rows(s.sales, {
        "quantity_range": c("quantity").between(1, 45), "gross_non_negative": c("gross") >= 0,
        "valid_status": c("status").isin("O", "F"), "shipped_after_order": c("shipped_at") >= c("sold_at"),
        "returned_after_order": ~c("returned") | (c("shipped_at") >= c("sold_at"))})


@query("orphans", """
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""", star=False)
def orphan_orders(s: Star):
    orders = s.table("orders").select("o_orderkey", "o_custkey")
    return orphans(orders, s.table("lineitem").select("l_orderkey"), "o_orderkey", "l_orderkey")


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""", star=False)
def duplicate_line_keys(s: Star):
    return duplicate_keys(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("upsert_merge", """
WITH t AS (SELECT order_id, status, order_total, channel FROM orders_v WHERE status <> 'F'),
u AS (SELECT order_id, CASE WHEN max(line_status) = 'O' THEN NULL ELSE max(line_status) END AS status,
             round(sum(gross), 2) AS order_total, 'new' AS channel FROM lines GROUP BY 1)
SELECT coalesce(t.order_id, u.order_id) AS order_id,
       CASE WHEN u.order_id IS NOT NULL THEN u.status ELSE t.status END AS status,
       round(CASE WHEN t.order_id IS NULL THEN u.order_total ELSE t.order_total END, 2) AS order_total,
       CASE WHEN t.order_id IS NULL THEN u.channel ELSE t.channel END AS channel
FROM t FULL JOIN u ON t.order_id = u.order_id""")
def upsert_merge(s: Star):
    """Known orders take the new status (also NULL), new orders are inserted."""
    target = s.orders.filter("status <> 'F'").select("order_id", "status", "order_total", "channel")
    top = F.max("line_status")
    updates = s.lines.groupBy("order_id").agg(
        F.when(top != "O", top).alias("status"), F.round(F.sum("gross"), 2).alias("order_total")
    ).withColumn("channel", F.lit("new"))
    return upsert(target, updates, ["order_id"], ["status"]).withColumn("order_total", F.round("order_total", 2))


@query("shift_dates", """
SELECT o_orderkey, o_orderdate + INTERVAL 3 YEAR AS order_date, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate + INTERVAL 3 YEAR END AS shipped_at
FROM orders""", star=False)
def shift_order_dates(s: Star):
    text = F.when(F.col("o_orderstatus") == "F", F.lit("not yet")).otherwise(F.col("o_orderdate").cast("string"))
    rows = s.table("orders").select("o_orderkey", F.col("o_orderdate").alias("order_date"), text.alias("shipped_at"))
    return shift_dates(rows, 3).withColumn("shipped_at", F.col("shipped_at").cast("timestamp_ntz"))


@query("trimmed_text", "SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, trim(c_mktsegment) AS c_mktsegment FROM customer",
       star=False)
def trimmed_text(s: Star):
    padded = s.table("customer").withColumns({"c_name": F.rpad("c_name", 30, " "),
                                              "c_mktsegment": F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))})
    return trimmed(padded)


_CELLS = """CAST(CAST(o_orderkey AS DECIMAL(38,4)) AS VARCHAR) || chr(31) || CAST(CAST(o_custkey AS DECIMAL(38,4)) AS VARCHAR) || chr(31)
  || trim(o_orderstatus) || chr(31) || CAST(CAST(round(o_totalprice, 4) AS DECIMAL(38,4)) AS VARCHAR) || chr(31)
  || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || chr(31) || trim(o_orderpriority)"""
_WORDS = ", ".join(f"CAST(('0x' || substr(d, {8 * i + 1}, 8)) AS BIGINT) AS w{i}" for i in range(4))
_TOTALS = ", ".join([f"CAST(sum(CAST(w{i} AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS hash_sum_{i}" for i in range(4)]
                    + [f"bit_xor(w{i}) AS hash_xor_{i}" for i in range(4)])


@query("table_fingerprint", f"""
WITH h AS (SELECT md5({_CELLS}) AS d FROM orders), w AS (SELECT {_WORDS} FROM h)
SELECT count(*) AS row_count, {_TOTALS} FROM w""", star=False)
def table_fingerprint(s: Star):
    """Over all columns of orders, in the order of the table."""
    return compare.fingerprint(s.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                        "o_orderdate", "o_orderpriority"))


_DIFF_SQL = """
WITH old AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
new AS (SELECT * REPLACE (CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders
        WHERE o_orderstatus <> 'O'),
every AS (SELECT *, 1 AS l, 0 AS r FROM old UNION ALL SELECT *, 0, 1 FROM new)
SELECT CAST(CAST(o_orderkey AS DECIMAL(38,4)) AS VARCHAR) AS o_orderkey, CAST(CAST(o_custkey AS DECIMAL(38,4)) AS VARCHAR) AS o_custkey,
  o_orderstatus, CAST(CAST(round(o_totalprice, 4) AS DECIMAL(38,4)) AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority, CAST(sum(l) AS BIGINT) AS left_copies, CAST(sum(r) AS BIGINT) AS right_copies
FROM every GROUP BY ALL HAVING sum(l) <> sum(r)"""


def _versions(s: Star):
    """Orders, and a version of them with changed prices."""
    orders = s.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    dearer = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.filter("o_orderstatus <> 'P'"), orders.filter("o_orderstatus <> 'O'").withColumn("o_totalprice", dearer)


@query("table_diff", _DIFF_SQL, star=False)
def table_difference(s: Star):
    """Two versions of orders, over all columns."""
    return compare.table_diff(*_versions(s))


@query("table_diff_tree", _DIFF_SQL, star=False)
def table_difference_by_tree(s: Star):
    """The same through hash trees: rows are compared in differing leaves alone."""
    return compare.tree_diff(*_versions(s), ["o_orderkey"])


@query("row_count", "SELECT count(*) AS row_count FROM sales WHERE channel = 'web'")
def row_count(s: Star):
    return compare.count_rows(s.sales.filter("channel = 'web'"))


def run_records(s: Star):
    """Run records made of events: user = query, the half of the month = run, every
    event type group = engine."""
    kind = F.col("event_type")
    return s.events.select(
        F.when(kind.isin("click", "view", "signup"), "spark").otherwise("trino").alias("engine"),
        F.concat(F.lit("query"), F.col("user_id")).alias("query_name"),
        F.when(F.dayofmonth("ts") <= 25, "measured").otherwise("warmup").alias("run_type"),
        F.dayofmonth("ts").alias("run_number"),
        F.when(kind == "error", "failed").otherwise("success").alias("status"),
        F.col("value").alias("query_time_seconds"), (F.length("props") * 1000).cast("bigint").alias("peak_memory_bytes"),
        F.lit(0).cast("bigint").alias("spill_bytes"), F.get_json_object("props", "$.k").cast("bigint").alias("cpu_time_millis"),
        F.when(F.col("value") < 3, "low").otherwise("high").alias("result_hash"), F.length("event_type").cast("bigint").alias("row_count"))


RUN_SQL = """WITH r AS (
  SELECT CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'spark' ELSE 'trino' END AS engine, 'query' || user_id AS query_name,
         CASE WHEN day(ts) <= 25 THEN 'measured' ELSE 'warmup' END AS run_type, CAST(day(ts) AS INTEGER) AS run_number,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, value AS query_time_seconds,
         CAST(length(props) * 1000 AS BIGINT) AS peak_memory_bytes, CAST(0 AS BIGINT) AS spill_bytes,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS cpu_time_millis,
         CASE WHEN value < 3 THEN 'low' ELSE 'high' END AS result_hash, CAST(length(event_type) AS BIGINT) AS row_count
  FROM events),
m AS (SELECT * FROM r WHERE run_type = 'measured')"""


@query("run_summary", RUN_SQL + """
SELECT engine, count(*) AS total_queries, count(*) FILTER (WHERE status = 'success') AS success_count,
  count(*) FILTER (WHERE status <> 'success') AS failure_count,
  round(count(*) FILTER (WHERE status = 'success') / count(*), 4) AS success_rate,
  round(sum(query_time_seconds), 3) AS total_runtime_seconds,
  round(quantile_cont(query_time_seconds, 0.5) FILTER (WHERE status = 'success'), 3) AS median_query_time_seconds,
  round(count(*) FILTER (WHERE status = 'success') / round(sum(query_time_seconds) FILTER (WHERE status = 'success'), 6), 6) AS avg_throughput_qps,
  max(peak_memory_bytes) FILTER (WHERE status = 'success') AS max_peak_memory_bytes,
  CAST(sum(spill_bytes) FILTER (WHERE status = 'success') AS BIGINT) AS total_spill_bytes,
  CAST(sum(cpu_time_millis) FILTER (WHERE status = 'success') AS BIGINT) AS total_cpu_time_millis
FROM m GROUP BY 1""", star=False)
def run_summary(s: Star):
    return runs.run_summary(run_records(s))


@query("run_validation", RUN_SQL + """,
p AS (
  SELECT query_name, run_number, max(result_hash) FILTER (WHERE engine = 'spark') AS hash_spark,
         max(result_hash) FILTER (WHERE engine = 'trino') AS hash_trino,
         max(row_count) FILTER (WHERE engine = 'spark') AS rows_spark, max(row_count) FILTER (WHERE engine = 'trino') AS rows_trino
  FROM m WHERE status = 'success' GROUP BY 1, 2)
SELECT *, hash_spark = hash_trino AS matches, rows_spark IS NOT DISTINCT FROM rows_trino AS same_rows
FROM p WHERE hash_spark IS NOT NULL AND hash_trino IS NOT NULL""", star=False)
def run_validation(s: Star):
    return runs.validation(run_records(s), "spark", "trino")


_RATIOS = RUN_SQL + """,
t AS (
  SELECT query_name,
    round(sum(query_time_seconds) FILTER (WHERE engine = 'spark'), 6) / nullif(count(*) FILTER (WHERE engine = 'spark'), 0) AS mean_spark,
    round(sum(query_time_seconds) FILTER (WHERE engine = 'trino'), 6) / nullif(count(*) FILTER (WHERE engine = 'trino'), 0) AS mean_trino
  FROM m WHERE status = 'success' GROUP BY 1),
q AS (SELECT *, mean_spark / nullif(mean_trino, 0) AS time_ratio FROM t)"""


@query("run_time_ratios", _RATIOS + """
SELECT query_name, round(mean_spark, 6) AS mean_spark, round(mean_trino, 6) AS mean_trino, round(time_ratio, 6) AS time_ratio FROM q""", star=False)
def run_time_ratios(s: Star):
    out = runs.time_ratios(run_records(s), "spark", "trino")
    return out.select("query_name", *[F.round(c, 6).alias(c) for c in ("mean_spark", "mean_trino", "time_ratio")])


@query("run_speed_tiers", _RATIOS + """
SELECT CASE WHEN time_ratio > 10 THEN '>10x' WHEN time_ratio > 2 THEN '2-10x' WHEN time_ratio >= 0.8 THEN '0.8-2x' ELSE '<0.8x' END AS tier,
       count(*) AS queries
FROM q WHERE time_ratio IS NOT NULL GROUP BY 1""", star=False)
def run_speed_tiers(s: Star):
    return runs.speed_tiers(runs.time_ratios(run_records(s), "spark", "trino"))


@query("task_metrics", """
SELECT max(event_id) AS peak_memory_bytes, CAST(sum(user_id + 1) AS BIGINT) AS spill_bytes, CAST(sum(floor(value * 1000 / 1000.0)) AS BIGINT) AS cpu_time_millis
FROM events WHERE event_type <> 'error'""", star=False)
def task_metrics(s: Star):
    """Task-end records shaped like event-log lines, made of events."""
    metrics = F.struct(F.col("event_id").alias("Peak Execution Memory"), F.col("user_id").alias("Memory Bytes Spilled"),
                       F.lit(1).cast("bigint").alias("Disk Bytes Spilled"),
                       F.round(F.col("value") * 1_000_000).cast("bigint").alias("Executor CPU Time"))
    tasks = s.events.filter("event_type <> 'error'").select(metrics.alias("Task Metrics"))
    return runs.task_metrics(tasks)
