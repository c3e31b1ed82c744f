"""Star tables over the given Parquet tables.

`sales` is one row per order line with its order's customer, date and channel;
`item`, `buyer` and `outlet` are the dimensions; `stock` is a monthly quantity
per item and outlet country. Every plan selects the columns it needs, so column
pruning and filters reach the Parquet scans."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import in_dates
from lakeloom.schemas import flat
from lakeloom.sources import tables

# Column types of the given tables. A scan with a stated schema opens no file
# while the plan is built.
_STAR_TYPES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
_STAR_SCHEMAS = {name: flat(columns) for name, columns in _STAR_TYPES.items()}


class Star:
    """The star tables over a folder of Parquet files or, with ``database``, over
    catalog tables of the same names (see `publish`)."""

    def __init__(self, spark: SparkSession, folder: str = "", database: str | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.database = database

    def table(self, name: str) -> DataFrame:
        if self.database:
            return self.spark.read.table(f"{self.database}.{name}")
        return self.spark.read.schema(_STAR_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        p = F.col("o_orderpriority")
        channel = (F.when(p.isin("1-URGENT", "2-HIGH"), "store")
                   .when(p.isin("3-MEDIUM", "4-NOT SPECIFIED"), "catalog")
                   .otherwise("web"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("buyer_id"),
            F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("order_total"),
            F.col("o_orderdate").alias("sold_at"), F.to_date("o_orderdate").alias("sold_on"),
            channel.alias("channel"))

    @cached_property
    def lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("outlet_id"),
            F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("gross"),
            F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
            (F.col("l_returnflag") == "R").alias("returned"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_shipdate").alias("shipped_at"), F.to_date("l_shipdate").alias("shipped_on"))

    @cached_property
    def sales(self) -> DataFrame:
        return self.lines.join(self.orders, "order_id")

    def sold_between(self, first: str, end: str) -> DataFrame:
        """Sales of orders placed in [first, end); the filter is on the raw
        timestamp and is pushed into the scan of orders."""
        return self.lines.join(self.orders.filter(in_dates("sold_at", first, end)), "order_id")

    @cached_property
    def item(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("item_class"),
            F.col("p_size").alias("item_size"), F.col("p_retailprice").alias("list_price"))

    @cached_property
    def places(self) -> Column:
        """Nation id -> (nation, region) as one map value. There are as many entries
        as nations, so the map is small whatever the data. Names looked up in it
        leave the size estimate of a dimension at its own file size; a join with
        the two tiny tables would multiply the estimates and make Catalyst shuffle
        the facts for a dimension that fits a broadcast."""
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        entry = F.struct("n_nationkey", F.struct("n_name", "r_name"))
        return (self.table("nation").join(region, "n_regionkey")
                .agg(F.map_from_entries(F.collect_list(entry)))).scalar()

    def _named(self, df: DataFrame, prefix: str) -> DataFrame:
        place = F.try_element_at(self.places, F.col("nation_id"))
        return df.withColumns({f"{prefix}_nation": place["n_name"], f"{prefix}_region": place["r_name"]}).drop("nation_id")

    @cached_property
    def buyer(self) -> DataFrame:
        return self._named(self.table("customer").select(
            F.col("c_custkey").alias("buyer_id"), F.col("c_name").alias("buyer_name"),
            F.col("c_nationkey").alias("nation_id"), F.col("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment")), "buyer")

    @cached_property
    def outlet(self) -> DataFrame:
        return self._named(self.table("supplier").select(
            F.col("s_suppkey").alias("outlet_id"), F.col("s_name").alias("outlet_name"),
            F.col("s_nationkey").alias("nation_id"), F.col("s_acctbal").alias("outlet_balance")), "outlet")

    @cached_property
    def stock(self) -> DataFrame:
        """Monthly quantity per item and outlet nation (by ship month)."""
        out = self.outlet.select("outlet_id", "outlet_nation")
        return (self.lines.join(out, "outlet_id")
                .groupBy("item_id", "outlet_nation", F.trunc("shipped_on", "month").alias("stock_month"))
                .agg(F.sum("quantity").alias("on_hand")))

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")


def publish(source: Star, database: str, buckets: int) -> Star:
    """Write the tables to a database with orders and lines bucketed and sorted by
    order, so that their join, the largest one of nearly every plan, and per-order
    aggregates read co-located buckets and shuffle nothing. Dimensions are written
    as they are. ``buckets`` should give files of some hundred megabytes."""
    tables.initialize_namespaces(source.spark, [database])
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    for name in _STAR_SCHEMAS:
        if name in keys:
            tables.bucketed_table(source.table(name), f"{database}.{name}", buckets, keys[name])
        else:
            tables.overwrite_table(source.table(name), f"{database}.{name}")
        tables.collect_statistics(source.spark, f"{database}.{name}")
    return Star(source.spark, database=database)


# The same tables for the SQL check.
STAR_SQL = """WITH orders_v AS (
  SELECT o_orderkey AS order_id, o_custkey AS buyer_id, o_orderstatus AS status,
         o_totalprice AS order_total, o_orderdate AS sold_at, CAST(o_orderdate AS DATE) AS sold_on,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'store'
              WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'catalog'
              ELSE 'web' END AS channel
  FROM orders),
lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS item_id, l_suppkey AS outlet_id,
         l_quantity AS quantity, l_extendedprice AS gross, l_discount AS discount, l_tax AS tax,
         l_returnflag = 'R' AS returned, l_linestatus AS line_status,
         l_shipdate AS shipped_at, CAST(l_shipdate AS DATE) AS shipped_on
  FROM lineitem),
sales AS (SELECT * FROM lines JOIN orders_v USING (order_id)),
item AS (
  SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS brand, p_type AS item_class,
         p_size AS item_size, p_retailprice AS list_price
  FROM part),
buyer AS (
  SELECT c_custkey AS buyer_id, c_name AS buyer_name, c_acctbal AS balance, c_mktsegment AS segment,
         n_name AS buyer_nation, r_name AS buyer_region
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
outlet AS (
  SELECT s_suppkey AS outlet_id, s_name AS outlet_name, s_acctbal AS outlet_balance,
         n_name AS outlet_nation, r_name AS outlet_region
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
stock AS (
  SELECT item_id, outlet_nation, CAST(date_trunc('month', shipped_on) AS DATE) AS stock_month,
         sum(quantity) AS on_hand
  FROM lines JOIN outlet USING (outlet_id) GROUP BY ALL)"""
