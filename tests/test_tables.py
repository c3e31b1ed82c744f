"""Storage layout, namespaces, seed files, statistics."""

import glob
import tempfile
from datetime import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeloom import schemas
from lakeloom.sources import seed, tables


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_create_append_prune(spark):
    tables.initialize_namespaces(spark)
    layout = tables.SILVER_LAYOUT["events"]
    schema = schemas.silver_schema("events")
    tables.ensure_table(spark, "silver.ev_layout", schema, layout, folder())
    tables.ensure_table(spark, "silver.ev_layout", schema, layout)  # no-op
    rows = [(i, i % 5, 1, f"s{i}", None, None, None, None, None, None, None, "home", dt(2024, 1, 1 + i % 3)) for i in range(30)]
    tables.append_rows(spark.createDataFrame(rows, schema), "silver.ev_layout", layout)
    t = spark.read.table("silver.ev_layout")
    assert t.count() == 30
    one_day = t.filter(F.col("created_at_day") == F.lit("2024-01-02").cast("date"))
    assert one_day.count() == 10
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_at_day" in plan


def test_bloom_filter_is_written(spark):
    path = folder()
    df = spark.range(2000).select(F.col("id"), F.concat(F.lit("s"), "id").alias("session_id"))
    tables.overwrite_table(df, "default.bloomed", tables.Layout(bloom=("session_id",)), path)
    f = pq.ParquetFile(glob.glob(path + "/*.parquet")[0])
    plain = folder()
    df.write.mode("overwrite").parquet(plain)
    size = lambda p: sum(len(open(x, "rb").read()) for x in glob.glob(p + "/*.parquet"))
    assert f.metadata.num_rows > 0 and size(path) > size(plain)


def test_hot_partition_is_split_and_small_ones_merged(spark):
    df = spark.range(400_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 30 ELSE 99 END AS category", "uuid() AS u")
    path = folder()
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        tables.overwrite_table(df, "default.hot_layout", tables.Layout(partition_by=("category",)), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len(glob.glob(f"{path}/category={d}/*.parquet")) for d in (0, 3, 99)}
    assert files[99] >= 3 and files[0] == files[3] == 1
    assert spark.table("default.hot_layout").count() == 400_000


def test_bucketed_join_has_no_shuffle(spark):
    a = spark.range(1000).selectExpr("id", "id * 2 AS v")
    tables.bucketed_table(a, "default.bucket_a", 4, "id", path=folder())
    tables.bucketed_table(a, "default.bucket_b", 4, "id", path=folder())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("default.bucket_a").join(spark.table("default.bucket_b"), "id")
        assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_external_table_round_trip(spark):
    people = spark.createDataFrame([("A", 30, "x"), ("B", 20, "y"), ("C", 41, "z")], "Name string, Age int, Role string")
    path = folder()
    for _ in range(2):
        back = tables.external_table(spark, people, "default.people", path)
    assert back.filter("Age > 25").count() == 2


def test_materialize_trimmed_and_statistics(spark):
    df = spark.createDataFrame([(" a ", 1), ("b  ", 2)], "s string, n int")
    tables.materialize_trimmed(df, "default.trimmed_t")
    assert {r.s for r in spark.table("default.trimmed_t").collect()} == {"a", "b"}
    tables.collect_statistics(spark, "default.trimmed_t")
    stats = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED default.trimmed_t").collect()}
    assert "2 rows" in stats["Statistics"]


def test_namespaces(spark):
    assert {"bronze", "silver", "gold"} <= set(tables.initialize_namespaces(spark))


def test_shift_dates(spark):
    df = spark.createDataFrame(
        [(1, "2020-02-29 10:00:00", dt(2020, 5, 1), "keep"), (2, "never", None, None)],
        schemas.flat("id INT, created_at STRING, order_date TIMESTAMP, note STRING"))
    a, b = seed.shift_dates(df, 3).orderBy("id").collect()
    assert a.created_at == dt(2023, 2, 28, 10) and a.order_date == dt(2023, 5, 1) and a.note == "keep"
    assert b.created_at is None and b.order_date is None
    assert seed.date_columns(df) == ["created_at", "order_date"]


def test_read_seed_keeps_rows_with_bad_dates(spark):
    path = folder() + "/x.csv"
    with open(path, "w") as f:
        f.write("id,name,latitude,longitude\n1,A,1.5,2.5\n")
    assert seed.read_seed(spark, path, schemas.SOURCE["distribution_centers"]).first().latitude == 1.5
    with open(path + "2", "w") as f:
        f.write("id,created_at\n1,2020-01-01\n2,bad\n")
    got = seed.shift_dates(seed.read_seed(spark, path + "2", schemas.flat("id BIGINT, created_at TIMESTAMP")), 1)
    assert [r.created_at for r in got.orderBy("id").collect()] == [dt(2021, 1, 1), None]


def test_hidden_partitions_of_a_v2_catalog(spark):
    plain = tables.SILVER_LAYOUT["events"]
    layout = plain.hidden("orc", ((16, "user_id"),), team="shop")
    assert layout.partitions == [] and layout.days == {} and layout.sort_by == plain.sort_by
    sql = tables.create_statement("lake.events", schemas.SOURCE["events"], layout)
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    parts = plan.partitioning()
    assert parts.mkString(" ") == "days(created_at) bucket(16, user_id)"
    spec = plan.tableSpec()
    assert spec.provider().get() == "orc" and "team -> shop" in spec.properties().toString()
    rows = spark.createDataFrame([], schemas.SOURCE["events"])
    # the built-in catalog is no v2 catalog and says so
    with pytest.raises(Exception, match="REPLACE TABLE"):
        tables.overwrite_table(rows, "hidden_events", layout)
    with pytest.raises(ValueError):
        tables.overwrite_table(rows, "hidden_events", layout, "/tmp/x")
    with pytest.raises(ValueError):
        tables.Transform("bucket", "user_id")
    with pytest.raises(ValueError):
        tables.Layout(day_of="created_at", transforms=layout.transforms)


def test_provider_of_a_layout(spark):
    df = spark.createDataFrame([(1, "a")], "id int, part string")
    tables.overwrite_table(df, "orc_rows", tables.Layout(provider="orc", partition_by=("part",)))
    assert spark.table("orc_rows").collect() == [(1, "a")]
    found = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED orc_rows").collect()}
    assert found["Provider"] == "orc"
