"""Layer jobs: read tables of one layer, write those of the next.

Runs are repeatable. Bronze appends snapshots, by load day and day of the rows. Silver
keeps the newest row per key; order items, which may repeat inside a snapshot, keep
the rows of the newest snapshot that holds their id. Gold is rebuilt. A second snapshot
or a second run of any job leaves silver and gold with the same values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom import schemas
from lakeloom.operators import increments, quality
from lakeloom.operators.conform import conform, latest_by_key, with_audit
from lakeloom.plans import gold
from lakeloom.sources import tables
from lakeloom.sources.snapshot import ingest_snapshot


def to_bronze(source: DataFrame, name: str, target: str | None = None) -> None:
    """Append one snapshot of a source table."""
    target, layout = target or f"bronze.{name}", tables.BRONZE_LAYOUT[name]
    schema = schemas.bronze_schema(name)
    rows = ingest_snapshot(source).select([f.name for f in schema.fields])
    tables.ensure_table(source.sparkSession, target, schema, layout)
    tables.append_rows(rows, target, layout)


def silver_rows(bronze: DataFrame, name: str) -> DataFrame:
    """Typed rows, the newest per key. Of order items all rows of the newest snapshot
    with their id are kept, as they are not deduplicated in this layer."""
    order = [c for c in ("source_updated_at", "load_at", "timestamp") if c in bronze.columns]
    schema = schemas.silver_schema(name)
    if name != "order_items":
        rest = [f.name for f in schema.fields if f.name not in schemas.PRIMARY_KEY[name] + order]
        bronze = latest_by_key(bronze, schemas.PRIMARY_KEY[name], [F.desc_nulls_last(c) for c in order + rest])
    elif "load_at" in bronze.columns:
        newest = Window.partitionBy(*schemas.PRIMARY_KEY[name]).orderBy(F.desc_nulls_last("load_at"))
        bronze = bronze.withColumn("_snapshot", F.rank().over(newest)).filter("_snapshot = 1").drop("_snapshot")
    return conform(bronze, schema)


def to_silver(spark: SparkSession, name: str, source: str | None = None, target: str | None = None) -> None:
    rows = with_audit(silver_rows(spark.read.table(source or f"bronze.{name}"), name))
    tables.overwrite_table(rows, target or f"silver.{name}", tables.SILVER_LAYOUT[name])


def refresh_silver(spark: SparkSession, name: str, since, source: str | None = None, target: str | None = None,
                   changes: str | None = None) -> None:
    """Bring bronze rows loaded from ``since`` on into a day-partitioned silver table.

    Rewritten are the days of the new rows and the days in which their keys are now, so
    a row whose day has changed leaves its old day. The newest version of a key wins,
    also when it is already there; order items of an id are replaced by those of its
    newest snapshot. A rerun changes nothing.

    ``changes`` names a table for what came and went (signed rows, see
    `operators.increments`), one per refresh. It is written before silver is, and a rerun
    leaves it as the first attempt found it."""
    source, target = source or f"bronze.{name}", target or f"silver.{name}"
    layout, keys = tables.SILVER_LAYOUT[name], schemas.PRIMARY_KEY[name]
    if not layout.day_of:
        raise ValueError(f"{name} has no day partitions: use to_silver")
    day = layout.day_column
    rows = with_audit(silver_rows(loaded_since(spark.read.table(source), since), name))
    rows = rows.withColumn(day, F.to_date(layout.day_of))
    present = spark.read.table(target)
    new_keys = rows.select(*keys).distinct()
    days = rows.select(day).union(present.join(new_keys, keys, "left_semi").select(day)).distinct()
    held = present.join(days, present[day].eqNullSafe(days[day]), "left_semi").select(present.columns)
    if name == "order_items":
        merged = held.join(new_keys, keys, "left_anti").unionByName(rows.select(present.columns))
    else:
        both = (held.withColumn("_new", F.lit(0))
                .unionByName(rows.select(present.columns).withColumn("_new", F.lit(1))))
        order = [c for c in ("source_updated_at", "_new") if c in both.columns]
        merged = latest_by_key(both, keys, [F.desc_nulls_last(c) for c in order]).drop("_new")
    # a table cannot be overwritten while it is read: the new days go through staging
    # tables, which also lets an interrupted run be repeated
    staging = f"{target}_staging"
    merged.write.mode("overwrite").saveAsTable(staging)
    days.write.mode("overwrite").saveAsTable(f"{staging}_days")
    if changes and not spark.catalog.tableExists(changes):
        business = [f.name for f in schemas.silver_schema(name).fields]
        increments.changes(held.select(business), spark.read.table(staging).select(business)).write.saveAsTable(changes)
    own = spark.newSession()  # the mode below is set for this write alone
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    staged = own.read.table(staging)
    arranged = tables.arrange(staged.drop(day), layout)
    arranged.select(present.columns).write.insertInto(target, overwrite=True)
    left = own.read.table(f"{staging}_days").join(staged, day, "left_anti").filter(F.col(day).isNotNull())
    for emptied in left.collect():  # days that all rows have left, a part of the days touched
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({day} = DATE'{emptied[0]}')")
    for table in (staging, f"{staging}_days"):
        spark.sql(f"DROP TABLE {table}")


def silver_findings(read: Callable[[str], DataFrame], name: str) -> DataFrame:
    """What is wrong in a silver table: table_name, row_key, kind, detail, n.

    Kinds are ``rule`` (a row breaks the rule named in detail), ``orphan`` (the key named in
    detail has no parent) and ``duplicate`` (n rows share a key; none for order items, which
    may). ``read`` gives a silver table by its name. Keys are text; several columns of a key
    are joined by a slash. The table is read once per kind, no rows are collected."""
    df, keys = read(name), schemas.PRIMARY_KEY[name]
    key = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])

    def found(rows: DataFrame, kind: str, detail: Column, n: Column = F.lit(1)) -> DataFrame:
        return rows.select(F.lit(name).alias("table_name"), key.alias("row_key"), F.lit(kind).alias("kind"),
                           detail.alias("detail"), n.cast("bigint").alias("n"))

    kinds = []
    if rules := quality.rules_for(name):
        # in silver the source's own time has another name, ``updated_at`` is the audit stamp
        source = df.withColumn("updated_at", F.col("source_updated_at")) if "source_updated_at" in df.columns else df
        broken = quality.violating_rows(source, rules).withColumn("_rule", F.explode("broken_rules"))
        kinds.append(found(broken, "rule", F.col("_rule")))
    for column, parent, parent_key in quality.FOREIGN_KEYS.get(name, ()):
        kinds.append(found(quality.orphans(df, read(parent), column, parent_key), "orphan", F.lit(column)))
    if name != "order_items":
        kinds.append(found(quality.duplicate_keys(df, keys, "_copies"), "duplicate", F.lit(", ".join(keys)), F.col("_copies")))
    if not kinds:
        return found(df.limit(0), "rule", F.lit(""))
    out = kinds[0]
    for more in kinds[1:]:
        out = out.unionByName(more)
    return out


def check_silver(spark: SparkSession, name: str, silver: str = "silver", target: str | None = None) -> DataFrame:
    """Writes the findings of a silver table to ``quality.{name}`` and gives back their
    numbers per kind and detail. The table itself is left as it is: gold counts all rows."""
    target = target or f"quality.{name}"
    rows = silver_findings(lambda n: spark.read.table(f"{silver}.{n}"), name)
    tables.overwrite_table(with_audit(rows), target, tables.Layout(sort_by=("kind", "detail")))
    return spark.read.table(target).groupBy("kind", "detail").agg(F.count(F.lit(1)).alias("findings"))


def loaded_since(bronze: DataFrame, since) -> DataFrame:
    """Bronze rows loaded from ``since`` on; reads only the load days from it on where
    the table is partitioned by them."""
    loaded = "load_at" if "load_at" in bronze.columns else "timestamp"
    rows = bronze.filter(F.col(loaded) >= F.lit(since))
    day = f"{loaded}_day"
    return rows.filter(F.col(day) >= F.to_date(F.lit(since))) if day in bronze.columns else rows


def to_gold(spark: SparkSession, name: str, target: str | None = None, silver: str = "silver") -> None:
    t = lambda n: spark.read.table(f"{silver}.{n}")
    rows = {
        "sales_performance": lambda: gold.sales_performance(t("order_items"), t("orders"), t("products")),
        "user_statistics": lambda: gold.user_statistics(t("users"), t("orders"), t("order_items"), t("events")),
        "user_engagement": lambda: gold.user_engagement(t("events")),
    }[name]()
    tables.overwrite_table(with_audit(rows), target or f"gold.{name}", tables.GOLD_LAYOUT[name])
