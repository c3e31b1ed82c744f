"""Layer tables: namespaces, explicit-schema creation, physical layout, sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layer namespaces.
LAYERS = ("bronze", "silver", "gold")


def initialize_namespaces(spark: SparkSession, names: Sequence[str] = LAYERS) -> list[str]:
    for name in names:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")
    return [r[0] for r in spark.sql("SHOW NAMESPACES").collect()]  # a handful of names


@dataclass(frozen=True)
class Transform:
    """Hidden partitioning by a function of a column, for catalogs that have it: years,
    months, days, hours, or bucket with a number of buckets."""

    kind: str
    column: str
    buckets: int = 0

    def __post_init__(self):
        if self.kind not in ("years", "months", "days", "hours", "bucket") or (self.kind == "bucket") != (self.buckets > 0):
            raise ValueError(f"no partition transform: {self}")

    @property
    def sql(self) -> str:
        return f"{self.kind}({f'{self.buckets}, ' if self.buckets else ''}`{self.column}`)"

    def expression(self) -> Column:
        make = getattr(F.partitioning, self.kind)
        return make(self.buckets, self.column) if self.buckets else make(self.column)


@dataclass(frozen=True)
class Layout:
    """How a table is laid out on storage.

    ``day_of`` derives a date partition column ``<day_of>_day`` from a timestamp
    (the built-in catalog has no hidden day partitioning), ``loaded_at`` another one
    before it, by which increments are found; ``partition_by`` are plain columns;
    ``sort_by`` orders rows inside each file; ``bloom`` columns get a Parquet Bloom
    filter for point look-ups.

    ``provider`` is the table format. ``transforms`` are hidden partitions of a v2 catalog;
    they stand in place of derived day columns, and such tables are written through the v2
    writer, which lets the catalog ask for its own distribution. ``properties`` go to the
    table as they are."""

    day_of: str | None = None
    loaded_at: str | None = None
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    provider: str = "parquet"
    transforms: tuple[Transform, ...] = ()
    properties: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        if self.transforms and (self.day_of or self.loaded_at):
            raise ValueError("transforms take the place of derived day columns")

    def hidden(self, provider: str, buckets: tuple[tuple[int, str], ...] = (), **properties: str) -> Layout:
        """This layout for a v2 catalog: days of the timestamps in place of derived columns,
        and buckets."""
        days = tuple(Transform("days", c) for c in self.days.values())
        return replace(self, day_of=None, loaded_at=None, provider=provider, properties=tuple(sorted(properties.items())),
                       transforms=days + tuple(Transform("bucket", c, n) for n, c in buckets))

    @property
    def day_column(self) -> str | None:
        return f"{self.day_of}_day" if self.day_of else None

    @property
    def days(self) -> dict[str, str]:
        """Derived date columns and the timestamps they come from."""
        return {f"{c}_day": c for c in (self.loaded_at, self.day_of) if c}

    @property
    def partitions(self) -> list[str]:
        return [*self.days, *self.partition_by]


# Storage layout of the layer tables.
BRONZE_LAYOUT = {
    "users": Layout(day_of="created_at", loaded_at="load_at"),
    "orders": Layout(day_of="created_at", loaded_at="load_at"),
    "order_items": Layout(day_of="created_at", loaded_at="load_at"),
    "products": Layout(loaded_at="load_at", partition_by=("category",)),
    "inventory_items": Layout(day_of="created_at", loaded_at="load_at"),
    "distribution_centers": Layout(loaded_at="load_at"),
    "events": Layout(day_of="created_at", loaded_at="load_at"),
}
SILVER_LAYOUT = {
    "users": Layout(day_of="created_at", bloom=("email",)),
    "orders": Layout(day_of="created_at"),
    "order_items": Layout(day_of="created_at", sort_by=("order_id", "product_id")),
    "products": Layout(partition_by=("category",)),
    "inventory_items": Layout(day_of="created_at"),
    "distribution_centers": Layout(),
    "events": Layout(day_of="created_at", sort_by=("user_id", "session_id", "event_type"),
                     bloom=("session_id",)),
}
GOLD_LAYOUT = {
    "sales_performance": Layout(day_of="order_date", sort_by=("order_date",)),
    "user_statistics": Layout(sort_by=("user_id",)),
    "user_engagement": Layout(sort_by=("user_id",)),
}


def create_statement(name: str, schema: T.StructType, layout: Layout = Layout(), path: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS of a StructType and a layout."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    columns += "".join(f", `{day}` date" for day in layout.days)
    pairs = lambda given: ", ".join(f"'{k}' '{v}'" for k, v in given)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {layout.provider}"
    if layout.bloom:
        sql += f" OPTIONS ({pairs((f'parquet.bloom.filter.enabled#{c}', 'true') for c in layout.bloom)})"
    if layout.partitions or layout.transforms:
        sql += " PARTITIONED BY (" + ", ".join([*[f"`{c}`" for c in layout.partitions], *[t.sql for t in layout.transforms]]) + ")"
    if path:
        sql += f" LOCATION '{path}'"
    if layout.properties:
        sql += f" TBLPROPERTIES ({pairs(layout.properties)})"
    return sql


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 layout: Layout = Layout(), path: str | None = None) -> None:
    spark.sql(create_statement(name, schema, layout, path))


def _v2_writer(df: DataFrame, name: str, layout: Layout):
    writer = df.writeTo(name).using(layout.provider)
    for key, value in layout.properties:
        writer = writer.tableProperty(key, value)
    return writer.partitionedBy(*map(F.col, layout.partition_by), *[t.expression() for t in layout.transforms])


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """Bring rows of one partition value together before the write (few files),
    then order rows inside each file. REBALANCE lets AQE merge small values into
    one task and split a hot day or category over several."""
    df = df.withColumns({day: F.to_date(F.col(c)) for day, c in layout.days.items()}) if layout.days else df
    if layout.partitions:
        df = df.hint("rebalance", *layout.partitions)
    if layout.sort_by:
        df = df.sortWithinPartitions(*layout.partitions, *layout.sort_by)
    return df


def append_rows(df: DataFrame, name: str, layout: Layout = Layout()) -> None:
    """Append by column name to an existing table of the session or a v2 catalog."""
    if layout.transforms:
        return df.writeTo(name).append()
    writer = arrange(df, layout).write.mode("append")
    if layout.partitions:
        writer = writer.partitionBy(*layout.partitions)
    writer.saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, layout: Layout = Layout(),
                    path: str | None = None) -> None:
    if layout.transforms:
        if path:
            raise ValueError("a table with partition transforms lies where its catalog puts it")
        return _v2_writer(df, name, layout).createOrReplace()
    writer = arrange(df, layout).write.mode("overwrite").format(layout.provider)
    for c in layout.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if layout.partitions:
        writer = writer.partitionBy(*layout.partitions)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def external_table(spark: SparkSession, df: DataFrame, name: str, path: str) -> DataFrame:
    """Drop the catalog entry, write Parquet under ``path``, register and read back."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return spark.read.table(name)


def bucketed_table(df: DataFrame, name: str, buckets: int, *keys: str, path: str | None = None) -> None:
    """Bucket and sort by join keys, so that joins and aggregations on those keys
    between tables with equal buckets need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def trimmed(df: DataFrame) -> DataFrame:
    """Trim every text column (fixed-width sources pad with blanks)."""
    return df.select([
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType))
        else F.col(f.name)
        for f in df.schema.fields
    ])


def materialize_trimmed(df: DataFrame, name: str, layout: Layout = Layout()) -> None:
    overwrite_table(trimmed(df), name, layout)


def collect_statistics(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> None:
    """Row count, size and column statistics for the cost-based optimizer."""
    scope = "FOR ALL COLUMNS" if columns is None else "FOR COLUMNS " + ", ".join(columns)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {scope}")
