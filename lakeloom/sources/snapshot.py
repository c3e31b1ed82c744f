"""Full-table snapshots from a relational source into the bronze layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcSource:
    """A JDBC table, read by ``num_partitions`` range queries over ``partition_column``
    between its bounds. A read in one task has to be asked for (``one_task``), as it does
    not grow with the cluster."""

    url: str
    table: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    fetch_size: int = 10_000
    custom_schema: str | None = None
    one_task: bool = False

    def options(self) -> dict[str, str]:
        opts = {
            "url": self.url, "dbtable": self.table, "user": self.user,
            "password": self.password, "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }
        if self.custom_schema:
            opts["customSchema"] = self.custom_schema
        split = (self.partition_column, self.lower_bound, self.upper_bound, self.num_partitions)
        if not self.one_task:
            if any(v is None for v in split):
                raise ValueError("a split read needs partition_column, both bounds and num_partitions; one_task reads "
                                 "the table in one task")
            opts |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.num_partitions),
            }
        return opts

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options()).load()


def rename_source_timestamp(df: DataFrame, name: str = "updated_at",
                            to: str = "source_updated_at") -> DataFrame:
    """Keep the source's own change time under another name (no-op if absent)."""
    return df.withColumnRenamed(name, to)


def with_load_stamp(df: DataFrame, name: str = "load_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def ingest_snapshot(df: DataFrame) -> DataFrame:
    """Source snapshot -> bronze rows."""
    return with_load_stamp(rename_source_timestamp(df))
