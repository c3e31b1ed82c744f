"""Silver-layer cleansing: typed projection, deduplication, audit stamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``. A value that cannot be cast becomes NULL."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows holding a value that `conform` turns into NULL, with the column names."""
    failed = F.array_compact(F.array(*[
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
    ]))
    return df.withColumn("failed_columns", failed).filter(F.size("failed_columns") > 0)


def with_audit(df: DataFrame, name: str = "updated_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def any_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key."""
    return df.dropDuplicates(list(keys))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The newest row per key. ``order`` is newest first and should be total.

    Written as ``row_number() = 1``: Catalyst prunes each input task to one row
    per key before the shuffle, so a hot key sends one row per task, not all."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
