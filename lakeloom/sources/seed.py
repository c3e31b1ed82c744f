"""CSV seed files whose dates are moved forward by whole years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name parts that mark a date column.
DATE_NAME_PARTS = ("_at", "_date", "timestamp")


def date_columns(df: DataFrame, parts: tuple[str, ...] = DATE_NAME_PARTS) -> list[str]:
    return [c for c in df.columns if any(p in c for p in parts)]


def shift_dates(df: DataFrame, years: int, columns: list[str] | None = None) -> DataFrame:
    """Add ``years`` to every date column. Text that is no timestamp becomes
    NULL; 29 February goes to 28 February where the target year has none."""
    chosen = date_columns(df) if columns is None else columns
    out = {}
    for name in chosen:
        dtype = df.schema[name].dataType
        c = F.col(name)
        if isinstance(dtype, T.StringType):
            c = c.try_cast("timestamp")
        elif not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("timestamp")
        out[name] = c + F.make_ym_interval(F.lit(years), F.lit(0))
    return df.withColumns(out) if out else df


def read_seed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Seed CSV with a header. With a schema, dates are read as text first so a
    bad date nulls one cell instead of the row."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.csv(path)
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType, True)
        for f in schema.fields
    ])
    return reader.schema(as_text).csv(path)
