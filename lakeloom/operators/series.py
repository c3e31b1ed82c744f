"""Running values and neighbours over pre-aggregated series.

Both take frames with one row per group and time step, so a window partition is
bounded by the number of steps (days, months), never by the number of facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running(df: DataFrame, partition: Sequence[str], step: str, value: str, name: str,
            how: str = "sum") -> DataFrame:
    """Running sum or max from the first step to the current one."""
    w = Window.partitionBy(*partition).orderBy(step).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    fn = {"sum": F.sum, "max": F.max}[how]
    return df.withColumn(name, fn(value).over(w))


def with_neighbours(df: DataFrame, partition: Sequence[str], steps: Sequence[str], value: str,
                    previous: str = "prev_value", following: str = "next_value") -> DataFrame:
    """Value of the previous and next step. As with the inner self-join on
    rank ± 1, rows without both neighbours and rows with a NULL group are left out."""
    w = Window.partitionBy(*partition).orderBy(*steps)
    out = df
    for p in partition:
        out = out.filter(F.col(p).isNotNull())
    out = out.withColumns({
        previous: F.lag(value).over(w), following: F.lead(value).over(w),
        "_has_prev": F.lag(F.lit(1)).over(w), "_has_next": F.lead(F.lit(1)).over(w)})
    return (out.filter(F.col("_has_prev").isNotNull() & F.col("_has_next").isNotNull())
            .drop("_has_prev", "_has_next"))


def against_offset(df: DataFrame, keys: Sequence[str], step: str, offset: int, values: Sequence[str],
                   suffix: str = "_later") -> DataFrame:
    """Each row next to the row of the same keys ``offset`` steps later, rows
    without one left out. Steps are whole numbers, unique per key. A RANGE frame
    of exactly ``offset`` reads the later row without a self-join."""
    w = Window.partitionBy(*keys).orderBy(step).rangeBetween(offset, offset)
    out = df.filter(F.col(step).isNotNull())
    for k in keys:
        out = out.filter(F.col(k).isNotNull())
    later = {v + suffix: F.first(v).over(w) for v in values}
    return out.withColumns({**later, "_n": F.count(F.lit(1)).over(w)}).filter("_n > 0").drop("_n")
