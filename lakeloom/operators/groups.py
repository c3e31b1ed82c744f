"""Rows next to aggregates of their group, without a window over the group.

A window would pull each group into one task. Here the group is aggregated with
map-side partials and the one-row-per-group result is joined back: AQE
broadcasts it when its measured size is small and otherwise splits the hot keys
of the row side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import avg_of, ratio, sum2


def with_group_aggs(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Append group aggregates to every row; a NULL key forms a group too."""
    keys = list(keys)
    total = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        *[a.alias(n) for n, a in aggs.items()])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(total, on, "inner").drop(*[f"_k{i}" for i in range(len(keys))])


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, name: str = "share_pct") -> DataFrame:
    """value * 100 / total of the group."""
    out = with_group_aggs(df, keys, _total=sum2(value))
    return out.withColumn(name, F.round(ratio(F.col(value) * 100, "_total"), 6)).drop("_total")


def deviating(df: DataFrame, keys: Sequence[str], value: str, limit: float = 0.1,
              avg_name: str = "avg_value") -> DataFrame:
    """Rows whose value is more than ``limit`` (a fraction) off the group's average."""
    out = with_group_aggs(df, keys, **{avg_name: avg_of(value)})
    off = ratio(F.abs(F.col(value) - F.col(avg_name)), avg_name)
    return out.filter((F.col(avg_name) > 0) & (off > limit))


def above_group_avg(df: DataFrame, keys: Sequence[str], value: str, factor: float,
                    avg_name: str = "avg_value") -> DataFrame:
    """Rows whose value exceeds ``factor`` times the group's average."""
    out = with_group_aggs(df, keys, **{avg_name: avg_of(value)})
    return out.filter(F.col(value) > F.lit(factor) * F.col(avg_name))
