"""Count, sum and squared deviations of parts of a table, merged without sums of squares.

A part is (n, s, m2): how many values, their sum, and the sum of their squared distances
from their own mean. Parts are merged by adding, to the parts' own distances, those of
their means from the merged mean, so large values with a small spread lose no digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.sources.frames import written_once


def parts(sides: dict[str, Column], value: str) -> list[Column]:
    """``{side}_n``, ``{side}_s``, ``{side}_m2`` of a value per condition, as aggregates."""
    out = []
    for name, cond in sides.items():
        v = F.when(cond, F.col(value)).cast("double")
        out += [F.count(v).alias(f"{name}_n"), F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{name}_s"),
                F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias(f"{name}_m2")]
    return out


def _mean(side: str) -> Column:
    return F.coalesce(F.try_divide(f"{side}_s", f"{side}_n"), F.lit(0.0))


def merged_beside(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """The parts of a group merged, beside each of its rows; a group must be few rows."""
    group = Window.partitionBy(*keys)
    own = df.withColumns({"_n": F.col(f"{side}_n"), "_mean": _mean(side), f"{side}_n": F.sum(f"{side}_n").over(group),
                          f"{side}_s": F.sum(f"{side}_s").over(group)})
    away = F.col("_mean") - _mean(side)
    return own.withColumn(f"{side}_m2", F.sum(F.col(f"{side}_m2") + F.col("_n") * away * away).over(group)).drop("_n", "_mean")


def weighted(df: DataFrame, keys: Sequence[str], weights: dict[str, Column]) -> DataFrame:
    """Parts merged per group, each counted as often as its weight says: one row per group
    with ``{side}_n``, ``{side}_mean`` and ``{side}_m2``. The parts are written once and read
    twice: for the means, and for the distances from them."""
    held = written_once(df.select(*keys, *[f"{side}_{m}" for side in weights for m in ("n", "s", "m2")],
                                  *[w.cast("double").alias(f"{side}_w") for side, w in weights.items()]), "parts")
    means = held.groupBy(*keys).agg(*[c for side in weights for c in (
        F.sum(F.col(f"{side}_n") * F.col(f"{side}_w").cast("bigint")).alias(f"{side}_total"),
        F.try_divide(F.sum(F.col(f"{side}_s") * F.col(f"{side}_w")), F.sum(F.col(f"{side}_n") * F.col(f"{side}_w"))).alias(f"{side}_mean"))])
    named = [f"_k{i}" for i in range(len(list(keys)))]
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named)]
    beside = held.join(means.withColumnsRenamed(dict(zip(keys, named))), on).drop(*named)

    def distances(side: str) -> Column:
        away = _mean(side) - F.col(f"{side}_mean")
        return F.sum(F.col(f"{side}_w") * (F.col(f"{side}_m2") + F.col(f"{side}_n") * away * away))

    return beside.groupBy(*keys).agg(*[c for side in weights for c in (
        F.max(f"{side}_total").alias(f"{side}_n"), F.max(f"{side}_mean").alias(f"{side}_mean"), distances(side).alias(f"{side}_m2"))])
