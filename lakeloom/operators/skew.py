"""Joins and aggregations that stay balanced when one key holds a large share.

AQE splits hot join partitions by itself. These forms are for the cases it does
not cover: full outer joins, and hot keys whose matching side is large too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salt_of(df: DataFrame, salts: int, exclude: Sequence[str] = ()) -> Column:
    """Salt computed from the row itself: a recomputed task gives the same salt,
    so a lost executor cannot move rows between partitions."""
    cols = [c for c in df.columns if c not in exclude] or list(df.columns)
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def salted_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner",
                salts: int = 32, hot_keys: DataFrame | None = None) -> DataFrame:
    """Equi-join with the fact side spread over ``salts`` parts per key and the
    look-up side repeated as often. With ``hot_keys`` (a frame of the key
    columns) only those are spread and repeated."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the look-up side is repeated, so only joins that keep the fact side are exact")
    keys = list(keys)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot_keys is None:
        left = facts.withColumn("_salt", salt_of(facts, salts, keys))
        right = lookup.withColumn("_salt", F.explode(every))
    else:
        hot = hot_keys.select(*keys).distinct().withColumn("_hot", F.lit(True))
        one = F.array(F.lit(0))
        left = (facts.join(hot, keys, "left")
                .withColumn("_salt", F.when(F.col("_hot"), salt_of(facts, salts, keys)).otherwise(F.lit(0)))
                .drop("_hot"))
        right = (lookup.join(hot, keys, "left")
                 .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(one)))
                 .drop("_hot"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Keys with at least ``min_rows`` rows; at most rows/min_rows of them."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_rows).select(*keys))
