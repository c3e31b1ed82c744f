"""Insert new keys, overwrite listed fields of existing ones, in a frame or in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sources.frames import written_once

#: Folder level of stored targets: the bucket of a row's key.
BUCKET = "key_bucket"


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_fields: Sequence[str] | None = None) -> DataFrame:
    """Target after the upsert. ``updates`` must hold one row per key.

    On a known key only ``update_fields`` change (an update may set NULL); on a
    new key the whole row is inserted. An empty list keeps known rows as they are."""
    keys = list(keys)
    fields = [c for c in updates.columns if c not in keys] if update_fields is None else list(update_fields)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    u = updates.withColumn("_in_updates", F.lit(True)).alias("u")
    joined = t.join(u, keys, "full")
    known, incoming = F.col("t._in_target").isNotNull(), F.col("u._in_updates").isNotNull()

    def pick(name: str):
        old, new = F.col(f"t.{name}"), F.col(f"u.{name}") if name in updates.columns else F.lit(None)
        take_new = incoming & (~known | F.lit(name in fields))
        return F.when(take_new, new).otherwise(old).alias(name)

    return joined.select(*[F.col(c) if c in keys else pick(c) for c in target.columns])


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """Equal keys of equal types are in one bucket; NULL keys have buckets too."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def store(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` as a target of `merge_into`: Parquet under ``path``, one folder per
    bucket of the keys. Buckets of more than some files' worth are split by Spark."""
    rows = df.withColumn(BUCKET, _bucket(keys, buckets)).hint("rebalance", BUCKET)
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def merge_into(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], buckets: int,
               update_fields: Sequence[str] | None = None) -> list[int]:
    """`upsert` into a target that `store` wrote with the same keys and ``buckets``. Only
    the buckets that hold a key of ``updates`` are read and written again; they are given
    back. Files of other buckets stay as they are.

    New rows of these buckets are written aside first and then take their place, so a run
    that breaks off leaves old or new buckets, and doing it again gives the same target.
    ``updates`` must hold one row per key, as for `upsert`; key types must be equal."""
    target = spark.read.parquet(path)
    for k in keys:
        if target.schema[k].dataType != updates.schema[k].dataType:
            raise ValueError(f"key {k} is {target.schema[k].dataType} in the target and {updates.schema[k].dataType} in the updates")
    new = written_once(updates.withColumn(BUCKET, _bucket(keys, buckets)), "updates")
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    if not touched:
        return touched
    held = target.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = upsert(held, new.drop(BUCKET), keys, update_fields).withColumn(BUCKET, _bucket(keys, buckets))
    aside = written_once(merged, "merged")
    (aside.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))
    return touched
