"""Helpers shared by the operators: the shared folder, written intermediates,
folder reads and streams of grouped Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sources.frames import shared_folder

#: White space of all word definitions: space and the five controls from tab to
#: carriage return, as a Java class body.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the
    lineage, survives lost executors and is pruned by column on each read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hash_sample(df: DataFrame, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``key``: rows under a hash bound that
    lets through about as many come first, so no task or driver sorts the others."""
    place = F.pmod(F.xxhash64(*key), F.lit(1 << 31))
    bound = min(1.0, 1.5 * most / max(df.count(), 1))
    return df.where(place < int(bound * (1 << 31))).orderBy(place, *key).limit(most)


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` in order; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of equal ``keys`` from batches that come sorted by them, also across
    batch borders. One run must fit in memory."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        start, current = 0, tuple(c[0] for c in columns)
        for i in range(batch.num_rows + 1):
            key = tuple(c[i] for c in columns) if i < batch.num_rows else None
            if key == current:
                continue
            part = batch.slice(start, i - start)
            if held and held_key != current:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held.append(part)
            held_key = current
            if i < batch.num_rows:
                yield held_key, pa.Table.from_batches(held)
                held, held_key = [], None
                start, current = i, key
    if held:
        yield held_key, pa.Table.from_batches(held)
