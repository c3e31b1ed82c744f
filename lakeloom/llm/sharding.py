"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size (an offset and a stride from two hashes of its name). The shards take turns;
at each turn a shard claims the first slot of its order that is still free. A key
is placed by one look-up at its hash. A shard that joins or leaves moves few other
keys, and the shares of the shards differ by one turn at most.

The table depends on the shard names alone (never on rows) and has ``slots`` rows,
at most `MAX_SLOTS`, so its broadcast has a fixed bound."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.tables import table

SLOTS = 65537
SHARDS = 256
MAX_SLOTS = 4_000_037


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_slots(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> list[int]:
    """Position in ``shards`` of the owner of each slot. A shard of weight w claims
    w slots at each of its turns."""
    if slots > MAX_SLOTS or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime of at least {len(shards)} and at most {MAX_SLOTS}")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and at least one")
    turns = list(weights or [1] * len(shards))
    at = [_number(f"offset:{s}") % slots for s in shards]
    stride = [_number(f"stride:{s}") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i, turn in enumerate(turns):
            for _ in range(min(turn, free)):
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + stride[i]) % slots
                owner[at[i]] = i
                free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, modulo the table size. A null
    key has the slot of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def slot_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS,
               weights: Sequence[int] | None = None) -> DataFrame:
    """One row per slot: ``_slot``, ``_shard``."""
    listed = ",".join(map(str, fill_slots(shards, slots, weights)))
    return (spark.range(1).select(F.posexplode(F.split(F.lit(listed), ",")).alias("_slot", "_shard"))
            .select("_slot", F.col("_shard").cast("int").alias("_shard")))


def place(df: DataFrame, key: str | Column, shards: Sequence[str], slots: int = SLOTS,
          weights: Sequence[int] | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (position in ``shards``) put before its
    columns; columns of ``df`` with these names are replaced.

    Equal keys, repeated rows included, share a shard; null keys are placed as the
    empty text; an empty frame gives an empty frame. No row is moved: to write the
    shards use `write_shards`."""
    column = df[key] if isinstance(key, str) else key
    rows = df.withColumn("_slot", slot_of(column, slots)).drop("slot", "shard")
    owned = F.broadcast(slot_table(df.sparkSession, shards, slots, weights))
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "_slot"]
    return rows.join(owned, "_slot").select(F.col("_slot").alias("slot"), F.col("_shard").alias("shard"), *kept)


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a placed frame as one folder per shard. REBALANCE splits a shard that
    holds most rows over several tasks and files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def shard_names(count: int = SHARDS) -> list[str]:
    return [f"shard-{i:04d}" for i in range(count)]


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id")
    return place(documents, "doc_id", shard_names()).select("doc_id", "slot", "shard")


def op1_sql(count: int = SHARDS, slots: int = SLOTS) -> str:
    """Check SQL: the preference orders and the claims by a plain loop that keeps the
    set of free slots of every order."""
    names = shard_names(count)
    orders = [[(_number(f"offset:{s}") + j * (_number(f"stride:{s}") % (slots - 1) + 1)) % slots for j in
               range(4 * slots // count)] for s in names]
    left, claimed = [iter(o) for o in orders], {}
    turn = 0
    while len(claimed) < slots:
        shard = turn % count
        offset, stride = orders[shard][0], (orders[shard][1] - orders[shard][0]) % slots
        slot = next((s for s in left[shard] if s not in claimed), None)
        if slot is None:  # beyond the listed start of the order
            slot = next(s for j in range(slots) if (s := (offset + j * stride) % slots) not in claimed)
        claimed[slot] = shard
        turn += 1
    listed = ",".join(str(claimed[s]) for s in range(slots))
    return f"""
WITH owner AS (SELECT unnest(range({slots})) AS slot, unnest(string_split('{listed}', ',')) AS shard),
keyed AS (SELECT doc_id,
       ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {slots} AS slot FROM documents)
SELECT k.doc_id, CAST(k.slot AS INTEGER) AS slot, CAST(o.shard AS INTEGER) AS shard
FROM keyed k JOIN owner o ON o.slot = k.slot"""
