"""Live state of vehicles and routes over streams, exact also for late messages.

`live_state` keeps typed state per vehicle with event-time timers (`transformWithState`).
`route_slots` and `active_routes_now` keep the set of active routes: a small table of
time slots that micro-batches add to and readers fold. `density_windows` counts vehicles
exactly by two chained aggregations. Event times must be TIMESTAMP (not _NTZ)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakeloom.streaming.gps import STATE_TTL_SECONDS, UNKNOWN, last_sessions, routes_of_last_session

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with several variables and timers needs this state store; a store that the
    user or the cluster has named is kept."""
    if spark.conf.get(_PROVIDER, "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKSDB)


class _Sessions(StatefulProcessor):
    """The sessions of one vehicle that a message can still belong to, oldest first.

    A session is a run of messages with no silence of ``ttl`` between them. The newest one
    is the vehicle's state. An older one is kept while a message that is not too late could
    still join it with a newer one, so late messages give what a batch gives."""

    def __init__(self, key: str, fields: list[T.StructField], tie: T.StructField | None, ttl: int):
        self.key, self.ttl = key, pd.Timedelta(seconds=ttl)
        self.fields, self.tie = [f.name for f in fields], tie.name if tie else None
        # names of columns are changed on their way here, their order is not
        self.columns = [key, "_ts", *dict.fromkeys([*self.fields, *([self.tie] if tie else [])])]
        told = [T.StructField(f"{f.name}__{n}", t) for f in fields
                for n, t in (("value", f.dataType), ("time", T.TimestampType()), ("tie", tie.dataType if tie else T.LongType()))]
        self.schema = T.StructType([T.StructField("first", T.TimestampType()), T.StructField("last", T.TimestampType()), *told])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("sessions", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sessions = [self._read(s) for s in self.held.get()]
        for pdf in rows:
            if len(pdf):
                sessions = self._joined(sessions + self._sessions_of(pdf))
        if not sessions:
            return
        open_since = pd.Timestamp(max(timerValues.getCurrentWatermarkInMs(), 0), unit="ms") - self.ttl
        kept = [s for s in sessions[:-1] if s["last"] > open_since] + sessions[-1:]
        self._keep(kept)
        yield self._shown(key, kept[-1], False)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sessions = [self._read(s) for s in self.held.get()]
        now = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        if sessions and sessions[-1]["last"] + self.ttl <= now:
            self.held.clear()
            yield self._shown(key, sessions[-1], True)

    def close(self) -> None:
        pass

    def _keep(self, sessions: list[dict]) -> None:
        self.held.put([tuple(self._written(s)) for s in sessions])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        end = sessions[-1]["last"] + self.ttl
        self.handle.registerTimer(-(-end.value // 1_000_000))   # not before, in milliseconds

    def _sessions_of(self, pdf: pd.DataFrame) -> list[dict]:
        order = ["_ts"] + ([self.tie] if self.tie else [])
        pdf = pdf.set_axis(self.columns, axis=1).sort_values(order, kind="stable", na_position="first").reset_index(drop=True)
        number = (pdf["_ts"].diff() >= self.ttl).cumsum()
        out = []
        for _, part in pdf.groupby(number):
            told = {}
            for f in self.fields:
                set_ = part[part[f].notna()]
                if len(set_):
                    last = set_.iloc[-1]
                    told[f] = (last["_ts"], last[self.tie] if self.tie else 0, last[f])
            out.append({"first": part["_ts"].iloc[0], "last": part["_ts"].iloc[-1], "told": told})
        return out

    def _joined(self, sessions: list[dict]) -> list[dict]:
        """Sessions with no silence between them made one. Of equal times the larger tie
        is the later one, without a tie the one that came later."""
        out: list[dict] = []
        for s in sorted(sessions, key=lambda s: s["first"]):
            if out and s["first"] - out[-1]["last"] < self.ttl:
                one = out[-1]
                one["last"] = max(one["last"], s["last"])
                for f, told in s["told"].items():
                    if f not in one["told"] or told[:2] >= one["told"][f][:2]:
                        one["told"][f] = told
            else:
                out.append({"first": s["first"], "last": s["last"], "told": dict(s["told"])})
        return out

    def _read(self, row: tuple) -> dict:
        told = {f: (pd.Timestamp(row[3 + 3 * i]), row[4 + 3 * i], row[2 + 3 * i])
                for i, f in enumerate(self.fields) if row[3 + 3 * i] is not None}
        return {"first": pd.Timestamp(row[0]), "last": pd.Timestamp(row[1]), "told": told}

    def _written(self, s: dict) -> Iterator:
        yield s["first"].to_pydatetime()
        yield s["last"].to_pydatetime()
        for f in self.fields:
            if f in s["told"]:
                when, tie, value = s["told"][f]
                yield from (_plain(value), when.to_pydatetime(), _plain(tie))
            else:
                yield from (None, None, None)

    def _shown(self, key: Any, s: dict, expired: bool) -> pd.DataFrame:
        data = {self.key: [key[0]], "last_seen": [s["last"]], "expired": [expired]}
        return pd.DataFrame(data | {f: pd.Series([_plain(s["told"][f][2]) if f in s["told"] else None], dtype=object) for f in self.fields})


def _plain(value: Any) -> Any:
    """A value of a pandas column as Python's own type."""
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def live_state(stream: DataFrame, key: str, ts: str, fields: Sequence[str], tie: str | None = None,
               delay: str = "10 minutes", ttl: int = STATE_TTL_SECONDS) -> DataFrame:
    """State per vehicle after each micro-batch (update mode): key, last_seen, expired and
    the fields, in their own types and to the microsecond.

    The state is that of `gps.latest_state` on all messages that came no later than
    ``delay``. A vehicle silent for ``ttl`` of event time is reported once more with
    ``expired`` true and its state is dropped. Messages without key or time are left out."""
    use_rocksdb(stream.sparkSession)
    types = {f.name: f for f in stream.schema.fields}
    columns = list(dict.fromkeys([*fields, *([tie] if tie else [])]))
    known = (stream.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != UNKNOWN) & F.col(ts).isNotNull())
             .select(F.col(key), F.col(ts).alias("_ts"), *columns).withWatermark("_ts", delay))
    out = T.StructType([types[key], T.StructField("last_seen", T.TimestampType()), T.StructField("expired", T.BooleanType()),
                        *[T.StructField(f, types[f].dataType) for f in fields]])
    processor = _Sessions(key, [types[f] for f in fields], types[tie] if tie else None, ttl)
    return known.groupBy(key).transformWithStateInPandas(processor, out, "update", "eventTime")


def route_slots(stream: DataFrame, ts: str, path: str, checkpoint: str, route: str = "route_no",
                ttl: int = STATE_TTL_SECONDS) -> StreamingQuery:
    """Drains messages to a table of (route, slot, first, last): the first and the last
    time of a route in each slot of ``ttl``. A batch adds one row per route and slot that
    it holds. Readers take the least and the largest per route and slot, so a batch that
    is written again after a failure changes nothing, and neither does a late message's
    place in the stream. Unmapped messages are the route NULL; they tell the time."""
    mapped = F.when(F.col(route) != UNKNOWN, F.col(route)).alias("route")
    slot = F.floor(F.unix_micros(F.col(ts)) / F.lit(ttl * 1_000_000)).alias("slot")

    def add(batch: DataFrame, number: int) -> None:
        (batch.filter(F.col(ts).isNotNull()).groupBy(mapped, slot).agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
         .withColumn("batch", F.lit(number)).write.mode("append").parquet(path))

    return (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def active_routes_now(slots: DataFrame, ttl: int = STATE_TTL_SECONDS, mode: str = "set", as_of: Column | None = None) -> DataFrame:
    """Routes in use, from the rows that `route_slots` has written: what
    `gps.active_routes` gives on all messages drained so far."""
    folded = slots.groupBy("route", "slot").agg(F.min("first").alias("_first"), F.max("last").alias("_last"))
    now = F.unix_micros(slots.agg(F.max("last")).scalar() if as_of is None else as_of) / F.lit(1_000_000.0)
    mapped = folded.filter(F.col("route").isNotNull()).select(F.col("route").alias("route_no"), F.col("slot").alias("_slot"), "_first", "_last")
    if mode == "route":
        last = mapped.groupBy("route_no").agg(F.max("_last").alias("last_seen"))
        return last.filter(now - F.unix_micros("last_seen") / F.lit(1_000_000.0) < ttl)
    if mode != "set":
        raise ValueError(f"unknown mode: {mode}")
    return routes_of_last_session(mapped, "route_no", now, ttl)


def density_windows(stream: DataFrame, ts: str, speed: str, minutes: int = 5, vehicle: str = "vehicle", route: str = "route_no",
                    delay: str = "10 minutes") -> DataFrame:
    """Vehicles and mean speed per route and window, each once its window is over (append
    mode), as `gps.route_density`. Messages are first reduced to one row per window, route
    and vehicle; counting those rows counts each vehicle once."""
    window = F.window(ts, f"{minutes} minutes")
    per_vehicle = (stream.withWatermark(ts, delay).groupBy(window.alias("window"), route, vehicle)
                   .agg(F.sum(speed).alias("_s"), F.count(speed).alias("_n")))
    return (per_vehicle.groupBy("window", route)
            .agg(F.count(vehicle).alias("vehicles"),
                 F.round(F.try_divide(F.round(F.sum("_s"), 2), F.sum("_n")), 6).alias("avg_speed"))
            .select(F.col("window.start").alias("window_start"), route, "vehicles", "avg_speed"))
