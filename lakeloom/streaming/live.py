"""Live tables over streams. Event times must be TIMESTAMP (not _NTZ)."""

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StreamingQuery

from lakeloom.streaming.gps import STATE_TTL_SECONDS, UNKNOWN


def latest_per_vehicle(stream: DataFrame, key: str, ts: str, fields: Sequence[str]) -> DataFrame:
    """Last set value of every field per vehicle, as a streaming aggregation
    (update or complete mode). State is one row per vehicle; partial aggregation
    reduces a busy vehicle's messages before the shuffle."""
    known = stream.filter(F.col(key).isNotNull() & (F.col(key) != UNKNOWN))
    return known.groupBy(key).agg(
        F.max(ts).alias("last_seen"),
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(ts))).alias(f) for f in fields])


def expiring_state(stream: DataFrame, key: str, ts: str, fields: Sequence[str], delay: str = "10 minutes",
                   ttl: int = STATE_TTL_SECONDS) -> DataFrame:
    """As `latest_per_vehicle`, but a vehicle silent for ``ttl`` of event time
    loses its state and is reported once with ``expired`` true.

    The state is that of the vehicle's last session: it keeps the session's start, and
    a message that is at least ``ttl`` older than it belongs to an ended session and is
    left out, as in the batch `gps.latest_state`. A late message less than ``ttl``
    before the start joins the session. Messages without a time are left out."""
    fields = list(fields)
    text = [F.col(f).cast("string").alias(f) for f in fields]
    known = (stream.filter(F.col(key).isNotNull() & (F.col(key) != UNKNOWN) & F.col(ts).isNotNull())
             .select(F.col(key).cast("string").alias(key), F.col(ts).alias("_ts"), *text)
             .withWatermark("_ts", delay))
    out = T.StructType([T.StructField(key, T.StringType()), T.StructField("last_seen", T.TimestampType()),
                        T.StructField("expired", T.BooleanType())] + [T.StructField(f, T.StringType()) for f in fields])
    state = T.StructType([T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType())] + [
        T.StructField(n, t) for f in fields for n, t in ((f, T.StringType()), (f + "_us", T.LongType()))])
    life = ttl * 1_000_000

    def row(name: str, last_us: int, expired: bool, values: Sequence) -> pd.DataFrame:
        data = {key: [name], "last_seen": [pd.Timestamp(last_us, unit="us")], "expired": [expired]}
        return pd.DataFrame(data | {f: [v] for f, v in zip(fields, values)})

    def last_session(pdf: pd.DataFrame) -> pd.DataFrame:
        """Rows of one batch since its last silence, in order of time."""
        us = pdf["_ts"].astype("datetime64[us]").astype("int64")
        pdf = pdf.assign(_us=us).sort_values("_us", kind="stable")
        silent = (pdf["_us"].diff() >= life).to_numpy()
        return pdf.iloc[int(silent.nonzero()[0][-1]) if silent.any() else 0:]

    def update(k: tuple[Any, ...], batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            _, last, *rest = held.get
            held.remove()
            yield row(k[0], last, True, rest[0::2])
            return
        first, last, *rest = held.get if held.exists else (None, None, *([None, None] * len(fields)))
        now = {f: (rest[2 * i], rest[2 * i + 1]) for i, f in enumerate(fields)}
        for pdf in batches:
            if last is not None:  # what the held session connects with may be on either side
                pdf = pd.concat([pdf, pd.DataFrame({"_ts": pd.to_datetime([first, last], unit="us")})])
            rows = last_session(pdf)
            start, end = int(rows["_us"].iloc[0]), int(rows["_us"].iloc[-1])
            if last is not None and start > last:
                now = {f: (None, None) for f in fields}  # silence since the held session
            first, last = start, end
            for f in fields:
                told = rows[rows[f].notna()]
                if len(told) and (now[f][1] is None or told["_us"].iloc[-1] >= now[f][1]):
                    now[f] = (str(told[f].iloc[-1]), int(told["_us"].iloc[-1]))
        held.update((first, last, *[x for f in fields for x in now[f]]))
        held.setTimeoutTimestamp(max(-(-(last + life) // 1000), held.getCurrentWatermarkMs() + 1))
        yield row(k[0], last, False, [now[f][0] for f in fields])

    return known.groupBy(key).applyInPandasWithState(update, out, state, "update", GroupStateTimeout.EventTimeTimeout)


def route_windows(stream: DataFrame, ts: str, route: str, vehicle: str, speed: str, minutes: int = 5,
                  delay: str = "10 minutes") -> DataFrame:
    """Messages, approximate number of vehicles and mean speed per route and window,
    final once the watermark has passed (append mode). `gps.route_density` counts the
    vehicles exactly."""
    return (stream.withWatermark(ts, delay).groupBy(F.window(ts, f"{minutes} minutes"), route)
            .agg(F.count(F.lit(1)).alias("messages"), F.approx_count_distinct(vehicle).alias("vehicles_approx"),
                 F.avg(speed).alias("avg_speed"))
            .select(F.col("window.start").alias("window_start"), route, "messages", "vehicles_approx", "avg_speed"))


def to_memory(df: DataFrame, name: str, mode: str, checkpoint: str) -> StreamingQuery:
    """Small results for inspection and tests."""
    return (df.writeStream.format("memory").queryName(name).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
