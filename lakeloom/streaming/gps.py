"""Vehicle positions: flattening, route enrichment, live state, metrics.

Batch and stream share the functions. Time to live is counted in event time
against an explicit instant, so a rerun gives the same answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.operators.conform import latest_by_key
from lakeloom.operators.ranking import numbered
from lakeloom.schemas import GPS_PAYLOAD_TEXT
from lakeloom.sources.frames import written_once

# Default label, time format, state lifetime and log length.
UNKNOWN = "Unknown"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
STATE_TTL_SECONDS = 7200
LOG_LENGTH = 3_600_000


def format_epoch(text: Column) -> Column:
    """Epoch seconds held as text, as a readable time; other text stays as it is."""
    seconds = F.floor(F.abs(text.try_cast("double"))) * F.signum(text.try_cast("double"))
    usable = F.abs(seconds) < F.lit(2.0e11)
    shown = F.date_format(F.timestamp_seconds(F.when(usable, seconds.try_cast("bigint"))), TIME_FORMAT)
    return F.coalesce(shown, text)


def flatten_gps(df: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Message frame (value) -> one text column per field. A message without a
    type is "Unknown", one without a payload has NULL fields."""
    data = F.from_json(F.col("value").cast("string"), GPS_PAYLOAD_TEXT)
    flat = df.select(data.alias("d"), *[c for c in df.columns if c != "value"])
    fields = GPS_PAYLOAD_TEXT["msgBusWayPoint"].dataType.names
    stamp = F.date_format(ingest_time if ingest_time is not None else F.current_timestamp(), TIME_FORMAT)
    return flat.select(
        F.coalesce("d.msgType", F.lit(UNKNOWN)).alias("msgType"), stamp.alias("ingest_time"),
        *[(format_epoch(F.col("d.msgBusWayPoint.datetime")) if f == "datetime" else F.col(f"d.msgBusWayPoint.{f}")).alias(f)
          for f in fields],
        *[c for c in df.columns if c != "value"])


def route_map(routes: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per vehicle with empty instead of missing fields. With ``order``
    (oldest first) the last row of a vehicle wins."""
    named = routes.filter(F.col("vehicle").isNotNull() & (F.col("vehicle") != ""))
    if order:
        one = latest_by_key(named, ["vehicle"], list(order))
    else:
        one = named.dropDuplicates(["vehicle"])
    return one.select("vehicle", *[F.coalesce(c, F.lit("")).alias(c) for c in ("route_id", "route_no")])


def enrich_routes(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Add the vehicle's route; "Unknown" where it has none. ``routes`` holds one
    row per vehicle (see `route_map`). Works on streams as a stream-static join."""
    out = df.join(routes, "vehicle", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("route_id", "route_no")})


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


def last_sessions(slots: DataFrame, keys: list[str], ttl: int) -> DataFrame:
    """Slots since the last silence of at least ``ttl``. There is one row per key
    and ttl-long slot, so a window holds as many rows as there are slots."""
    w = Window.partitionBy(*keys).orderBy("_slot")
    silent = _seconds(F.col("_first")) - _seconds(F.lag("_last").over(w)) >= ttl
    numbered = slots.withColumn("_session", F.sum(F.when(silent, 1).otherwise(0)).over(w))
    last = F.max("_session").over(Window.partitionBy(*keys))
    return numbered.withColumn("_of_last", last).filter("_session = _of_last").drop("_session", "_of_last")


def _slot(ts: str, ttl: int) -> Column:
    return F.floor(_seconds(F.col(ts)) / ttl).alias("_slot")


def _as_of(df: DataFrame, ts: str, as_of: Column | None) -> Column:
    return df.agg(F.max(ts)).scalar() if as_of is None else as_of


def latest_state(df: DataFrame, key: str, ts: str, fields: Sequence[str], tie: str | None = None,
                 ttl: int = STATE_TTL_SECONDS, as_of: Column | None = None) -> DataFrame:
    """Live state per vehicle: for each field the last value that was set since
    the vehicle's last silence of ``ttl`` or more; vehicles silent for ``ttl`` at
    ``as_of`` (default: the newest event) have no state.

    Rows are first reduced to one per vehicle and slot with map-side partials, so
    a vehicle with a large share of all messages is not gathered."""
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])

    def last_set(f: str) -> Column:
        return F.max(F.when(F.col(f).isNotNull(), F.struct(*order, F.col(f).alias("_v"))))

    known = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != UNKNOWN))
    slots = known.groupBy(key, _slot(ts, ttl)).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), *[last_set(f).alias(f) for f in fields])
    live = last_sessions(slots, [key], ttl)
    state = live.groupBy(key).agg(F.max("_last").alias("last_seen"), *[F.max(f).alias(f) for f in fields])
    alive = _seconds(_as_of(df, ts, as_of)) - _seconds(F.col("last_seen")) < ttl
    return state.filter(alive).select(key, "last_seen", *[F.col(f)["_v"].alias(f) for f in fields])


def active_routes(df: DataFrame, ts: str, route: str = "route_no", ttl: int = STATE_TTL_SECONDS,
                  mode: str = "set", as_of: Column | None = None) -> DataFrame:
    """Routes in use. ``mode="set"``: every write renews the life of the whole
    set, so a route stays until no mapped vehicle has written for ``ttl``.
    ``mode="route"``: a route counts while its own last write is younger."""
    mapped = df.filter(F.col(route).isNotNull() & (F.col(route) != UNKNOWN))
    now = _seconds(_as_of(df, ts, as_of))
    if mode == "route":
        last = mapped.groupBy(route).agg(F.max(ts).alias("last_seen"))
        return last.filter(now - _seconds(F.col("last_seen")) < ttl)
    if mode != "set":
        raise ValueError(f"unknown mode: {mode}")
    per_route = mapped.groupBy(route, _slot(ts, ttl)).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    return routes_of_last_session(per_route, route, now, ttl)


def routes_of_last_session(per_route: DataFrame, route: str, now: Column, ttl: int) -> DataFrame:
    """Routes heard of since the last silence of all routes together, unless that was
    ``ttl`` ago at ``now``; from rows (route, _slot, _first, _last)."""
    slots = (per_route.groupBy("_slot").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
             .withColumn("_all", F.lit(1)))
    live = last_sessions(slots, ["_all"], ttl)
    bounds = live.agg(F.min("_first").alias("a"), F.max("_last").alias("b"))
    start, end = bounds.select("a").scalar(), bounds.select("b").scalar()
    return (per_route.filter((F.col("_last") >= start) & (now - _seconds(end) < ttl))
            .groupBy(route).agg(F.max("_last").alias("last_seen")))


def retain_latest(df: DataFrame, ts: str, n: int = LOG_LENGTH, tie: str | None = None) -> DataFrame:
    """The newest ``n`` rows, exactly; rows without a time are the oldest.

    Rows are counted per second, once. The hour, the second and at last the time of the
    cut follow from those counts and from the rows of that second, which are written. Rows
    newer than the cut are kept by a comparison that reaches the scan. Only rows that share
    the time of the cut are put in order, by ``tie`` and a hash of the row, in ranges
    (`ranking.numbered`), so a large batch with one time stamp is spread over tasks."""
    if n < 1:
        return df.limit(0)
    micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(_NO_TIME))
    timed = df.withColumn("_us", micros)
    counts = written_once(timed.groupBy(F.expr("_us div 1000000").alias("_second")).agg(F.count(F.lit(1)).alias("_n"))
                          .withColumn("_hour", F.expr("_second div 3600")), "seconds")
    hour = _crossing(counts.groupBy("_hour").agg(F.sum("_n").alias("_n")), "_hour", n)
    if hour is None:
        return df
    second = _crossing(counts.filter(F.col("_hour") == hour[0]), "_second", hour[1])
    edge = written_once(timed.filter(F.expr("_us div 1000000") == second[0]), "edge")
    cut, wanted, there = _crossing(edge.groupBy("_us").agg(F.count(F.lit(1)).alias("_n")), "_us", second[1])
    time = F.timestamp_micros(F.lit(cut)).cast(df.schema[ts].dataType)
    if wanted == there:
        return df if cut == _NO_TIME else df.filter(F.col(ts) >= time)
    newer = df.filter(F.col(ts).isNotNull() if cut == _NO_TIME else F.col(ts) > time)
    order = [F.desc_nulls_last(tie)] if tie else []
    some = numbered(edge.filter(F.col("_us") == cut).drop("_us"), order, "_number").filter(F.col("_number") <= wanted)
    return newer.unionByName(some.select(newer.columns))


_NO_TIME = -(2**63)


def _crossing(counts: DataFrame, level: str, left: int) -> tuple[int, int, int] | None:
    """The value of ``level`` at which the rows counted from the newest on reach ``left``,
    how many of its rows are still wanted and how many it has; None if there are fewer."""
    newer = Window.orderBy(F.desc(level)).rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.lit(left) - F.coalesce(F.sum("_n").over(newer), F.lit(0))
    found = (counts.withColumn("_wanted", wanted).filter((F.col("_wanted") > 0) & (F.col("_n") >= F.col("_wanted")))
             .select(level, "_wanted", "_n").first())
    return None if found is None else tuple(found)


def _window_start(ts: str, minutes: int) -> Column:
    """Start of the time window of each row; null for a row without a time, which
    ``window()`` would drop."""
    micros = minutes * 60_000_000
    start = F.timestamp_micros(F.unix_micros(F.col(ts).cast("timestamp")) - F.pmod(F.unix_micros(F.col(ts).cast("timestamp")),
                                                                                 F.lit(micros)))
    return F.when(F.col(ts).isNotNull(), start)


def route_density(df: DataFrame, ts: str, speed: str, minutes: int = 5, vehicle: str = "vehicle",
                  route: str = "route_no") -> DataFrame:
    """Vehicles and mean speed per route and time window. Rows without a time are in a
    window of their own, whose start is null."""
    start = _window_start(ts, minutes).cast(df.schema[ts].dataType)
    per_vehicle = (df.groupBy(start.alias("window_start"), route, vehicle)
                   .agg(F.sum(speed).alias("_s"), F.count(speed).alias("_n")))
    return per_vehicle.groupBy("window_start", route).agg(
        F.count(vehicle).alias("vehicles"),
        F.round(F.try_divide(F.round(F.sum("_s"), 2), F.sum("_n")), 6).alias("avg_speed"))


def congestion_time(density: DataFrame, below: float, minutes: int = 5, route: str = "route_no") -> DataFrame:
    """Minutes per route whose mean speed was under ``below``."""
    return (density.filter(F.col("avg_speed") < below).groupBy(route)
            .agg((F.count(F.lit(1)) * minutes).alias("congested_minutes")))


def common_routes(df: DataFrame, k: int, vehicle: str = "vehicle", route: str = "route_no") -> DataFrame:
    """The k routes with most messages, with their number of vehicles."""
    per_vehicle = df.groupBy(route, vehicle).agg(F.count(F.lit(1)).alias("_n"))
    return (per_vehicle.groupBy(route).agg(F.sum("_n").alias("messages"), F.count(vehicle).alias("vehicles"))
            .orderBy(F.desc("messages"), route).limit(k))
