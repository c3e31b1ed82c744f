"""Parsers, live state and smoothing; stream results equal batch results."""

import glob
import json
import math
import os
import tempfile
from datetime import datetime as dt
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom import schemas
from lakeloom.sources import streams
from lakeloom.streaming import gps, live
from lakeloom.streaming.kalman import kalman_smooth


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


T0 = dt(2024, 1, 1, 12)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def messages(spark, texts):
    return spark.createDataFrame([(t, at(i)) for i, t in enumerate(texts)], "value string, timestamp timestamp")


def test_click_events(spark):
    good = json.dumps({"id": 1, "user_id": None, "sequence_number": 2, "event_type": "home", "created_at": "2024-01-01 00:00:00", "x": 1})
    out = streams.parse_click_events(messages(spark, [good, "not json"]))
    assert out.columns == schemas.CLICK_PAYLOAD.fieldNames() + ["timestamp", "load_at"]
    a, b = out.orderBy("timestamp").collect()
    assert (a.id, a.user_id, a.sequence_number, a.created_at) == (1, None, 2, "2024-01-01 00:00:00")
    assert b.id is None and b.timestamp == at(1) and b.load_at is not None


def waypoint(vehicle="v1", when=1704110400, **kw):
    return json.dumps({"msgType": "T", "msgBusWayPoint": {"vehicle": vehicle, "datetime": when, "x": 1.5, "y": 2.5, **kw}})


def test_gps(spark):
    out = streams.parse_gps(messages(spark, [waypoint(speed=3.5, ignition=True), "{bad"]).select("value"))
    a, b = out.orderBy(F.asc_nulls_last("vehicle")).collect()
    assert (a.msgType, a.vehicle, a.timestamp, str(a.date), a.ignition) == ("T", "v1", T0, "2024-01-01", True)
    assert b.vehicle is None and b.timestamp is None


def test_flatten(spark):
    texts = [waypoint(), waypoint(when="soon"), waypoint(when="1704110400.9"), json.dumps({"msgBusWayPoint": {"vehicle": "v2", "x": {"a": 1}}}),
             json.dumps({"msgType": "P"}), waypoint(when=9e30)]
    rows = gps.flatten_gps(messages(spark, texts), F.lit("2024-01-01 13:00:00").cast("timestamp")).orderBy("timestamp").collect()
    assert [r.datetime for r in rows[:5]] == ["2024-01-01 12:00:00", "soon", "2024-01-01 12:00:00", None, None]
    assert float(rows[5].datetime) == 9e30  # no such time: the text stays
    assert rows[0].ingest_time == "2024-01-01 13:00:00" and rows[0].x == "1.5"
    assert rows[3].msgType == "Unknown" and json.loads(rows[3].x) == {"a": 1}
    assert rows[4].msgType == "P" and rows[4].vehicle is None


def test_routes(spark):
    raw = spark.createDataFrame([("v1", "1", "A", 1), ("v1", "2", "B", 2), ("v2", "3", None, 3), (None, "4", "C", 4)],
                                "vehicle string, route_id string, route_no string, n int")
    m = gps.route_map(raw, ["n"])
    assert {(r.vehicle, r.route_id, r.route_no) for r in m.collect()} == {("v1", "2", "B"), ("v2", "3", "")}
    df = spark.createDataFrame([("v1",), ("v2",), ("v9",), (None,)], "vehicle string")
    got = {r.vehicle: r.route_no for r in gps.enrich_routes(df, m).collect()}
    assert got == {"v1": "B", "v2": "", "v9": "Unknown", None: "Unknown"}


STATE = "vehicle string, ts timestamp, n int, speed double, driver string"


def state_rows():
    return [("a", at(0), 1, 1.0, "x"), ("a", at(60), 2, None, "y"), ("a", at(100), 3, 5.0, None),
            ("b", at(0), 4, 7.0, "old"), ("b", at(121), 5, None, "new"),  # silent for over two hours between
            ("c", at(-200), 6, 1.0, "gone"), ("Unknown", at(100), 7, 1.0, "u"), (None, at(100), 8, 1.0, "u"),
            ("d", at(110), 9, 1.0, "p"), ("d", at(110), 10, 2.0, None)]


def test_latest_state(spark):
    df = spark.createDataFrame(state_rows(), STATE)
    for parts in (1, 5):
        out = gps.latest_state(df.repartition(parts), "vehicle", "ts", ["speed", "driver"], tie="n")
        got = {r.vehicle: (r.last_seen, r.speed, r.driver) for r in out.collect()}
        assert got == {"a": (at(100), 5.0, "y"), "b": (at(121), None, "new"), "d": (at(110), 2.0, "p")}
    later = gps.latest_state(df, "vehicle", "ts", ["speed"], tie="n", as_of=F.lit(at(230)).cast("timestamp"))
    assert {r.vehicle for r in later.collect()} == {"b"}


def brute_state(rows, fields, ttl=7200):
    state = {}
    for r in sorted((r for r in rows if r[0] not in (None, "Unknown")), key=lambda r: (r[1], r[2])):
        old = state.get(r[0])
        if old is None or (r[1] - old["ts"]).total_seconds() >= ttl:
            old = {}
        new = dict(old, ts=r[1])
        new.update({f: v for f, v in zip(fields, r[3:]) if v is not None})
        state[r[0]] = new
    end = max(r[1] for r in rows)
    return {k: (s["ts"], *[s.get(f) for f in fields]) for k, s in state.items() if (end - s["ts"]).total_seconds() < ttl}


def test_latest_state_against_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(("hot" if i % 3 == 0 else f"v{rnd.integers(30)}"), T0 + timedelta(seconds=int(rnd.integers(0, 200_000))), i,
             float(i) if rnd.random() < 0.6 else None, f"d{i}" if rnd.random() < 0.5 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, STATE)
    got = {r.vehicle: (r.last_seen, r.speed, r.driver)
           for r in gps.latest_state(df, "vehicle", "ts", ["speed", "driver"], tie="n").collect()}
    assert got == brute_state(rows, ["speed", "driver"])


def test_active_routes(spark):
    rows = [("A", at(0)), ("B", at(100)), ("C", at(300)), ("D", at(310)), ("Unknown", at(200)), ("C", at(-400))]
    df = spark.createDataFrame(rows, "route_no string, ts timestamp")
    names = lambda d: {r.route_no for r in d.collect()}
    assert names(gps.active_routes(df, "ts")) == {"C", "D"}  # 200 minutes of silence empty the set
    chain = spark.createDataFrame([("A", at(0)), ("B", at(100)), ("C", at(200)), ("D", at(310))], df.schema)
    assert names(gps.active_routes(chain, "ts")) == {"A", "B", "C", "D"}  # every write renews the set
    assert names(gps.active_routes(chain, "ts", mode="route")) == {"C", "D"}
    assert names(gps.active_routes(chain, "ts", as_of=F.lit(at(430)).cast("timestamp"))) == set()
    with pytest.raises(ValueError):
        gps.active_routes(chain, "ts", mode="x")


@pytest.mark.parametrize("n", [1, 7, 500, 999, 1000, 5000])
def test_retain_latest(spark, n):
    df = spark.range(1000).select("id", (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.pmod(F.col("id") * 37, F.lit(211)))).alias("ts"))
    want = {r.id for r in df.orderBy(F.desc("ts"), F.desc("id")).limit(n).collect()}
    assert {r.id for r in gps.retain_latest(df, "ts", n, tie="id").collect()} == want


def test_retain_latest_keeps_rows_without_time_and_splits_one_stamp(spark):
    df = spark.createDataFrame([(1, at(0)), (2, None)], "id int, ts timestamp")
    assert {r.id for r in gps.retain_latest(df, "ts", 10, tie="id").collect()} == {1, 2}
    assert {r.id for r in gps.retain_latest(df, "ts", 1, tie="id").collect()} == {1}
    same = spark.range(5000).withColumn("ts", F.lit(at(0)).cast("timestamp"))
    assert sorted(r.id for r in gps.retain_latest(same, "ts", 1234, tie="id").collect()) == list(range(5000 - 1234, 5000))
    assert len({r.id for r in gps.retain_latest(same, "ts", 1234).collect()}) == 1234
    copies = same.select(F.lit(1).alias("id"), "ts")
    assert gps.retain_latest(copies, "ts", 77).count() == 77 and gps.retain_latest(df.limit(0), "ts", 5).count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([("r", "a", at(0), 2.0), ("r", "a", at(1), 4.0), ("r", "b", at(2), 3.0), ("r", "b", at(6), 50.0), ("q", "c", at(0), 9.0)],
                               "route_no string, vehicle string, ts timestamp, speed double")
    d = gps.route_density(df, "ts", "speed")
    assert {(r.window_start, r.route_no, r.vehicles, r.avg_speed) for r in d.collect()} == {
        (at(0), "r", 2, 3.0), (at(5), "r", 1, 50.0), (at(0), "q", 1, 9.0)}
    timeless = gps.route_density(df.withColumn("ts", F.when(F.col("vehicle") != "c", F.col("ts"))), "ts", "speed").collect()
    assert (None, "q", 1, 9.0) in {(r.window_start, r.route_no, r.vehicles, r.avg_speed) for r in timeless}
    assert [(r.route_no, r.congested_minutes) for r in gps.congestion_time(d, 5.0).collect()] == [("r", 5)]
    assert [(r.route_no, r.messages, r.vehicles) for r in gps.common_routes(df, 1).collect()] == [("r", 4, 2)]


def textbook(points, q=1e-3, r=1.0, v0=1.0):
    """Four-state matrix form of the same filter."""
    H = np.array([[1.0, 0, 0, 0], [0, 1.0, 0, 0]])
    out, s, P, last = [], None, None, None
    for t, x, y in points:
        z = np.array([x, y])
        if s is None:
            s, P = np.array([x, y, 0.0, 0.0]), np.diag([r, r, v0, v0])
        else:
            d = t - last
            A = np.array([[1, 0, d, 0], [0, 1, 0, d], [0, 0, 1, 0], [0, 0, 0, 1.0]])
            Q = q * np.array([[d**3 / 3, 0, d**2 / 2, 0], [0, d**3 / 3, 0, d**2 / 2], [d**2 / 2, 0, d, 0], [0, d**2 / 2, 0, d]])
            s, P = A @ s, A @ P @ A.T + Q
            if not np.isnan(z).any():
                K = P @ H.T @ np.linalg.inv(H @ P @ H.T + r * np.eye(2))
                s, P = s + K @ (z - H @ s), (np.eye(4) - K @ H) @ P
        last = t
        out.append(tuple(s))
    return out


def test_kalman_against_matrix_form(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for v in range(4):
        for i in range(300 if v == 0 else 60):
            rows.append((f"v{v}", T0 + timedelta(seconds=int(20 * i + rnd.integers(20))), len(rows), float(i + rnd.normal()),
                         float(2 * i + rnd.normal()) if rnd.random() < 0.95 or i == 0 else None))
    df = spark.createDataFrame(rows, "vehicle string, timestamp timestamp, n int, x double, y double").repartition(6, "n")
    every = [{(r.vehicle, r.n): (r.x_smooth, r.y_smooth, r.vx, r.vy) for r in kalman_smooth(df, tie="n", slice_seconds=s).collect()}
             for s in (60, 3600, 86400, 10**9)]
    got = every[0]
    assert len(got) == len(rows)
    for other in every[1:]:  # the cuts change nothing
        assert all(np.allclose(got[k], other[k], atol=1e-6) for k in got)
    tracks = {}
    for v, t, n, x, y in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        sec = (t - dt(1970, 1, 1)).total_seconds()
        tracks.setdefault(v, []).append((n, sec, x, math.nan if y is None else y))
    for v, pts in tracks.items():
        for (n, *_), want in zip(pts, textbook([p[1:] for p in pts])):
            assert np.allclose(got[v, n], want, atol=1e-6)


def json_folder(rows, per_file=3):
    path = folder()
    for i in range(0, len(rows), per_file):
        name = os.path.join(path, f"part_{i // per_file:04d}.json")
        with open(name, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows[i:i + per_file]))
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    return path


def test_replay_and_drain(spark):
    path = json_folder([{"value": waypoint(f"v{i}", 1704110400 + 86400 * (i % 2))} for i in range(9)])
    schema = schemas.flat("value STRING")
    out, check = folder(), folder()
    for _ in range(2):  # the second run finds nothing new
        q = streams.stream_to_files(streams.parse_gps(streams.replay_files(spark, path, schema)), out, check, available_now=True)
        q.awaitTermination()
    assert len(q.recentProgress) <= 1
    back = spark.read.parquet(out)
    assert back.count() == 9 and len(glob.glob(out + "/date=*")) == 2
    batch = streams.parse_gps(spark.read.schema(schema).json(path), stamp=False)
    assert {r.vehicle for r in back.collect()} == {r.vehicle for r in batch.collect()}
    later = streams.numbered_files(spark, path, schema, from_number=2)
    assert later.count() == 3 and {r.file_number for r in later.collect()} == {2}


def test_drain_to_table(spark):
    click = {"id": 1, "event_type": "home", "created_at": "2024-01-01"}
    path = json_folder([{"value": json.dumps(dict(click, id=i)), "timestamp": f"2024-01-01 00:0{i}:00"} for i in range(5)])
    src = streams.replay_files(spark, path, schemas.flat("value STRING, timestamp TIMESTAMP"), files_per_trigger=2)
    spark.sql("CREATE NAMESPACE IF NOT EXISTS bronze")
    streams.drain_to_table(streams.parse_click_events(src), "bronze.clicks", folder()).awaitTermination()
    assert sorted(r.id for r in spark.table("bronze.clicks").collect()) == list(range(5))


STREAM = schemas.flat("vehicle STRING, ts TIMESTAMP, n INT, speed DOUBLE, driver STRING")


def as_json(rows):
    return [{"vehicle": v, "ts": t.isoformat() if t else None, "n": n, "speed": s, "driver": d} for v, t, n, s, d in rows]


def test_stream_latest_equals_batch(spark):
    rows = [r for r in state_rows() if r[0] not in ("c",) and r[2] != 10]
    path = json_folder(as_json(sorted(rows, key=lambda r: r[1])))
    src = streams.replay_files(spark, path, STREAM)
    q = live.to_memory(live.latest_per_vehicle(src, "vehicle", "ts", ["speed", "driver"]), "latest_mem", "complete", folder())
    q.awaitTermination()
    got = {r.vehicle: (r.last_seen, r.speed, r.driver) for r in spark.table("latest_mem").collect()}
    assert got == {"a": (at(100), 5.0, "y"), "b": (at(121), 7.0, "new"), "d": (at(110), 1.0, "p")}


def test_stream_enrichment_and_windows(spark):
    routes = gps.route_map(spark.createDataFrame([("a", "1", "R")], "vehicle string, route_id string, route_no string"))
    path = json_folder(as_json([("a", at(0), 1, 1.0, None), ("b", at(1), 2, 2.0, None), ("a", at(2), 3, 3.0, None), ("a", at(60), 4, 9.0, None)]))
    src = gps.enrich_routes(streams.replay_files(spark, path, STREAM, files_per_trigger=1), routes)
    q = live.to_memory(live.route_windows(src, "ts", "route_no", "vehicle", "speed"), "win_mem", "append", folder())
    q.awaitTermination()
    got = {(r.window_start, r.route_no): (r.messages, r.vehicles_approx, r.avg_speed) for r in spark.table("win_mem").collect()}
    assert got[at(0), "R"] == (2, 1, 2.0) and got[at(0), "Unknown"] == (1, 1, 2.0)


def test_stream_state_expires(spark):
    rows = [("a", at(0), 1, 1.0, "x"), ("a", at(10), 2, None, "y"), ("z", at(300), 3, 1.0, "q"), ("z", at(301), 4, 1.0, None),
            ("z", at(302), 5, None, "w"), ("z", at(303), 6, 1.0, None)]
    path = json_folder(as_json(rows), per_file=2)
    src = streams.replay_files(spark, path, STREAM)
    q = live.to_memory(live.expiring_state(src, "vehicle", "ts", ["speed", "driver"]), "ttl_mem", "update", folder())
    q.awaitTermination()
    got = spark.table("ttl_mem").collect()
    assert [(r.speed, r.driver) for r in got if r.vehicle == "a" and not r.expired][-1] == ("1.0", "y")
    assert [r.vehicle for r in got if r.expired] == ["a"]
    assert [(r.speed, r.driver) for r in got if r.vehicle == "z"][-1] == ("1.0", "w")


def test_stream_state_equals_batch_with_late_messages(spark):
    """Out of order inside and across batches; one late message of an ended session."""
    rows = [("a", at(0), 1, 1.0, "x"), ("k", at(5), 2, 4.0, "first"), ("a", at(180), 3, 2.0, None), ("k", at(3), 4, 3.0, "older"),
            ("a", at(176), 5, 9.0, "in"), ("a", at(5), 6, 8.0, "late"), ("k", at(178), 7, None, None), ("a", at(182), 8, None, None)]
    path = json_folder(as_json(rows), per_file=2)
    src = streams.replay_files(spark, path, STREAM)
    q = live.to_memory(live.expiring_state(src, "vehicle", "ts", ["speed", "driver"], delay="5 hours"), "late_mem", "update", folder())
    q.awaitTermination()
    got = {}
    for r in spark.table("late_mem").collect():
        got[r.vehicle] = (r.last_seen, r.speed, r.driver)
    batch = gps.latest_state(spark.createDataFrame(rows, "vehicle string, ts timestamp, n int, speed double, driver string"),
                             "vehicle", "ts", ["speed", "driver"], tie="n")
    want = {r.vehicle: (r.last_seen, None if r.speed is None else str(r.speed), r.driver) for r in batch.collect()}
    assert want["a"] == (at(182), "2.0", "in") and {v: got[v] for v in want} == want
