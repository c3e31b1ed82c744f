"""Drained streams against the batch functions, on late, equal and close times."""

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.sources import streams
from lakeloom.streaming import gps, live, stateful
from tests.test_streams import STREAM, T0, as_json, at, folder, json_folder

BATCH = "vehicle string, ts timestamp, n int, speed double, driver string"


def micro(minutes, us):
    return at(minutes) + timedelta(microseconds=us)


def drained(spark, rows, name, per_file, per_trigger=1, **more):
    src = streams.replay_files(spark, json_folder(as_json(rows), per_file), STREAM, files_per_trigger=per_trigger)
    out = stateful.live_state(src, "vehicle", "ts", ["speed", "driver"], tie="n", **more)
    live.to_memory(out, name, "update", folder()).awaitTermination()
    return out, spark.table(name).collect()


def last_rows(rows):
    """The state of each vehicle after the last batch; rows of the sink are in order."""
    got = {}
    for r in rows:
        if r.expired:
            got.pop(r.vehicle, None)
        else:
            got[r.vehicle] = (r.last_seen, r.speed, r.driver)
    return got


def batch_state(spark, rows):
    out = gps.latest_state(spark.createDataFrame(rows, BATCH), "vehicle", "ts", ["speed", "driver"], tie="n")
    return {r.vehicle: (r.last_seen, r.speed, r.driver) for r in out.collect()}


def test_microseconds_ties_and_bridges(spark):
    rows = [("a", micro(0, 900), 1, 1.0, "late"), ("a", micro(0, 100), 2, 2.0, "early"),    # sub-millisecond
            ("b", at(0), 3, 1.0, "x"), ("b", at(0), 5, None, "tie 5"), ("b", at(0), 4, 4.0, "tie 4"),
            ("c", at(0), 6, 6.0, "old"), ("c", at(170), 7, None, "new"), ("c", at(85), 8, None, None),   # joins two sessions
            ("d", at(-300), 9, 1.0, "ended"), ("d", at(170), 10, None, "now"), ("d", at(-250), 11, 3.0, None),
            (None, at(1), 12, 1.0, "n"), ("Unknown", at(1), 13, 1.0, "u"), ("e", None, 14, 1.0, "no time"),
            ("a", at(171), 15, None, None), ("b", at(119), 16, None, None)]
    frame, got = drained(spark, rows, "state_micro", 2, delay="20 hours")
    want = batch_state(spark, [r for r in rows if r[1] is not None])
    assert want["c"] == (at(170), 6.0, "new") and want["b"] == (at(119), 4.0, "tie 5")
    assert last_rows(got).items() >= want.items() and last_rows(got)["a"] == (at(171), None, None)
    assert dict(frame.dtypes) == {"vehicle": "string", "last_seen": "timestamp", "expired": "boolean", "speed": "double", "driver": "string"}
    first = [r for r in got if r.vehicle == "a"][0]
    assert (first.last_seen, first.speed, first.driver) == (micro(0, 900), 1.0, "late")


def test_random_order_equals_batch(spark):
    draw = np.random.default_rng(8)
    rows = [("hot" if i % 3 == 0 else f"v{draw.integers(6)}", T0 + timedelta(seconds=float(draw.integers(0, 90_000)), microseconds=int(draw.integers(1000))),
             i, float(i) if draw.random() < 0.5 else None, f"d{i}" if draw.random() < 0.4 else None) for i in range(400)]
    _, got = drained(spark, rows, "state_random", 100, delay="40 hours")
    want = batch_state(spark, rows)
    assert want and last_rows(got).items() >= want.items()


def test_silent_vehicles_expire_once(spark):
    rows = [("a", at(0), 1, 1.0, "x"), ("z", at(60), 2, 1.0, "q"), ("z", at(300), 3, 2.0, None), ("z", at(301), 4, None, None),
            ("a", at(302), 5, None, "back"), ("z", at(303), 6, None, None)]
    _, got = drained(spark, rows, "state_expired", 1)
    assert [(r.vehicle, r.last_seen, r.driver) for r in got if r.expired and r.vehicle == "a"] == [("a", at(0), "x")]
    assert last_rows(got) == {"a": (at(302), None, "back"), "z": (at(303), 2.0, None)}


@pytest.mark.parametrize("mode", ["set", "route"])
def test_active_routes_of_a_stream(spark, mode):
    rows = [("A", at(0)), ("B", at(100)), ("C", at(330)), ("D", micro(330, 5)), ("Unknown", at(400)), ("C", at(215)), (None, at(90)),
            ("A", at(390)), ("B", None), ("E", at(-900))]
    path = json_folder([{"route_no": r, "ts": t.isoformat() if t else None} for r, t in rows], per_file=2)
    src = streams.replay_files(spark, path, spark.createDataFrame([], "route_no string, ts timestamp").schema)
    table, check = folder() + "/slots", folder()
    stateful.route_slots(src, "ts", table, check).awaitTermination()
    slots = spark.read.parquet(table)
    got = {(r.route_no, r.last_seen) for r in stateful.active_routes_now(slots, mode=mode).collect()}
    frame = spark.createDataFrame(rows, "route_no string, ts timestamp")
    want = {(r.route_no, r.last_seen) for r in gps.active_routes(frame, "ts", mode=mode).collect()}
    assert want and got == want
    again = slots.unionByName(slots.where("batch = 1"))   # a batch written twice
    assert {(r.route_no, r.last_seen) for r in stateful.active_routes_now(again, mode=mode).collect()} == want
    later = F.lit(at(600)).cast("timestamp")
    assert stateful.active_routes_now(slots, mode=mode, as_of=later).collect() == []


def test_exact_vehicles_of_windows(spark):
    draw = np.random.default_rng(4)
    rows = [(f"v{draw.integers(9)}", T0 + timedelta(seconds=float(draw.integers(0, 5400))), i, float(draw.integers(90)) if i % 5 else None,
             ["R1", "R2"][i % 2]) for i in range(600)]
    rows.sort(key=lambda r: r[1])
    end = ("v0", at(300), 999, 1.0, "R9")
    path = json_folder(as_json([*rows, end, end]), per_file=151)
    src = streams.replay_files(spark, path, STREAM)
    out = stateful.density_windows(src, "ts", "speed", route="driver")
    live.to_memory(out, "density_mem", "append", folder()).awaitTermination()
    got = {(r.window_start, r.driver): (r.vehicles, r.avg_speed) for r in spark.table("density_mem").collect()}
    batch = gps.route_density(spark.createDataFrame(rows, BATCH), "ts", "speed", route="driver")
    assert got == {(r.window_start, r.driver): (r.vehicles, r.avg_speed) for r in batch.collect()}
