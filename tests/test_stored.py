"""Targets that are kept in files: merges, the rolling log, numbered rows."""

import os
from datetime import timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators.compare import differing_leaves, fingerprint, hash_tree, key_leaf, table_diff, tree_diff
from lakeloom.operators.ranking import numbered
from lakeloom.operators.upsert import merge_into, store, upsert
from lakeloom.sources import frames, streams
from lakeloom.streaming import gps
from lakeloom.streaming.rolling import RollingLog
from tests.test_streams import STREAM, T0, as_json, at, folder, json_folder

TARGET = "id bigint, part string, name string, n int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("fields", [None, ["n"], []])
def test_merge_rewrites_touched_buckets_only(spark, fields):
    old = spark.createDataFrame([(i, "ab"[i % 2], f"old{i}", i) for i in range(200)] + [(None, "a", "no id", 1)], TARGET)
    path, keys = folder() + "/target", ["id", "part"]
    store(old, path, keys, 16)
    new = spark.createDataFrame([(3, "b", "new3", None), (500, "a", "added", 5), (4, "b", "other part", 6)], TARGET)
    before = files_of(path)
    touched = merge_into(spark, path, new, keys, 16, fields)
    after = files_of(path)
    assert 1 <= len(touched) <= 3
    for file, when in before.items():
        changed = int(file.split("key_bucket=")[1].split("/")[0]) in touched
        assert changed != (after.get(file) == when)
    got = rows_of(spark.read.parquet(path).select(old.columns))
    assert got == rows_of(upsert(old, new, keys, fields))
    assert merge_into(spark, path, new, keys, 16, fields) == touched    # again: the same target
    assert rows_of(spark.read.parquet(path).select(old.columns)) == got
    assert merge_into(spark, path, new.limit(0), keys, 16, fields) == []
    with pytest.raises(ValueError):
        merge_into(spark, path, new.withColumn("id", F.col("id").cast("string")), keys, 16)


@pytest.mark.parametrize("n", [1, 40, 333, 10_000])
def test_rolling_log_equals_batch(spark, n):
    draw = np.random.default_rng(n)
    rows = [(f"v{i % 7}", T0 + timedelta(seconds=float(draw.integers(0, 30_000)), microseconds=int(draw.integers(3))) if i % 50 else None,
             i, float(i), None) for i in range(600)]
    rows += [("same", at(400), 1000 + i, 0.0, None) for i in range(100)]
    order = draw.permutation(len(rows))
    src = streams.replay_files(spark, json_folder(as_json([rows[i] for i in order]), 175), STREAM)
    log = RollingLog(spark, folder() + "/log", STREAM, "ts", n, tie="n", bucket_seconds=1800)
    log.start(src, folder(), trim_every=2).awaitTermination()
    frame = spark.createDataFrame(rows, "vehicle string, ts timestamp, n int, speed double, driver string")
    want = rows_of(gps.retain_latest(frame, "ts", n, tie="n"))
    assert rows_of(log.read()) == want and len(want) == min(n, len(rows))
    log.trim()
    assert rows_of(log.read()) == want
    buckets = [d for d in os.listdir(f"{log.path}/rows") if d.startswith("bucket=")]
    cut = log.edge()
    assert cut is None or min(int(b[7:]) for b in buckets) == cut[0]


def test_a_batch_added_twice_is_there_once(spark):
    frame = spark.createDataFrame([("a", at(i), i, None, None) for i in range(20)], "vehicle string, ts timestamp, n int, speed double, driver string")
    log = RollingLog(spark, folder() + "/log", frame.schema, "ts", 12, tie="n", bucket_seconds=300)
    for _ in range(2):
        log.add(frame.where("n < 10"), 0)
        log.add(frame.where("n >= 10"), 1)
    assert sorted(r.n for r in log.read().collect()) == list(range(8, 20))
    assert log.trim() == sorted({int(at(i).timestamp() // 300) for i in range(8)} - {int(at(8).timestamp() // 300)})


def test_numbered_rows(spark):
    rows = [(("hot" if i % 3 else f"k{i:05d}"), i % 5 if i % 7 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = numbered(df, [F.asc_nulls_last("v"), F.desc("k")]).orderBy("row_number").collect()
    assert [r.row_number for r in got] == list(range(1, 2001))
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, [-ord(c) for c in r[0]] + [0]))
    assert [(r.k, r.v) for r in got] == want
    assert numbered(df.limit(0), [F.col("v")]).collect() == []


def test_frames_need_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        frames.shared_folder(Session())


def test_one_changed_row_reads_one_leaf(spark):
    old = spark.createDataFrame([(i, "ab"[i % 2], f"name{i}", i) for i in range(500)], TARGET)
    new = old.withColumn("n", F.when(F.col("id") == 77, -1).otherwise(F.col("n")))
    paths = [folder() + "/a", folder() + "/b"]
    for df, path in zip((old, new), paths):
        store(df, path, ["id"], 64)
    a, b = (spark.read.parquet(p) for p in paths)
    diff = tree_diff(a, b, ["id"], 64, 4, leaf="key_bucket")
    assert rows_of(diff) == rows_of(table_diff(old, new.select(old.columns))) and diff.count() == 2
    read = {f.split("key_bucket=")[1].split("/")[0] for f in diff.inputFiles()}
    bucket = a.where("id = 77").first()["key_bucket"]
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert f"key_bucket#" in plan and f"= {bucket})" in plan and str(bucket) in read
    trees = [hash_tree(df, key_leaf(df, ["id"], 64), 64, 4) for df in (old, new)]
    assert len(differing_leaves(*trees, 64, 4)) == 1 and differing_leaves(trees[0], trees[0], 64, 4) == []
    total = trees[0].where("level = 0").drop("level", "node").first()
    assert total.asDict() == fingerprint(old).first().asDict()


def test_tree_against_plain_difference(spark):
    left = spark.createDataFrame([(i % 40, "x", str(i % 9), i % 3) for i in range(300)] + [(None, None, None, None)] * 2, TARGET)
    right = spark.createDataFrame([(i % 41, "x", str(i % 9), i % 3) for i in range(290)] + [(None, None, None, None)], TARGET)
    for leaves, fan in ((1, 2), (10, 3), (4096, 16)):
        assert rows_of(tree_diff(left, right, ["id"], leaves, fan)) == rows_of(table_diff(left, right))
        assert tree_diff(left, left.repartition(3), ["id"], leaves, fan).count() == 0
        assert rows_of(tree_diff(left, left.limit(0), ["id"], leaves, fan)) == rows_of(table_diff(left, left.limit(0)))
