"""Operators against brute force, also with a key that holds a third of the rows."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.operators import compare, groups, membership, quality, ranking, runs, series, skew
from lakeloom.operators.upsert import upsert
from lakeloom import schemas


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """20000 rows; key 0 holds a third, value 7.0 holds a third of those."""
    rnd = random.Random(5)
    data = []
    for i in range(20000):
        k = 0 if i % 3 == 0 else rnd.randrange(1, 40)
        v = 7.0 if rnd.random() < 0.33 else (None if rnd.random() < 0.01 else float(rnd.randrange(2000)))
        data.append((k if k != 39 else None, v, i))
    return spark.createDataFrame(data, "k int, v double, id int").repartition(8, "id").cache()


@pytest.mark.parametrize("ascending", [True, False])
def test_rank_equals_window_rank(hot, ascending):
    order = F.asc_nulls_last("v") if ascending else F.desc_nulls_last("v")
    want = hot.withColumn("rnk", F.rank().over(Window.partitionBy("k").orderBy(order)).cast("bigint"))
    assert rows(ranking.ranked(hot, ["k"], "v", ascending)) == rows(want)
    everywhere = hot.withColumn("rnk", F.rank().over(Window.orderBy(order)).cast("bigint"))
    assert rows(ranking.ranked(hot, [], "v", ascending)) == rows(everywhere)


@pytest.mark.parametrize("part", [["k"], []])
def test_top_ranked_keeps_all_ties(hot, part):
    w = Window.partitionBy(*part).orderBy(F.desc_nulls_last("v"))
    want = hot.withColumn("rnk", F.rank().over(w).cast("bigint")).filter("rnk <= 10")
    assert rows(ranking.top_ranked(hot, part, "v", 10)) == rows(want)


def test_median(hot):
    got = {r.k: r.median for r in ranking.group_median(hot, ["k"], "v").collect()}
    data = {}
    for r in hot.collect():
        if r.v is not None:
            data.setdefault(r.k, []).append(r.v)
    assert got == {k: statistics.median(v) for k, v in data.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40))
def test_rank_property(spark, data):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k int, v int, i int")
    want = df.withColumn("rnk", F.rank().over(Window.partitionBy("k").orderBy(F.desc_nulls_last("v"))).cast("bigint"))
    assert rows(ranking.ranked(df, ["k"], "v")) == rows(want)


def test_group_aggs_equal_window(hot):
    w = Window.partitionBy("k")
    want = hot.withColumn("s", F.round(F.sum("v").over(w), 2)).withColumn("n", F.count("v").over(w))
    got = groups.with_group_aggs(hot, ["k"], s=F.round(F.sum("v"), 2), n=F.count("v"))
    assert rows(got) == rows(want)


def test_share_deviation_above(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("z", 0.0)], "k string, v double")
    share = {(r.k, r.v): r.share_pct for r in groups.share_of_group(df, ["k"], "v").collect()}
    assert share == {("a", 1.0): 25.0, ("a", 3.0): 75.0, ("b", 5.0): 100.0, ("z", 0.0): None}
    assert rows(groups.deviating(df, ["k"], "v").select("k", "v")) == [("a", 1.0), ("a", 3.0)]
    assert rows(groups.above_group_avg(df, ["k"], "v", 1.2).select("k", "v")) == [("a", 3.0)]


def test_membership_equals_set_operations(spark):
    f = lambda xs: spark.createDataFrame([(x,) for x in xs], "k int")
    a, b, c = f([1, 1, 2, 3, None]), f([1, 2, 2, None, 9]), f([2, None])
    both = {"a": a, "b": b, "c": c}
    assert rows(membership.in_all(both, ["k"])) == rows(a.intersect(b).intersect(c))
    assert rows(membership.in_first_only(both, ["k"])) == rows(a.subtract(b).subtract(c))
    flags = membership.membership({"a": a, "b": b}, ["k"])
    assert membership.overlap_counts(flags, "a", "b").first().asDict() == {"left_only": 1, "right_only": 1, "both": 3}


def test_series(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 5.0), ("a", 4, 2.0), ("b", 1, 9.0), (None, 1, 1.0), (None, 2, 1.0)],
                               "k string, t int, v double")
    assert rows(series.running(df, ["k"], "t", "v", "s").filter("k = 'a'").select("t", "s")) == [(1, 1.0), (2, 6.0), (4, 8.0)]
    assert rows(series.running(df, ["k"], "t", "v", "s", "max").filter("k = 'a'").select("t", "s")) == [(1, 1.0), (2, 5.0), (4, 5.0)]
    near = series.with_neighbours(df, ["k"], ["t"], "v").select("k", "t", "prev_value", "next_value")
    assert rows(near) == [("a", 2, 1.0, 2.0)]
    assert rows(series.against_offset(df, ["k"], "t", 2, ["v"]).select("k", "t", "v_later")) == [("a", 2, 2.0)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, hot, how):
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 2)], "k int, name string")
    want = rows(hot.join(lookup, "k", how))
    assert rows(skew.salted_join(hot, lookup, ["k"], how, salts=8)) == want
    keys = skew.hot_keys(hot, ["k"], 5000)
    assert rows(keys) == [(0,)]
    assert rows(skew.salted_join(hot, lookup, ["k"], how, salts=8, hot_keys=keys)) == want
    with pytest.raises(ValueError):
        skew.salted_join(hot, lookup, ["k"], "full")


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id int, name string, v double")
    updates = spark.createDataFrame([(2, None, 20.0), (4, "d", 40.0)], "id int, name string, v double")
    assert rows(upsert(target, updates, ["id"], ["name"])) == [(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (4, "d", 40.0)]
    assert rows(upsert(target, updates, ["id"])) == [(1, "a", 1.0), (2, None, 20.0), (3, "c", 3.0), (4, "d", 40.0)]
    assert rows(upsert(target, updates, ["id"], [])) == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, "d", 40.0)]


def test_quality_rules(spark):
    s = "order_id BIGINT, user_id BIGINT, status STRING, num_of_item INT, created_at TIMESTAMP, updated_at TIMESTAMP, " \
        "shipped_at TIMESTAMP, delivered_at TIMESTAMP, returned_at TIMESTAMP"
    t = lambda d: f"2024-01-{d:02d}"
    data = [(1, 1, "Shipped", 1, t(1), t(2), t(2), None, None), (2, 9, "Lost", 0, t(3), t(2), t(1), None, None),
            (3, None, None, None, t(1), None, None, None, t(5)), (4, 1, "Returned", 2, t(1), t(1), t(2), t(3), t(4))]
    text = s.replace("TIMESTAMP", "STRING")
    df = spark.createDataFrame(data, text)
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c.endswith("_at")})
    rules = quality.rules_for("orders")
    got = {r.rule: r.violations for r in quality.check_rows(df, rules).collect()}
    assert got == {"num_items_positive": 1, "valid_status": 1, "updated_after_created": 1, "shipped_after_created": 1,
                   "delivered_after_shipped": 0, "returned_after_delivered": 1}
    broken = {r.order_id: set(r.broken_rules) for r in quality.violating_rows(df, rules).collect()}
    assert set(broken) == {2, 3} and broken[3] == {"returned_after_delivered"}
    users = spark.createDataFrame([(1,)], "id BIGINT")
    assert rows(quality.orphans(df, users, "user_id", "id").select("order_id")) == [(2,)]
    assert rows(quality.duplicate_keys(df, ["user_id"])) == [(1, 2)]
    for name in schemas.SOURCE:
        quality.rules_for(name)


def test_normalize(spark):
    df = spark.createDataFrame([(1, 2.5, " x ", True), (None, float("nan"), "none", None), (3, -0.0, "2.50", False)],
                               "i int, d double, s string, b boolean")
    got = [tuple(r) for r in compare.normalize(df).collect()]
    assert got[0] == ("1.0000", "2.5000", "x", "true")
    assert got[1] == ("NULL", "NaN", "NULL", "NULL")
    assert got[2] == ("3.0000", "0.0000", "2.5000", "false")


def test_fingerprint_ignores_order_and_agrees_with_diff(spark):
    df = spark.range(500).selectExpr("id", "id % 7 AS k", "cast(id AS string) AS s")
    for algorithm in ("md5", "xxhash64"):
        a = compare.fingerprint(df, algorithm).first()
        assert a == compare.fingerprint(df.orderBy(F.desc("id")).repartition(5), algorithm).first()
        changed = df.withColumn("k", F.when(F.col("id") == 3, 99).otherwise(F.col("k")))
        assert a != compare.fingerprint(changed, algorithm).first()
    assert compare.table_diff(df, df.repartition(3)).count() == 0
    assert compare.table_diff(df, changed).count() == df.exceptAll(changed).count() + changed.exceptAll(df).count()
    twice = df.union(df.filter("id = 1"))
    assert [(r.left_copies, r.right_copies) for r in compare.table_diff(df, twice).collect()] == [(1, 2)]
    where = compare.grouped_fingerprint(df, ["k"]).exceptAll(compare.grouped_fingerprint(changed, ["k"]))
    assert {r.k for r in where.collect()} == {3}
    with pytest.raises(ValueError):
        compare.fingerprint(df, "crc")


def test_runs(spark):
    base = {f.name: None for f in schemas.RUN_RECORD.fields}

    def rec(engine, q, t, status="success", kind="measured", h="h", n=1, run=1, mem=10, spill=1, cpu=5):
        r = dict(base, engine=engine, query_name=q, run_type=kind, run_number=run, status=status, query_time_seconds=t,
                 peak_memory_bytes=mem, spill_bytes=spill, cpu_time_millis=cpu, result_hash=h, row_count=n)
        return tuple(r[f.name] for f in schemas.RUN_RECORD.fields)

    df = spark.createDataFrame([
        rec("s", "q1", 4.0, mem=50), rec("s", "q2", 2.0, h="x", n=3), rec("s", "q3", 9.0, "failed"), rec("s", "q1", 99.0, kind="warmup"),
        rec("t", "q1", 0.2), rec("t", "q2", 2.0, n=2), rec("t", "q3", 1.0)], schemas.RUN_RECORD)
    s = {r.engine: r for r in runs.run_summary(df).collect()}
    assert (s["s"].total_queries, s["s"].success_count, s["s"].failure_count, s["s"].success_rate) == (3, 2, 1, 0.6667)
    assert (s["s"].total_runtime_seconds, s["s"].median_query_time_seconds, s["s"].avg_throughput_qps) == (15.0, 3.0, 0.333333)
    assert (s["s"].max_peak_memory_bytes, s["s"].total_spill_bytes, s["s"].total_cpu_time_millis) == (50, 2, 10)
    pairs = runs.validation(df, "s", "t")
    assert {(r.query_name, r.matches, r.same_rows) for r in pairs.collect()} == {("q1", True, True), ("q2", False, False)}
    assert [r.query_name for r in runs.row_count_mismatches(pairs).collect()] == ["q2"]
    ratios = runs.time_ratios(df, "s", "t")
    assert {r.query_name: r.time_ratio for r in ratios.collect()} == {"q1": 20.0, "q2": 1.0, "q3": None}
    assert {r.tier: r.queries for r in runs.speed_tiers(ratios).collect()} == {">10x": 1, "0.8-2x": 1}
    none = runs.run_summary(df.filter("status = 'failed'")).first()
    assert (none.median_query_time_seconds, none.avg_throughput_qps, none.max_peak_memory_bytes) == (0.0, 0.0, 0)


def test_run_medians_are_taken_from_counts(spark):
    df = spark.range(1001).selectExpr(
        "if(id % 2 = 0, 'a', null) AS engine", "'measured' AS run_type", "if(id = 0, 'failed', 'success') AS status",
        "id * 0.25D AS query_time_seconds", "1L AS peak_memory_bytes", "1L AS spill_bytes", "1L AS cpu_time_millis")
    out = runs.run_summary(df)
    assert {r.engine: r.median_query_time_seconds for r in out.collect()} == {"a": 125.25, None: 125.0}
    assert "median(" not in out._jdf.queryExecution().analyzed().toString().lower()


def test_event_log(spark, tmp_path):
    (tmp_path / "log").write_text("\n".join([
        '{"Event":"SparkListenerJobStart","Job ID":0}',
        '{"Event":"SparkListenerTaskEnd","Stage ID":0,"Task Metrics":{"Peak Execution Memory":7,"Memory Bytes Spilled":1,"Disk Bytes Spilled":2,"Executor CPU Time":1999999}}',
        '{"Event":"SparkListenerTaskEnd","Stage ID":1,"Task Metrics":{"Peak Execution Memory":5,"Executor CPU Time":3000000}}']))
    got = runs.task_metrics(runs.read_event_log(spark, str(tmp_path / "log"))).first().asDict()
    assert got == {"peak_memory_bytes": 7, "spill_bytes": 3, "cpu_time_millis": 4}


def test_moments_of_large_values_with_a_small_spread(spark):
    """Parts merged beside rows and over weighted groups, against the values written out."""
    from lakeloom.operators.moments import merged_beside, parts, weighted

    rows = [(k, part, 1e9 + ((i * 7) % 5) / 4, 1 + (k + part) % 3) for k in range(3) for part in range(4) for i in range(5 + part)]
    df = spark.createDataFrame(rows, "k int, part int, v double, w int").repartition(4, "v")
    small = df.groupBy("k", "part").agg(*parts({"a": F.lit(True), "b": F.col("v") > 1e9 + 0.3}, "v"), F.max("w").alias("w"))
    got = {r.k: r for r in weighted(small, ["k"], {"a": F.col("w"), "b": F.lit(1)}).collect()}
    for k in range(3):
        a = [v for x, _, v, w in rows if x == k for _ in range(w)]
        b = [v for x, _, v, _ in rows if x == k and v > 1e9 + 0.3]
        for side, values in (("a", a), ("b", b)):
            assert got[k][f"{side}_n"] == len(values)
            assert got[k][f"{side}_mean"] == pytest.approx(statistics.fmean(values), rel=1e-15)
            assert got[k][f"{side}_m2"] / (len(values) - 1) == pytest.approx(statistics.variance(values), rel=1e-6)
    beside = merged_beside(small, ["k"], "a").collect()
    assert len(beside) == 12
    for r in beside:
        values = [v for x, _, v, _ in rows if x == r.k]
        assert r.a_n == len(values) and r.a_m2 == pytest.approx(statistics.variance(values) * (len(values) - 1), rel=1e-6)
