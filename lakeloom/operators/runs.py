"""Summaries of query-run records and of task metrics in event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import ratio
from lakeloom.operators.ranking import median_of_counts
from lakeloom.sources.frames import written_once


def _measured(df: DataFrame) -> DataFrame:
    return df.filter(F.col("run_type") == "measured")


def run_summary(df: DataFrame) -> DataFrame:
    """One row per engine over its measured runs. The median is exact over the
    successful runs; throughput is successes per second of successful run time."""
    n = F.col("_n")
    good = F.col("_ok")
    zero = F.lit(0).cast("bigint")
    # the records are read once, for counts and sums per distinct time
    t = F.col("query_time_seconds")
    per_time = written_once(
        _measured(df).groupBy("engine", F.coalesce(F.col("status") == "success", F.lit(False)).alias("_ok"), "query_time_seconds")
        .agg(F.count(F.lit(1)).alias("_n"), F.count("status").alias("_told"), F.max("peak_memory_bytes").alias("_peak"),
             F.sum("spill_bytes").alias("_spill"), F.sum("cpu_time_millis").alias("_cpu")), "per_time")
    succeeded = F.sum(F.when(good, n).otherwise(zero))
    ok_time = F.round(F.sum(F.when(good, t * n)), 6)
    totals = per_time.groupBy("engine").agg(
        F.sum(n).alias("total_queries"),
        succeeded.alias("success_count"),
        F.sum(F.when(good, zero).otherwise(F.col("_told"))).alias("failure_count"),
        F.round(ratio(succeeded, F.sum(n)), 4).alias("success_rate"),
        F.round(F.sum(t * n), 3).alias("total_runtime_seconds"),
        F.round(F.coalesce(ratio(succeeded, ok_time), F.lit(0.0)), 6).alias("avg_throughput_qps"),
        F.coalesce(F.max(F.when(good, F.col("_peak"))), zero).alias("max_peak_memory_bytes"),
        F.coalesce(F.sum(F.when(good, F.col("_spill"))), zero).alias("total_spill_bytes"),
        F.coalesce(F.sum(F.when(good, F.col("_cpu"))), zero).alias("total_cpu_time_millis"))
    timed = per_time.filter(good & t.isNotNull()).select("engine", "query_time_seconds", "_n")
    medians = median_of_counts(timed, ["engine"], "query_time_seconds", "_median").withColumnRenamed("engine", "_engine")
    return (totals.join(medians, F.col("engine").eqNullSafe(F.col("_engine")), "left")
            .withColumn("median_query_time_seconds", F.round(F.coalesce("_median", F.lit(0.0)), 3)).drop("_engine", "_median"))


def _per_engine(df: DataFrame, value: Column, first: str, second: str, prefix: str):
    return [F.max(F.when(F.col("engine") == e, value)).alias(f"{prefix}_{e}") for e in (first, second)]


def validation(df: DataFrame, first: str, second: str) -> DataFrame:
    """Result hashes of two engines side by side per query and run; only pairs
    where both succeeded."""
    ok = _measured(df).filter((F.col("status") == "success") & F.col("engine").isin(first, second))
    pair = ok.groupBy("query_name", "run_number").agg(
        *_per_engine(ok, F.col("result_hash"), first, second, "hash"),
        *_per_engine(ok, F.col("row_count"), first, second, "rows"))
    a, b = F.col(f"hash_{first}"), F.col(f"hash_{second}")
    return (pair.filter(a.isNotNull() & b.isNotNull())
            .withColumn("matches", a == b)
            .withColumn("same_rows", F.col(f"rows_{first}").eqNullSafe(F.col(f"rows_{second}"))))


def time_ratios(df: DataFrame, first: str, second: str) -> DataFrame:
    """Mean successful run time per query and engine, and first / second."""
    ok = _measured(df).filter((F.col("status") == "success") & F.col("engine").isin(first, second))

    def mean(e: str) -> Column:
        mine = F.col("engine") == e
        return ratio(F.round(F.sum(F.when(mine, F.col("query_time_seconds"))), 6), F.count_if(mine))

    out = ok.groupBy("query_name").agg(mean(first).alias(f"mean_{first}"), mean(second).alias(f"mean_{second}"))
    return out.withColumn("time_ratio", ratio(f"mean_{first}", f"mean_{second}"))


def speed_tiers(ratios: DataFrame) -> DataFrame:
    """Number of queries per speed-up tier."""
    r = F.col("time_ratio")
    # Tier bounds.
    tier = (F.when(r > 10, ">10x").when(r > 2, "2-10x").when(r >= 0.8, "0.8-2x")
            .when(r < 0.8, "<0.8x"))
    return (ratios.filter(r.isNotNull()).groupBy(tier.alias("tier"))
            .agg(F.count(F.lit(1)).alias("queries")))


def row_count_mismatches(pairs: DataFrame) -> DataFrame:
    return pairs.filter(~F.col("same_rows"))


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Task-end events of Spark event logs (only the needed fields are parsed)."""
    schema = ("Event STRING, `Stage ID` BIGINT, `Task Metrics` STRUCT<`Peak Execution Memory`: BIGINT, "
              "`Memory Bytes Spilled`: BIGINT, `Disk Bytes Spilled`: BIGINT, `Executor CPU Time`: BIGINT>")
    return spark.read.schema(schema).json(path).filter(F.col("Event") == "SparkListenerTaskEnd")


def task_metrics(tasks: DataFrame) -> DataFrame:
    """Largest task memory, total spill and CPU time over task-end events."""
    m = "`Task Metrics`."
    spill = F.coalesce(F.col(m + "`Memory Bytes Spilled`"), F.lit(0)) + \
        F.coalesce(F.col(m + "`Disk Bytes Spilled`"), F.lit(0))
    return tasks.agg(
        F.coalesce(F.max(m + "`Peak Execution Memory`"), F.lit(0)).alias("peak_memory_bytes"),
        F.coalesce(F.sum(spill), F.lit(0)).alias("spill_bytes"),
        F.coalesce(F.sum(F.floor(F.col(m + "`Executor CPU Time`") / 1_000_000)), F.lit(0)).alias("cpu_time_millis"))
