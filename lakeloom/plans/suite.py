"""Run a set of queries and record time, rows and result fingerprint of each, for
`operators.runs` (summary, validation of two engines, ratios). Queries may be SQL
files or DataFrame plans; Spark runs both."""

from __future__ import annotations

import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.compare import fingerprint
from lakeloom.schemas import RUN_RECORD


def listed_files(list_file: str) -> list[Path]:
    """SQL files named in a list beside them; blank and # lines are left out."""
    path = Path(list_file)
    names = (line.strip() for line in path.read_text(encoding="utf-8").splitlines())
    return [path.parent / n for n in names if n and not n.startswith("#")]


def sql_plans(spark: SparkSession, files: list[Path]) -> dict[str, Callable[[], DataFrame]]:
    """One lazy plan per file (one statement each, closing semicolon optional)."""

    def bind(f: Path):
        return lambda: spark.sql(f.read_text(encoding="utf-8").strip().rstrip(";"))

    return {f.stem: bind(f) for f in files}


def registered_tables(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Temporary views over Parquet tables, for SQL files."""
    for n in names:
        spark.read.parquet(f"{folder}/{n}.parquet").createOrReplaceTempView(n)


def record_runs(spark: SparkSession, plans: dict[str, Callable[[], DataFrame]], engine: str,
                runs: int = 1, warmups: int = 0, algorithm: str = "md5") -> DataFrame:
    """Run records, one per query and run. A result is reduced to its fingerprint
    where it is computed; only that row reaches the driver. A failing query is
    recorded and the next one runs."""
    records = []
    for name, plan in plans.items():
        for i in range(-warmups, runs):
            record = {"engine": engine, "query_name": name, "run_type": "warmup" if i < 0 else "measured",
                      "run_number": i + 1 if i >= 0 else i + warmups + 1, "query_id": f"{engine}-{name}-{i + warmups}",
                      "peak_memory_bytes": 0, "spill_bytes": 0, "cpu_time_millis": 0}
            start = time.perf_counter()
            try:
                row = fingerprint(plan(), algorithm).first()
                record |= {"status": "success", "row_count": row.row_count,
                           "result_hash": ":".join(map(str, row))}
            except Exception as e:  # noqa: BLE001 - the failure is the record
                record |= {"status": "failed", "error_message": str(e)}
            record["query_time_seconds"] = round(time.perf_counter() - start, 3)
            if record["status"] == "success" and record["query_time_seconds"] > 0:
                record["throughput_qps"] = 1.0 / record["query_time_seconds"]
            records.append(tuple(record.get(f.name) for f in RUN_RECORD.fields))
    return spark.createDataFrame(records, RUN_RECORD)


def with_task_metrics(records: DataFrame, metrics: DataFrame) -> DataFrame:
    """Fill memory, spill and CPU time from `task_metrics` rows keyed by query_id."""
    names = ("peak_memory_bytes", "spill_bytes", "cpu_time_millis")
    m = metrics.select("query_id", *[F.col(n).alias(f"_{n}") for n in names])
    out = records.join(m, "query_id", "left").withColumns({n: F.coalesce(f"_{n}", n) for n in names})
    return out.select(records.columns)
