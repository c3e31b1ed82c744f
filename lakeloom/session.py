"""Session defaults. Every value is a public Spark setting; what the user or the
cluster sets at launch is kept."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings the operators count on.
#
# * AQE re-plans joins from measured shuffle sizes: a side becomes a broadcast
#   side only when its measured size is under autoBroadcastJoinThreshold, and a
#   sort-merge join otherwise. No operator forces a broadcast by hint.
# * Times are written as 64-bit microseconds, which have statistics per row group; the
#   older 96-bit form has none, so filters on it skip nothing.
# * A skewed join partition is split even where that costs one more shuffle
#   downstream, so one key with a third of the rows never lands in one task.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.session.timeZone": "UTC",
}

# Only for sessions built here: recording the Python line of every column
# expression takes as long as building the plan.
BUILD_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime settings above on an existing session, but for those named
    when the application was launched."""
    launched = spark.sparkContext.getConf()
    for key, value in RUNTIME_DEFAULTS.items():
        if not launched.contains(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, for functions that run
    in their Python workers. Needless where it is installed there or came with
    ``--py-files``, and then without effect."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        _shipped.add(application)
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(tempfile.mkdtemp(prefix="run-") + "/lakeloom_package", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
    return spark


def build_session(app_name: str = "lakeloom", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create a session. On a cluster leave ``master`` to spark-submit and give
    ``shuffle_partitions`` as a high first guess (AQE merges small ones)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_DEFAULTS, **BUILD_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location of a stream inside the cluster's shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; give the stream's checkpoint location")
    return f"{root.rstrip('/')}/streams/{name}"
