"""Frames that several branches of one plan read: written once in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` or the session's checkpoint folder. Only a
    session on one machine may do without: it gets a temporary folder. Elsewhere each
    executor would write to a disk that no other one sees, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is not set; {master} needs a folder that all executors share")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet files of the shared folder. Every branch reads the same rows, a
    lost executor costs no earlier stage, and each read takes its own columns. The files
    stay; let the folder expire."""
    path = f"{shared_folder(df.sparkSession)}/frames-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
