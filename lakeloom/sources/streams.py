"""Message streams: readers are thin, parsers are DataFrame -> DataFrame and
serve batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.schemas import CLICK_PAYLOAD, GPS_PAYLOAD


def kafka_options(servers: str, topic: str, starting: str = "earliest",
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_topic(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """Whole topic as a batch frame (key, value, timestamp, ...)."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, **kw)).load()


def stream_topic(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kw)).load()


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed payload columns plus the named message columns. Text that is not
    JSON gives NULL payload columns; the message itself is kept."""
    data = F.from_json(F.col(value).cast("string"), schema)
    return df.select(data.alias("data"), *keep).select("data.*", *keep)


def parse_click_events(df: DataFrame, stamp: bool = True) -> DataFrame:
    """Message frame (value, timestamp) -> bronze click events."""
    out = parse_json(df, CLICK_PAYLOAD, keep=("timestamp",))
    return out.withColumn("load_at", F.current_timestamp()) if stamp else out


def parse_gps(df: DataFrame, stamp: bool = True) -> DataFrame:
    """Message frame (value) -> flat waypoints with event time and date."""
    flat = parse_json(df, GPS_PAYLOAD).select("msgType", "msgBusWayPoint.*")
    event_time = F.timestamp_seconds(F.col("datetime"))
    out = flat.withColumns({"timestamp": event_time, "date": F.to_date(event_time)})
    return out.withColumn("load_at", F.current_timestamp()) if stamp else out


def replay_files(spark: SparkSession, folder: str, schema: T.StructType,
                 files_per_trigger: int = 1, multi_line: bool = False) -> DataFrame:
    """Replay a folder of JSON files, oldest first, a bounded number of files per
    micro-batch. The resume point is the query's checkpoint. The file source
    orders by modification time."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("latestFirst", "false")
            .option("multiLine", str(multi_line).lower())
            .json(folder))


def numbered_files(spark: SparkSession, folder: str, schema: T.StructType,
                   from_number: int | None = None, multi_line: bool = False) -> DataFrame:
    """Batch read of numbered JSON files with the number as a column, from a
    resume point on. Order rows by ``file_number`` where the order matters."""
    df = (spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(folder)
          .withColumn("file_number",
                      F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).try_cast("bigint")))
    return df if from_number is None else df.filter(F.col("file_number") >= from_number)


def drain_to_table(df: DataFrame, table: str, checkpoint: str,
                   partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append everything that is there now to a table, then stop. Progress is in
    the checkpoint, so a rerun continues where the last one ended."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .trigger(availableNow=True).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.toTable(table)


def stream_to_files(df: DataFrame, path: str, checkpoint: str,
                    partition_by: tuple[str, ...] = ("date",),
                    available_now: bool = False) -> StreamingQuery:
    """Append to date-partitioned Parquet, micro-batch after micro-batch."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint)
              .partitionBy(*partition_by))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
