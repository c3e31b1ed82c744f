"""A log of the newest rows of a stream, of fixed length.

Micro-batches are added to folders per time bucket, and their counts per bucket to a
small index. The index tells the edge: the bucket at which the newest rows reach the
length. Older buckets are dropped whole; only the edge bucket is cut, when it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.streaming.gps import LOG_LENGTH, retain_latest

_INDEX = "bucket bigint, n bigint, batch bigint"


class RollingLog:
    """The newest ``n`` rows by ``ts`` (ties by ``tie``) under ``path``; rows without a time
    are the oldest. ``schema`` is that of the rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str, n: int = LOG_LENGTH,
                 tie: str | None = None, bucket_seconds: int = 3600):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.ts, self.n, self.tie, self.seconds = ts, n, tie, bucket_seconds

    def add(self, batch: DataFrame, number: int) -> None:
        """Adds a micro-batch. Its folders carry its number, so the same batch written again
        after a failure replaces what it wrote before."""
        none = F.lit(-(2**62)).cast("bigint")
        bucket = F.coalesce(F.floor(F.unix_micros(F.col(self.ts).cast("timestamp")) / F.lit(self.seconds * 1_000_000)), none)
        rows = batch.select(*self.schema.fieldNames()).withColumns({"bucket": bucket.cast("bigint"), "batch": F.lit(number).cast("bigint")})
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch")
         .parquet(f"{self.path}/rows"))
        written = self._rows().filter(F.col("batch") == number)
        (written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).coalesce(1).withColumn("batch", F.lit(number).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.path}/index"))

    def _rows(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.LongType()), T.StructField("batch", T.LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def edge(self) -> tuple[int, int] | None:
        """The bucket of the cut and how many of its rows belong to the log; None while all
        rows do. Reads the index alone, which has a row per bucket and batch."""
        counts = self.spark.read.schema(_INDEX).parquet(f"{self.path}/index").groupBy("bucket").agg(F.sum("n").alias("n"))
        left = self.n
        # as many rows as the log has buckets of time
        for row in counts.orderBy(F.desc("bucket")).toLocalIterator():
            if row["n"] >= left:
                return row["bucket"], left
            left -= row["n"]
        return None

    def trim(self) -> list[int]:
        """Drops the buckets older than the edge and gives them back. Rows are only added, so
        the edge moves to newer times alone, and a late row of a dropped bucket is dropped
        with it at the next trim."""
        cut = self.edge()
        if cut is None:
            return []
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        dropped = []
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("bucket=") and int(name[7:]) < cut[0]:
                files.delete(status.getPath(), True)
                dropped.append(int(name[7:]))
        return sorted(dropped)

    def read(self) -> DataFrame:
        """The log: all rows of the buckets newer than the edge, and the newest of the edge."""
        rows, cut = self._rows(), self.edge()
        names = self.schema.fieldNames()
        if cut is None:
            return rows.select(names)
        newer = rows.filter(F.col("bucket") > cut[0]).select(names)
        return newer.unionByName(retain_latest(rows.filter(F.col("bucket") == cut[0]).select(names), self.ts, cut[1], self.tie))

    def start(self, stream: DataFrame, checkpoint: str, trim_every: int = 10) -> StreamingQuery:
        """Drains ``stream`` into the log, and trims it after every so many batches."""
        def take(batch: DataFrame, number: int) -> None:
            self.add(batch, number)
            if number % trim_every == trim_every - 1:
                self.trim()

        return (stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
