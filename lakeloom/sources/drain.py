"""Draining a message stream into files exactly once, with rejects.

A micro-batch writes the rows it could parse and the messages it could not into folders of
its own attempt, and then one line of the ledger that names the attempt. A batch that is
done again after a failure writes another attempt, and its line replaces the one before;
readers see only the attempts of the ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

_WHOLE = "_corrupt"
_LEDGER = "feed string, batch bigint, attempt string, rows bigint, rejects bigint, done_at timestamp"
_PLACE = ["feed", "batch", "attempt"]
_KEYS = [T.StructField("feed", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())]


class Drain:
    """Rows of JSON messages (``value``, and the ``keep`` columns beside it) under ``path``.

    ``payload`` is the type of a message. A message is a reject if it is null, is no JSON
    object, a field has a value of another type, or one of the ``required`` fields is
    missing; its text is kept with the reason. ``feed`` names the stream: two streams with
    checkpoints of their own may fill one path under different names."""

    def __init__(self, spark: SparkSession, path: str, payload: T.StructType, feed: str,
                 required: tuple[str, ...] = (), keep: tuple[str, ...] = ("timestamp",)):
        self.spark, self.path, self.payload, self.feed = spark, path.rstrip("/"), payload, feed
        self.required, self.keep = required, keep

    def split(self, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows, rejects) of message frames, batch or one batch of a stream."""
        schema = T.StructType([*self.payload.fields, T.StructField(_WHOLE, T.StringType())])
        text = F.col("value").cast("string")
        read = messages.withColumn("_text", text).withColumn(
            "_data", F.from_json("_text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _WHOLE}))
        missing = F.filter(F.array(*[F.when(F.col("_data")[c].isNull(), F.lit(c)) for c in self.required] or [F.lit(None).cast("string")]),
                           lambda c: c.isNotNull())
        why = (F.when(F.col("_text").isNull(), "no text")
               .when(F.col("_data").isNull() | F.col("_data")[_WHOLE].isNotNull(), "not of the message's type")
               .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))))
        told = read.withColumn("_why", why)
        rows = told.filter(F.col("_why").isNull()).select(*[F.col("_data")[f.name].alias(f.name) for f in self.payload.fields], *self.keep)
        rejects = told.filter(F.col("_why").isNotNull()).select(F.col("_text").alias("value"), F.col("_why").alias("reason"), *self.keep)
        return rows, rejects

    def take(self, messages: DataFrame, number: int) -> None:
        """One micro-batch. The ledger's line is written last."""
        place = {"feed": F.lit(self.feed), "batch": F.lit(number).cast("bigint"), "attempt": F.lit(uuid.uuid4().hex)}
        for kind, df in zip(("rows", "rejects"), self.split(messages)):
            df.withColumns(place).write.mode("append").partitionBy(*_PLACE).parquet(f"{self.path}/{kind}")
        self._done(place)

    def _done(self, place: dict) -> None:
        here = (F.col("feed") == place["feed"]) & (F.col("batch") == place["batch"]) & (F.col("attempt") == place["attempt"])
        n = {k: self._stored(k).filter(here).count() for k in ("rows", "rejects")}
        line = self.spark.range(1, numPartitions=1).select(F.lit(n["rows"]).cast("bigint").alias("rows"),
                                                           F.lit(n["rejects"]).cast("bigint").alias("rejects"),
                                                           F.current_timestamp().alias("done_at")).withColumns(place)
        (line.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feed", "batch")
         .parquet(f"{self.path}/ledger"))

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Drains what is there now, then stops; a later start goes on from the checkpoint."""
        return (stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(_LEDGER).parquet(f"{self.path}/ledger")

    def _stored(self, kind: str) -> DataFrame:
        kept = [T.StructField(c, T.TimestampType() if c == "timestamp" else T.StringType()) for c in self.keep]
        own = self.payload.fields if kind == "rows" else [T.StructField("value", T.StringType()), T.StructField("reason", T.StringType())]
        return self.spark.read.schema(T.StructType([*own, *kept, *_KEYS])).parquet(f"{self.path}/{kind}")

    def rows(self) -> DataFrame:
        """Rows of finished batches, with their feed and batch."""
        return self._stored("rows").join(self.ledger().select(_PLACE), _PLACE, "left_semi")

    def rejects(self) -> DataFrame:
        return self._stored("rejects").join(self.ledger().select(_PLACE), _PLACE, "left_semi")
