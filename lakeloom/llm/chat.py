"""Chat formatting by perspective rotation.

Every participant of a dialogue gets the dialogue rendered from its own place: its
messages are the assistant's, those of all others are named users', system messages
stay. The mask marks what the assistant says.

A dialogue is rendered in parts of ``PART`` turn numbers, so a dialogue of any length
is spread over tasks and no row grows with it. Rows that agree in dialogue, turn, role
and text are counted before the shuffle and are one message with a number of
``times``; a part with more than ``PART`` messages, copies counted, is cut into pieces
at every ``PART``th message in the order of the dialogue. Positions are counts in key
ranges plus the counts of the ranges before, so no part is gathered for them. The output is (participants x messages) of each dialogue, as
asked: a rotation for every participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.tables import table, written

PART = 64
SYSTEM = "system"
UNNAMED = "unknown"


def _escaped(text: Column) -> Column:
    """A text in which no marker can be read."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def _cut(counted: DataFrame, part: int) -> DataFrame:
    """Messages with ``times`` in pieces of ``part`` messages of their part, copies
    counted; copies that lie in several pieces are a row in each."""
    order = ("turn", "role", "text")
    number = F.coalesce(F.floor(F.col("turn") / part), F.lit(-1)).cast("bigint").alias("part")
    ranged = written(counted.repartitionByRange("conv_id", *order).select("*", number, F.spark_partition_id().alias("_range")),
                     "ranged")
    held = Window.partitionBy("_of", "_part").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    sums = (ranged.groupBy(F.col("conv_id").alias("_of"), F.col("part").alias("_part"), F.col("_range").alias("_in"))
            .agg(F.sum("times").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(held), F.lit(0))).drop("_n"))
    inside = Window.partitionBy("conv_id", "part", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_inside", F.coalesce(F.sum("times").over(inside), F.lit(0))).join(
        sums, F.col("conv_id").eqNullSafe(F.col("_of")) & (F.col("part") == F.col("_part")) & (F.col("_range") == F.col("_in")))
    start = F.col("_before") + F.col("_inside")
    placed = rows.select("conv_id", *order, "times", "part", start.alias("_start"))
    end = F.col("_start") + F.col("times")
    piece = F.explode(F.sequence(F.floor(F.col("_start") / part), F.floor((end - 1) / part))).alias("piece")
    times = F.least(end, (F.col("piece") + 1) * part) - F.greatest("_start", F.col("piece") * part)
    return placed.select("*", piece).select("conv_id", *order, times.alias("times"), "part", F.col("piece").cast("int").alias("piece"))


def rotate(turns: DataFrame, part: int = PART, copies: bool = False) -> DataFrame:
    """From messages (conv_id, turn, role, text): one row per conv_id, speaker, part
    and piece, with ``messages`` (turn, role, name, content, train, times), ``text``
    (the rendered part) and ``spans`` (start, end of what the speaker says in it, in
    characters, end marker included). With ``copies`` a message is rendered as many
    times as it occurs in the piece, else once.

    Messages are in order of turn, role and text. A null role is a participant called
    `UNNAMED`; a null text is empty; null turns come first, in part -1; messages with
    a null conv_id are one dialogue. A dialogue of system messages only has no
    speaker and no row. Other columns are not read; an empty table gives no rows."""
    named = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                         F.coalesce("role", F.lit(UNNAMED)).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = named.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times"))
    rows = _cut(counted, part)
    parts = rows.groupBy("conv_id", "part", "piece").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "times"))).alias("said"))
    speakers = (named.where(F.col("role") != SYSTEM).groupBy("conv_id", "role").agg(F.lit(1).alias("_one"))
                .select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")))
    views = parts.join(written(speakers, "speakers"), F.col("conv_id").eqNullSafe(F.col("_conv")))

    def seen(m: Column) -> Column:
        own = m["role"] == F.col("speaker")
        other = ~own & (m["role"] != SYSTEM)
        return F.struct(m["turn"].alias("turn"),
                        F.when(own, "assistant").when(other, "user").otherwise(SYSTEM).alias("role"),
                        F.when(other, m["role"]).alias("name"), m["text"].alias("content"), own.alias("train"),
                        m["times"].alias("times"))

    def head(m: Column) -> Column:
        name = F.when(m["name"].isNotNull(), F.concat(F.lit(" name="), _escaped(m["name"]))).otherwise("")
        return F.concat(F.lit("<|im_start|>"), m["role"], name, F.lit("\n"))

    def body(m: Column) -> Column:
        return F.concat(_escaped(m["content"]), F.lit("<|im_end|>\n"))

    seen_by = views.withColumn("messages", F.transform("said", seen))
    said = F.flatten(F.transform("messages", lambda m: F.array_repeat(m, m["times"].cast("int")))) if copies else F.col("messages")
    seen_by = seen_by.withColumn("_said", said)
    cut = (seen_by.withColumn("_heads", F.transform("_said", head)).withColumn("_bodies", F.transform("_said", body))
           .withColumn("_sizes", F.zip_with("_heads", "_bodies", lambda h, b: F.length(h) + F.length(b))))
    ends = F.transform("_sizes", lambda _, i: F.aggregate(F.slice("_sizes", 1, i + 1), F.lit(0), lambda a, x: a + x))
    spans = F.filter(F.transform("_said", lambda m, i: F.when(m["train"], F.struct(
        (F.get("_ends", i) - F.length(F.get("_bodies", i))).alias("start"), F.get("_ends", i).alias("end")))),
        lambda s: s.isNotNull())
    text = F.array_join(F.zip_with("_heads", "_bodies", lambda h, b: F.concat(h, b)), "")
    return cut.withColumn("_ends", ends).select("conv_id", "speaker", "part", "piece", "messages", text.alias("text"),
                                                spans.alias("spans"))


def op6_chat_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Per rendered piece: its messages, copies counted, characters, trained characters, and a digest of
    the rendered text."""
    views = rotate(table(spark, folder, "conversations"), copies=True)
    said = F.aggregate("messages", F.lit(0).cast("bigint"), lambda a, m: a + m["times"])
    trained = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    return views.select("conv_id", "speaker", "part", "piece", said.alias("n_messages"),
                        F.length("text").cast("bigint").alias("n_chars"), trained.cast("bigint").alias("n_trained"),
                        F.md5(F.col("text").cast("binary")).alias("digest"))


# every turn number of the tables holds few messages, so each part is in one piece
OP6_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         CAST(coalesce(floor(turn / 64.0), -1) AS BIGINT) AS part
  FROM conversations GROUP BY ALL),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
shown AS (
  SELECT s.*, p.speaker,
         '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
           ELSE 'user name=' || replace(role, '<|', '<\|') END || chr(10) AS head,
         replace(text, '<|', '<\|') || '<|im_end|>' || chr(10) AS body
  FROM said s JOIN speakers p ON p.conv_id IS NOT DISTINCT FROM s.conv_id)
SELECT conv_id, speaker, part, CAST(0 AS INTEGER) AS piece, count(*) AS n_messages,
       CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(length(body)) FILTER (WHERE role = speaker), 0) AS BIGINT) AS n_trained,
       md5(string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text)) AS digest
FROM shown GROUP BY conv_id, speaker, part"""
