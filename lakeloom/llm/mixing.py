"""Mixing sources to target weights.

Each row gets a hash-random key. Within a source the rows are put in key order by
key ranges: the first digits of the key name the range, so no sampling job is
needed and the ranges of a source are of equal size whatever its share of the rows.
Prefix sums of the sizes over the ranges find the range that holds the source's
budget; only that range is sorted, and prefix sums inside it give the cut. The
whole decision is then one row per source (full epochs, last key of the part epoch),
and it is applied to rows as an expression: texts are never shuffled.

Bounds: (sources x ranges) sums, one row per source of the cut table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.tables import WORD, table, written

WEIGHTS = (3, 1, 2)  # of the sources in code point order, repeating
SHARE = 1.5          # size of the mix, of the size of all sources
CEILING = 2.0        # most epochs of a source
SEED = 17


def mix_key(row_id: Column, text: Column, seed: int = SEED) -> Column:
    """Hash-random key (32 hex digits) of a row. It covers the text, so only rows
    equal in both id and text share a key; those move together."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(row_id.cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(text, F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   ceiling: float = CEILING) -> DataFrame:
    """Per source of ``sizes`` (source, source_size): ``target``. The mix has
    ``share`` of all sizes, dealt by weight; a target stops at ``ceiling`` times its
    source, and what that leaves over is dealt again by weight among the others.

    The fixed point is the least of the ceiling and a common level times the weight;
    in order of size per weight, the first sources stop at the ceiling, and the level
    comes from prefix sums of what is left. The windows hold one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(int(w)) for w in weights])
    named = sizes.withColumn("weight", F.element_at(listed, ((F.row_number().over(by_name) - 1) % len(weights)) + 1))
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    left = (F.lit(share) * F.sum("source_size").over(all_rows)
            - F.lit(ceiling) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    weight_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = (named.withColumn("_level", left / weight_left)
              .withColumn("_open", F.lit(ceiling) * F.col("source_size") > F.col("_level") * F.col("weight"))
              .withColumn("_common", F.min(F.when(F.col("_open"), F.struct(F.col("source_size") / F.col("weight"),
                                                                          F.col("_level").alias("level"))))
                          .over(all_rows)["level"]))
    cap = F.lit(ceiling) * F.col("source_size")
    return levels.select("source", "source_size", "weight",
                         F.coalesce(F.least(cap, F.col("_common") * F.col("weight")), cap).alias("target"))


def cut_points(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
               ceiling: float = CEILING, digits: int = 3) -> DataFrame:
    """From rows (source, key, size): per source ``source_size``, ``target``,
    ``epochs`` (times every row is taken) and ``last_key`` (rows with a key up to it
    are taken once more; null: none).

    A row whose middle lies inside the budget is taken whole, so the mix differs from
    its target by half a row at most. ``digits``: 16**digits key ranges."""
    ranged = (sized.groupBy("source", F.substring("key", 1, digits).alias("_range"))
              .agg(F.sum("size").alias("_in_range")))
    ranged = written(ranged, "ranges")
    targets = source_targets(ranged.groupBy("source").agg(F.sum("_in_range").alias("source_size")), weights, share,
                             ceiling)
    budget = (targets.withColumn("epochs", F.when(F.col("source_size") > 0,
                                                  F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
              .withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    budget = written(budget, "budgets")
    run = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_until", F.sum("_in_range").over(run)).withColumn("_before",
                                                                                   F.col("_until") - F.col("_in_range"))
    b, p, s = budget.alias("b"), placed.alias("p"), sized.alias("s")
    same = F.col("b.source").eqNullSafe(F.col("p.source"))
    # the range with the cut, and the last whole range before it
    near = p.join(b, same).where("_rest > 0 AND _before < _rest")
    cut = (near.where("_until >= _rest").groupBy("p.source")
           .agg(F.min(F.struct("_range", "_before", "_rest")).alias("c"))
           .select("source", "c._range", "c._before", "c._rest"))
    c = cut.alias("c")
    inside = s.join(c, F.col("c.source").eqNullSafe(F.col("s.source"))
                    & (F.substring("s.key", 1, digits) == F.col("c._range")))
    # rows of one key are taken together, so their sizes are added up first
    tied = inside.groupBy("s.source", "s.key").agg(F.sum("size").alias("_size"), F.first("_before").alias("_before"),
                                                   F.first("_rest").alias("_rest"))
    up_to = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_before") + F.sum("_size").over(up_to) - F.col("_size") / 2
    in_range = tied.withColumn("_middle", middle).where("_middle <= _rest").groupBy("source").agg(
        F.max("key").alias("_in_cut"))
    whole = near.where("_until < _rest").groupBy("p.source").agg(F.max("_range").alias("_last"))
    i, w = in_range.alias("i"), whole.alias("w")
    top = F.concat(F.col("w._last"), F.lit("f" * (32 - digits)))
    return (b.join(i, F.col("b.source").eqNullSafe(F.col("i.source")), "left")
            .join(w, F.col("b.source").eqNullSafe(F.col("w.source")), "left")
            .select("b.source", "b.source_size", "b.target", F.col("b.epochs").cast("int").alias("epochs"),
                    F.coalesce(F.col("i._in_cut"), top).alias("last_key")))


def _joined(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with the cut of their source; the few cut rows are broadcast only as
    far as Catalyst measures them to be small."""
    renamed = cuts.select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
                          F.col("target").alias("_target"), F.col("epochs").alias("_epochs"),
                          F.col("last_key").alias("_last_key"))
    return rows.join(renamed, rows["source"].eqNullSafe(renamed["_source"])).withColumn(
        "_copies", F.col("_epochs") + F.when(F.col("_key") <= F.col("_last_key"), 1).otherwise(0))


def sized_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    size = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.regexp_count("text", F.lit(WORD))).cast("bigint")
    return docs.select("doc_id", "source", mix_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
                       size.alias("size"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING,
        seed: int = SEED) -> DataFrame:
    """The mixed rows: ``docs`` (doc_id, text, source and any others) with each row
    repeated as often as the mix takes it.

    A null source is a source of its own, last in order. Null and empty texts have
    size 0 and are taken in whole epochs or where the cut passes them; a source
    without words has target 0. Rows equal in id and text are taken together. Other
    columns, whatever their names, are carried along; an empty table gives none."""
    cuts = cut_points(written(sized_rows(docs, seed).select("source", "key", "size"), "sized"), weights, share, ceiling)
    # the row goes along as one struct, so that no name of its columns meets one used here
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document")
    keyed = docs.select(row, "source", mix_key(F.col("doc_id"), F.col("text"), seed).alias("_key"))
    taken = _joined(keyed, written(cuts, "cuts")).where("_copies > 0")
    return taken.select("_document", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_document.*")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = written(sized_rows(table(spark, folder, "documents")), "sized")
    cuts = written(cut_points(sized), "cuts")
    return _joined(sized.withColumnRenamed("key", "_key"), cuts).select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_copies") * F.col("size")).alias("taken"), F.col("_copies").alias("copies"))


OP3_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS INTEGER) AS weight,
              row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s0),
-- deal by weight, stop sources at twice their size, deal the rest again
deal AS (
  SELECT 0 AS step, n, source_size, weight, FALSE AS full_up FROM s1
  UNION ALL
  SELECT step + 1, n, source_size, weight,
         full_up OR 2.0 * source_size <= weight * ((1.5 * sum(source_size) OVER ()
           - 2.0 * coalesce(sum(source_size) FILTER (WHERE full_up) OVER (), 0))
           / CAST(sum(weight) FILTER (WHERE NOT full_up) OVER () AS DOUBLE))
  FROM deal WHERE step < (SELECT count(*) FROM s1)),
done AS (SELECT * FROM deal WHERE step = (SELECT max(step) FROM deal)),
lev AS (SELECT (1.5 * sum(source_size) - 2.0 * coalesce(sum(source_size) FILTER (WHERE full_up), 0))
               / CAST(sum(weight) FILTER (WHERE NOT full_up) AS DOUBLE) AS level FROM done),
targets AS (SELECT s1.source, s1.source_size,
              CASE WHEN d.full_up THEN 2.0 * s1.source_size ELSE level * s1.weight END::DOUBLE AS target
            FROM s1 JOIN done d USING (n), lev),
tied AS (SELECT source, key, sum(size) AS ks FROM sized GROUP BY source, key),
ordered AS (SELECT t.source, t.key, g.target, g.source_size, ks,
              sum(ks) OVER (PARTITION BY t.source ORDER BY key) - ks / 2.0::DOUBLE AS middle,
              CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS epochs
            FROM tied t JOIN targets g ON g.source IS NOT DISTINCT FROM t.source),
counted AS (SELECT source, key, source_size, target,
              epochs + CASE WHEN target - epochs * source_size > 0
                AND middle <= target - epochs * source_size THEN 1 ELSE 0 END AS copies FROM ordered)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, c.source_size, c.target,
       CAST(c.copies * s.size AS BIGINT) AS taken, CAST(c.copies AS INTEGER) AS copies
FROM sized s JOIN counted c ON c.source IS NOT DISTINCT FROM s.source AND c.key = s.key"""
