"""Results kept up from changes: signed rows, joins of signed rows, sums that add up.

A table before and after a change is a bag of rows; the change is a bag of signed rows:
``n`` copies came (+n) or went (-n). Joins and sums carry the sign along, so a result
of joins and sums changes by what the signed rows give. Nothing but the changed rows and
what they meet in other tables is worked on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Copies of a row that came (above zero) or went.
SIGN = "_copies"


def netted(signed: DataFrame) -> DataFrame:
    """Equal rows as one, without those that cancel."""
    columns = [f"`{c}`" for c in signed.columns if c != SIGN]
    return signed.groupBy(*columns).agg(F.sum(SIGN).cast("int").alias(SIGN)).filter(F.col(SIGN) != 0)


def turned(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of ``old`` as gone and all of ``new`` as come; what is equal in both still has to cancel."""
    return old.select(new.columns).withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What turns ``old`` into ``new``, as signed rows of the columns of ``new``. Repeated
    rows count each, NULLs are equal to each other, a moved row is one gone and one come."""
    return netted(turned(old, new))


def signed(now: DataFrame) -> DataFrame:
    return now.withColumn(SIGN, F.lit(1))


def before(now: DataFrame, change: DataFrame) -> DataFrame:
    """The table before ``change``, as signed rows: ``now`` less what has come since."""
    return signed(now).unionByName(change.withColumn(SIGN, -F.col(SIGN)))


def met(one: DataFrame, two: DataFrame, on: str) -> DataFrame:
    """Inner join of signed rows: copies multiply."""
    joined = one.withColumnRenamed(SIGN, "_one").join(two.withColumnRenamed(SIGN, "_two"), on)
    return joined.withColumn(SIGN, F.col("_one") * F.col("_two")).drop("_one", "_two")


def exact(value: str | Column) -> Column:
    """Six decimals of a number, so that sums taken back leave nothing. What has more than
    14 digits before the point, and what is no number, counts as NULL."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(T.DecimalType(20, 6))


class SumTable:
    """Sums per key in files, one folder per increment.

    An increment holds, for the keys that it touches, what is to be added to ``sums``, and
    the new values of ``latest`` (such as maxima, which cannot be taken back and are found
    anew for touched keys). A second run of an increment replaces its own folder, so nothing
    counts twice. `compact` folds the increments so far into a base; reads then start there."""

    def __init__(self, spark: SparkSession, path: str, keys: str, sums: Sequence[str], latest: str = ""):
        """``keys`` and ``latest`` are column lists with types, as in DDL."""
        typed = lambda ddl: list(T.StructType.fromDDL(ddl)) if ddl else []
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sums = [f.name for f in typed(keys)], list(sums)
        self.latest = [f.name for f in typed(latest)]
        self.schema = T.StructType([*typed(keys), *[T.StructField(c, T.DecimalType(38, 6)) for c in sums], *typed(latest),
                                    T.StructField("increment", T.IntegerType())])

    def _write(self, rows: DataFrame, kind: str, increment: int) -> None:
        as_stored = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema[:-1]]
        (rows.select(*as_stored, F.lit(increment).alias("increment")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("increment").parquet(f"{self.path}/{kind}"))

    def _read(self, kind: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{kind}")

    def create(self) -> SumTable:
        """Empty folders where there are none."""
        none = self.spark.createDataFrame([], self.schema)
        for kind in ("increments", "bases"):
            none.write.mode("append").partitionBy("increment").parquet(f"{self.path}/{kind}")
        return self

    def add(self, increment: int, rows: DataFrame) -> None:
        """``rows``: one per touched key with ``sums`` to be added and values of ``latest``."""
        self._write(rows, "increments", increment)

    def _folded(self) -> DataFrame:
        """Rows of the newest base and the increments after it."""
        newest = self._read("bases").agg(F.max("increment")).first()[0]  # one number
        later = self._read("increments")
        if newest is None:
            return later
        return later.filter(F.col("increment") > newest).unionByName(self._read("bases").filter(F.col("increment") == newest))

    def rows(self) -> DataFrame:
        """One row per key: the sums of all increments, the newest values of ``latest``."""
        summed = [F.sum(c).cast(T.DecimalType(38, 6)).alias(c) for c in self.sums]
        newest = [F.max_by(c, "increment").alias(c) for c in self.latest]
        return self._folded().groupBy(*self.keys).agg(*summed, *newest)

    def compact(self) -> None:
        """Fold all increments so far into a base. Keys whose sums are all zero are left out."""
        upto = self._read("increments").agg(F.max("increment")).first()[0]
        if upto is not None:
            some = F.greatest(*[F.abs(c) for c in self.sums], F.lit(0)) != 0
            self._write(self.rows().filter(some), "bases", upto)
