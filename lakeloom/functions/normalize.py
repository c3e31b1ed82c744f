"""Engine-neutral text form of a value, and a row hash over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
# Texts that count as missing, and the text written for them.
MISSING_TEXTS = ("NULL", "NONE", "")
MISSING = "NULL"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _four_decimals(c: Column, dtype: T.DataType) -> Column:
    """Four decimals for every value that a DECIMAL(38,4) can hold, whatever its type;
    beyond it decimals keep their exact digits and floating values their own text."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.concat(c.cast("string"), F.lit(".0000"))
    return F.coalesce(c.try_cast("decimal(38,4)").cast("string"), _digits(c.cast("string")))


def _digits(text: Column) -> Column:
    """A number as text without plus sign, leading zeros, or zeros after its last
    decimal; with an exponent, the text of the double."""
    plain = F.regexp_replace(F.regexp_replace(text, r"^[+]", ""), r"^(-?)0+(?=[0-9])", "$1")
    plain = F.regexp_replace(F.regexp_replace(plain, r"([.][0-9]*?)0+$", "$1"), r"[.]$", "")
    return F.when(F.lower(text).contains("e"), text.try_cast("double").cast("string")).otherwise(plain)


def normalized(name: str, dtype: T.DataType) -> Column:
    """Numbers (also numbers held as text) to four decimals, text trimmed,
    missing values and missing-value texts to ``NULL``."""
    c = F.col(name)
    if isinstance(dtype, _NUMERIC):
        return F.coalesce(_four_decimals(c, dtype), F.lit(MISSING))
    text = F.trim(c.cast("string"))
    missing = text.isNull() | F.upper(text).isin(*MISSING_TEXTS)
    if isinstance(dtype, T.StringType):
        # a failed cast costs an exception inside the JVM, so only numbers are cast
        number = F.when(text.rlike(NUMBER), F.coalesce(text.try_cast("decimal(38,4)").cast("string"), _digits(text)))
        text = F.coalesce(number, text)
    return F.when(missing, F.lit(MISSING)).otherwise(text)


HASH_WORDS = 4


def row_hash(df: DataFrame, algorithm: str = "md5") -> list[Column]:
    """128-bit hash of a row's normalised cells (columns in given order), as four
    32-bit words.

    ``md5`` gives a value any engine can recompute; ``xxhash64`` (two seeds) is cheaper
    and meant for Spark-to-Spark comparison."""
    cells = [normalized(f.name, f.dataType) for f in df.schema.fields]
    joined = F.concat_ws("\u001f", *cells)
    if algorithm == "xxhash64":
        halves = [F.xxhash64(joined), F.xxhash64(F.lit(1), joined)]
        return [w for h in halves for w in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    if algorithm != "md5":
        raise ValueError(f"unknown algorithm: {algorithm}")
    digest = F.md5(joined)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(HASH_WORDS)]
