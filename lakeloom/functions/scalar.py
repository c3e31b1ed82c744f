"""Column helpers. All are built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum2(x) -> Column:
    """Sum of amounts with two decimals. Double sums depend on row order in the
    last bits; rounding to the amount's own scale removes that."""
    return F.round(F.sum(_c(x)), 2)


def sum4(x) -> Column:
    """As `sum2` for products of two two-decimal amounts."""
    return F.round(F.sum(_c(x)), 4)


def avg_of(x) -> Column:
    """Average that does not depend on row order: rounded sum over count."""
    return F.try_divide(sum2(x), F.count(_c(x)))


def ratio(a, b) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def net_of(gross="gross", discount="discount") -> Column:
    return _c(gross) * (F.lit(1.0) - _c(discount))


def sum_when(cond: Column, x) -> Column:
    return F.sum(F.when(cond, _c(x)))


def count_when(cond: Column) -> Column:
    return F.count_if(cond)


def day_of_week(x) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(x)) - 1


def in_dates(x, first: str, end: str) -> Column:
    """first <= x < end on a raw timestamp column, so the test reaches the scan."""
    return (_c(x) >= F.lit(first).cast("timestamp_ntz")) & (_c(x) < F.lit(end).cast("timestamp_ntz"))
