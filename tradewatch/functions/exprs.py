"""Scalar expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them depends on the session time zone (timestamps are NTZ).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_us_to_ts(col: Column | str) -> Column:
    """Epoch microseconds -> TIMESTAMP_NTZ, exact."""
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(_EPOCH_NTZ))


def to_epoch_us(col: Column | str) -> Column:
    """TIMESTAMP_NTZ -> epoch microseconds (inverse of :func:`epoch_us_to_ts`)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(col))


def floor_div(col: Column | str, n: int) -> Column:
    """Floor division of a long by a positive constant, exact for |x| < 2**53."""
    c = _c(col)
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def pct_change(close: Column | str, prev_close: Column | str) -> Column:
    """Percent change from the previous close; NULL unless prev_close > 0."""
    cur, prev = _c(close), _c(prev_close)
    return F.when(prev.isNotNull() & (prev > 0), (cur - prev) / prev * 100).otherwise(
        F.lit(None).cast("double")
    )


def severity(pump_pct: Column | str, high: float = 20.0, medium: float = 10.0) -> Column:
    """HIGH / MEDIUM / LOW by pump size."""
    p = _c(pump_pct)
    return F.when(p >= high, F.lit("HIGH")).when(p >= medium, F.lit("MEDIUM")).otherwise(F.lit("LOW"))


def date_id(day: Column | str) -> Column:
    """int YYYYMMDD of a date."""
    d = _c(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(day: Column | str) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(_c(day)).cast("int")


def round_to_second(col: Column | str) -> Column:
    """TIMESTAMP_NTZ rounded half-up to whole seconds, as a DATETIME column
    without fraction stores it (T16): 23:59:59.6 becomes the next day's 00:00:00."""
    us = to_epoch_us(col)
    return epoch_us_to_ts(floor_div(us + 500_000, 1_000_000) * 1_000_000)
