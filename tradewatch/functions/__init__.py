"""Column-expression helpers: plain Spark SQL expressions, JVM-side, codegen-friendly."""

from tradewatch.functions.exprs import (
    date_id,
    day_of_week,
    epoch_us_to_ts,
    floor_div,
    pct_change,
    round_to_second,
    severity,
    to_epoch_us,
)

__all__ = [
    "date_id",
    "day_of_week",
    "epoch_us_to_ts",
    "floor_div",
    "pct_change",
    "round_to_second",
    "severity",
    "to_epoch_us",
]
