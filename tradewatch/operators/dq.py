"""Data-quality report and gates (Q1-Q6) and cleaning step counts.

The surveyed suite ran ten ``count()`` actions per day. Here every measure of
every day comes from one two-level aggregate: first per (day, trade_id) —
which also yields the exact distinct-key count with NULL counted once, like
``distinct().count()`` — then per day. Both levels aggregate map-side, so a
key or a day holding a third of the rows is collapsed before any shuffle.
Only the per-day report (one row per day) ever reaches the driver. The daily run takes
the first level along with the de-duplication instead (:mod:`tradewatch.operators.staged`).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.config import CleanConfig, DQConfig
from tradewatch.operators.clean import step_flags
from tradewatch.schemas import symbol_keys


# Measures of one (symbol, day, trade id), in the order of :func:`key_counts`.
KEY_COUNTS = ["n", "n_price_bad", "n_qty_bad", "n_ts_bad", "n_rm_price", "n_rm_qty", "n_rm_date", "n_kept"]


def key_counts(cfg: CleanConfig = CleanConfig()) -> list[Column]:
    """Aggregates over the typed rows of one (symbol, day, trade id): rows, invalid ones, and those each step removes."""
    price_ok, qty_ok, date_ok = step_flags(cfg)
    price_bad = F.col("price").isNull() | (F.col("price") <= 0)
    qty_bad = F.col("qty").isNull() | (F.col("qty") <= 0)
    ts_bad = F.col("trade_time").isNull() | (F.to_date("trade_time") != F.col("trade_date"))
    conditions = [
        price_bad, qty_bad, ts_bad,
        ~price_ok, price_ok & ~qty_ok, price_ok & qty_ok & ~date_ok, price_ok & qty_ok & date_ok,
    ]
    counts = [F.count(F.lit(1)), *[F.count_if(c) for c in conditions]]
    return [c.alias(name) for c, name in zip(counts, KEY_COUNTS)]


def day_measures(per_key: DataFrame, by: list[str]) -> DataFrame:
    """DQ measures (Q1-Q5) and cleaning step counts (F10) per ``by``, from rows of :data:`KEY_COUNTS`, one a key."""
    return per_key.groupBy(*by).agg(
        F.sum("n").alias("total_rows"),
        F.sum("n_price_bad").alias("invalid_prices"),
        F.sum("n_qty_bad").alias("invalid_qty"),
        F.sum("n_ts_bad").alias("out_of_range_timestamps"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_trade_ids"),
        F.sum("n_rm_price").alias("removed_price"),
        F.sum("n_rm_qty").alias("removed_qty"),
        F.sum("n_rm_date").alias("removed_date"),
        (F.sum("n_kept") - F.count_if(F.col("n_kept") > 0)).alias("removed_duplicates"),
        F.count_if(F.col("n_kept") > 0).alias("rows_out"),
    )


def audit(typed: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """One row per day: DQ measures (Q1-Q5) and cleaning step counts."""
    return day_measures(typed.groupBy(*symbol_keys(typed), "trade_date", "trade_id").agg(*key_counts(cfg)), ["trade_date"])


def _with_gates(report: DataFrame, dq: DQConfig) -> DataFrame:
    total = F.col("total_rows")
    rate = lambda c: F.try_divide(F.col(c).cast("double"), total)
    return (
        report.withColumn("row_count_ok", total >= dq.min_rows)
        .withColumn("invalid_price_rate", rate("invalid_prices"))
        .withColumn("invalid_qty_rate", rate("invalid_qty"))
        .withColumn("out_of_range_rate", rate("out_of_range_timestamps"))
        .withColumn(
            "passed",
            (total > 0)
            & (F.col("invalid_price_rate") <= dq.max_invalid_price_rate)
            & (F.col("invalid_qty_rate") <= dq.max_invalid_qty_rate)
            & (F.col("out_of_range_rate") <= dq.max_out_of_range_rate),
        )
    )


DQ_COLUMNS = [
    "trade_date",
    "total_rows",
    "row_count_ok",
    "invalid_prices",
    "invalid_qty",
    "out_of_range_timestamps",
    "duplicate_trade_ids",
    "invalid_price_rate",
    "invalid_qty_rate",
    "out_of_range_rate",
    "passed",
]

STEP_COLUMNS = ["trade_date", "total_rows", "removed_price", "removed_qty", "removed_date", "removed_duplicates", "rows_out"]


def expected_days(report: DataFrame, days: list[date] | None) -> DataFrame:
    """Right-join the report to the expected days, so a day without rows reports 0."""
    if days is None:
        return report
    spark = report.sparkSession
    want = spark.createDataFrame([(d,) for d in days], "trade_date date")
    filled = want.join(report, "trade_date", "left")
    zeros = {c: 0 for c in report.columns if c != "trade_date"}
    return filled.fillna(zeros)


def dq_report(
    typed: DataFrame,
    days: list[date] | None = None,
    cfg: CleanConfig = CleanConfig(),
    dq: DQConfig = DQConfig(),
    with_steps: bool = False,
) -> DataFrame:
    """Q1-Q6 per day, before any filtering, with the pass/fail of each gate;
    ``with_steps`` adds the cleaning step counts of the same aggregate."""
    return gated_report(expected_days(audit(typed, cfg), days), dq, with_steps)


def gated_report(measures: DataFrame, dq: DQConfig = DQConfig(), with_steps: bool = False) -> DataFrame:
    """:func:`day_measures` with the rates and the pass/fail of each gate; per symbol if it has one."""
    cols = DQ_COLUMNS + ([c for c in STEP_COLUMNS if c not in DQ_COLUMNS] if with_steps else [])
    return _with_gates(measures, dq).select(*symbol_keys(measures), *cols)


def step_counts(typed: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """rows removed by each cleaning step, cumulative, per day."""
    return audit(typed, cfg).select(*STEP_COLUMNS)


class DataQualityError(ValueError):
    pass


def _name(r: dict) -> str:
    return f"{r['symbol']} {r['trade_date']}" if r.get("symbol") else str(r["trade_date"])


def enforce(report: DataFrame, dq: DQConfig = DQConfig()) -> list[dict]:
    """Raise on any failing day (empty, or a rate above its threshold); return the rows.

    Collects the per-day report only: one row per day.
    """
    rows = [r.asDict() for r in report.orderBy("trade_date", *symbol_keys(report)).collect()]
    bad = []
    for r in rows:
        if not r["total_rows"]:
            bad.append(f"{_name(r)}: no rows")
            continue
        for rate, limit, what in (
            ("invalid_price_rate", dq.max_invalid_price_rate, "price"),
            ("invalid_qty_rate", dq.max_invalid_qty_rate, "qty"),
            ("out_of_range_rate", dq.max_out_of_range_rate, "timestamp"),
        ):
            if r[rate] is not None and r[rate] > limit:
                bad.append(f"{_name(r)}: {what} invalidity {r[rate]:.2%} exceeds {limit:.0%}")
    if bad:
        raise DataQualityError("; ".join(bad))
    return rows


def warnings_of(rows: list[dict], dq: DQConfig = DQConfig()) -> list[str]:
    """What a run reports without stopping: days with few rows (Q1) and repeated trade ids (Q5)."""
    out = []
    for r in rows:
        if not r["row_count_ok"]:
            out.append(f"{_name(r)}: {r['total_rows']} rows, fewer than {dq.min_rows}")
        if r["duplicate_trade_ids"]:
            out.append(f"{_name(r)}: {r['duplicate_trade_ids']} rows repeat a trade id")
    return out
