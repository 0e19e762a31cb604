"""Cleaning that carries its own audit (C1, Q1-Q6, F10, A14), for write, audit, publish.

De-duplication and data-quality measures need the same thing: all rows of a (symbol, day, trade
id) together. One keyed aggregate gives both, so bronze is scanned and shuffled once: the
surviving row of a key, and the key's counts (rows, invalid ones, rows each step removes). The
counts travel with the row as the struct column ``_audit``; a key without a valid row has only
them. Written to a staging folder, the rows lie apart by ``part``, and the per-day report is an
aggregate over ``_audit`` alone, a column of nearly constant numbers that Parquet stores in a few
bytes a block. Rows and report come from the same written files, so a retried task counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tradewatch.config import CleanConfig
from tradewatch.operators.clean import LINEAGE, enrich, step_flags, survivor_order, typed_trades
from tradewatch.operators.dq import KEY_COUNTS, day_measures, key_counts
from tradewatch.schemas import SILVER, SILVER_STORED, project_to, symbol_keys

AUDIT = StructType([StructField(c, LongType(), False) for c in KEY_COUNTS])
KEPT, REJECTED = "rows", "rejected"


def audited_trades(bronze: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """One row per (symbol, day, trade id) of ``bronze``: silver's columns, ``_audit`` and ``part``.

    ``part`` is ``rows`` for a key with a valid row; its silver columns are those that
    :func:`tradewatch.operators.clean.clean_trades` gives. It is ``rejected`` for a key without
    one, whose silver columns are NULL but for id and day. NULL ids are one key.
    """
    typed = typed_trades(bronze, cfg)
    own, keys = symbol_keys(typed), ("trade_date", "trade_id")
    price_ok, qty_ok, date_ok = step_flags(cfg)
    rest = survivor_order([c for c in typed.columns if c not in (*own, *keys)])
    first = F.min(F.when(price_ok & qty_ok & date_ok, F.struct(*rest))).alias("_row")
    per_key = typed.groupBy(*own, *keys).agg(first, *key_counts(cfg))
    flat = per_key.select(
        *own, *keys, *[F.col(f"_row.{c}").alias(c) for c in rest],
        F.struct(*KEY_COUNTS).alias("_audit"),
        F.when(F.col("n_kept") > 0, F.lit(KEPT)).otherwise(F.lit(REJECTED)).alias("part"),
    )
    silver = enrich(flat)
    extra = [F.col(c) for c in LINEAGE if c in silver.columns]
    return project_to(silver, SILVER, *extra, *symbol_keys(silver), F.col("_audit"), F.col("part"))


def staged_schema(with_symbol: bool) -> StructType:
    own = [StructField("symbol", StringType(), True)] if with_symbol else []
    return StructType([*SILVER_STORED.fields, *own, StructField("_audit", AUDIT, True), StructField("part", StringType(), True)])


def staged_measures(staged: DataFrame) -> DataFrame:
    """:func:`tradewatch.operators.dq.day_measures` of staged rows, per day (``trade_date``) and symbol."""
    own = symbol_keys(staged)
    per_key = staged.select(*own, F.col("processed_date").alias("trade_date"), *[F.col(f"_audit.{c}").alias(c) for c in KEY_COUNTS])
    return day_measures(per_key, ["trade_date", *own])
