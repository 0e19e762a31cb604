"""Trade-shaped views over the ``events`` table (FIXTURES.md §3).

``events`` is the only given table with trade-like timing; these views turn it
into trades without sampling or capping any rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions import to_epoch_us

# Start of the dense clock (2024-01-01 00:00:00.9994 in epoch µs),
# clump size 5, clump spacing 100 ms, spacing inside a clump 300 µs.
DENSE_T0_US = 1704153589999400
DENSE_CLUMP = 5
DENSE_CLUMP_GAP_US = 100_000
DENSE_STEP_US = 300


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades_sparse(events: DataFrame) -> DataFrame:
    """One trade per event: candles and pumps."""
    qty = F.lit(1.0) + (F.col("user_id") % 10)
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        qty.alias("qty"),
        F.col("ts").alias("trade_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        (F.col("user_id") % 2 == 1).alias("is_sell"),
        (qty * F.col("value")).alias("usd_value"),
        F.to_date("ts").alias("trade_date"),
    )


def trades_dense(events: DataFrame) -> DataFrame:
    """Clumps of five trades 300 µs apart every 100 ms: wash pairs."""
    eid = F.col("event_id")
    time = (
        F.lit(DENSE_T0_US)
        + (eid - F.pmod(eid, F.lit(DENSE_CLUMP))) / DENSE_CLUMP * DENSE_CLUMP_GAP_US
        + F.pmod(eid, F.lit(DENSE_CLUMP)) * DENSE_STEP_US
    ).cast("long")
    return events.select(
        eid.alias("trade_id"),
        (F.lit(1.0) + F.col("value") / 100000).alias("price"),
        (F.lit(100.0) + (F.col("user_id") % 20)).alias("qty"),
        time.alias("time"),
        (F.col("user_id") % 2 == 1).alias("is_sell"),
    )


def bronze_dirty(events: DataFrame) -> DataFrame:
    """Typed bronze with bad prices, quantities, dates, NULL flags and duplicate ids."""
    eid = F.col("event_id")
    b = events.select(
        eid.alias("trade_id"),
        F.when(eid % 500 == 0, F.lit(None).cast("double"))
        .when(eid % 500 == 1, -F.col("value"))
        .otherwise(F.col("value"))
        .alias("price"),
        F.when(eid % 400 == 2, F.lit(0.0)).otherwise(F.lit(1.0) + F.col("user_id") % 10).alias("qty"),
        F.when(eid % 200 == 7, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")).alias("trade_time"),
        F.when(eid % 300 == 3, F.lit(None).cast("boolean"))
        .otherwise(F.col("user_id") % 2 == 0)
        .alias("is_buyer_maker"),
        F.to_date("ts").alias("trade_date"),
    )
    return b.unionByName(b.where(F.col("trade_id") % 100 == 50))


def bronze_text(dirty: DataFrame) -> DataFrame:
    """``bronze_dirty`` rendered as landing text, as the bronze layer holds it.

    ``quote_qty`` = price * qty; ``time`` = epoch µs of ``trade_time``.
    """
    return dirty.select(
        F.col("trade_id").cast("string").alias("trade_id"),
        F.col("price").cast("string").alias("price"),
        F.col("qty").cast("string").alias("qty"),
        (F.col("price") * F.col("qty")).cast("string").alias("quote_qty"),
        to_epoch_us("trade_time").cast("string").alias("time"),
        F.col("is_buyer_maker").cast("string").alias("is_buyer_maker"),
        F.lit("true").alias("is_best_match"),
        F.lit("fixture").alias("_source_file"),
        F.col("trade_date"),
    )
