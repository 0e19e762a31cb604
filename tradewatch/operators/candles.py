"""OHLCV candles (C2: A1-A10, P8, P9).

One aggregate keyed by the tumbling window: Spark runs it as a partial
aggregate per input partition plus a final one after a shuffle of at most one
row per (task, window), so the shuffle is bounded by the number of windows, not
by the number of trades, and a hot window costs no more than a quiet one. Open
and close are ordered by a struct, which no hash buffer holds: it is a sort
aggregate, with a sort by window in each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.config import CandleConfig
from tradewatch.schemas import OHLCV, project_to, symbol_keys


def ohlcv(trades: DataFrame, cfg: CandleConfig = CandleConfig()) -> DataFrame:
    """Candles of ``cfg.width`` from silver trades.

    Needs ``trade_id, price, qty, usd_value, trade_time, is_sell``. Open and close
    are the prices of the first and last trade by ``(trade_time, trade_id)``
    (NULL ids first; price breaks remaining ties), so the result does not
    depend on file or shuffle order (T3). Windows are
    epoch-aligned and ``[start, end)``; a window never spans two days, so the
    day of a candle is the day of its start. With a ``symbol`` column there are
    candles per symbol, and it is the last column.
    """
    own = symbol_keys(trades)
    order = F.struct("trade_time", "trade_id", "price")
    is_sell = F.col("is_sell")
    tid = F.col("trade_id")
    agg = trades.groupBy(*own, F.window("trade_time", cfg.width).alias("w")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("qty").alias("volume_pepe"),
        F.sum("usd_value").alias("volume_usdt"),
        F.count(tid).alias("trade_count"),
        # NULL side counts in neither (T12); NULL trade_id counts nowhere.
        F.count(F.when(~is_sell, tid)).alias("buyer_initiated_count"),
        F.count(F.when(is_sell, tid)).alias("seller_initiated_count"),
    )
    out = agg.select(
        F.to_date(F.col("w.start")).alias("trade_date"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "*",
    ).withColumn(
        # trade_count is 0 when every id of the window is NULL.
        "buy_sell_ratio",
        F.try_divide(F.col("buyer_initiated_count").cast("double"), F.col("trade_count")),
    )
    return project_to(out, OHLCV, *own)
