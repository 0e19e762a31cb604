"""tradewatch: market-surveillance tables from exchange trade prints, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function whose thresholds are
parameters (see :mod:`tradewatch.config`). I/O lives in :mod:`tradewatch.sources`,
composite runs in :mod:`tradewatch.plans`.
"""

from tradewatch.config import CandleConfig, CleanConfig, DQConfig, PumpConfig, WashConfig
from tradewatch.operators.candles import ohlcv
from tradewatch.operators.clean import clean_trades, dedup_trades, typed_trades
from tradewatch.operators.dq import dq_report, enforce, step_counts
from tradewatch.operators.pump import lookahead_join, pump_candles, pump_dump
from tradewatch.operators.wash import wash_candidates, wash_pairs, wash_tiers

__all__ = [
    "CandleConfig",
    "CleanConfig",
    "DQConfig",
    "PumpConfig",
    "WashConfig",
    "clean_trades",
    "dedup_trades",
    "dq_report",
    "enforce",
    "lookahead_join",
    "ohlcv",
    "pump_candles",
    "pump_dump",
    "step_counts",
    "typed_trades",
    "wash_candidates",
    "wash_pairs",
    "wash_tiers",
]
