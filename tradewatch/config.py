"""Thresholds of every operator, as frozen dataclasses.

Defaults reproduce the behaviour of the surveyed daily pipeline ("as coded");
options that fix one of its known traps are off by default and named after it.

Fixed values (defaults that must equal the surveyed pipeline's for equal
results): minimum rows 100,000; invalid price, invalid quantity and
out-of-range rates at most 1 %, 1 %, 5 %; candle width 5 minutes; pump at
+10 % with volume at least 2.5 x the rolling average over candles -3..+3;
look-ahead 12 candles; dump at -7 %; severity HIGH from 20 %, MEDIUM from
10 %; wash time difference below 1000, price difference below 0.1 %,
quantity similarity above 90 %; score weights 0.40 / 0.35 / 0.25; pairs kept
from score 0.8, high confidence from 0.95; one-second buckets.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CleanConfig:
    """Bronze -> silver cleaning."""

    # Rows with NaN price/qty pass ``> 0`` in Spark; keep them unless asked.
    reject_nan: bool = False
    # Day column of the bronze partition.
    day_col: str = "trade_date"


@dataclass(frozen=True)
class DQConfig:
    """Data-quality gates (Q1-Q6); all rate thresholds are strict ``>``."""

    min_rows: int = 100_000
    max_invalid_price_rate: float = 0.01
    max_invalid_qty_rate: float = 0.01
    max_out_of_range_rate: float = 0.05


@dataclass(frozen=True)
class CandleConfig:
    """OHLCV candles."""

    width: str = "5 minutes"


@dataclass(frozen=True)
class PumpConfig:
    """Pump-and-dump detection on candles."""

    min_pump_pct: float = 10.0
    volume_multiple: float = 2.5
    # Rolling-average frame in candles relative to the current one (centred, T4).
    avg_frame: tuple[int, int] = (-3, 3)
    lookahead_candles: int = 12
    max_dump_pct: float = -7.0
    high_severity_pct: float = 20.0
    medium_severity_pct: float = 10.0


@dataclass(frozen=True)
class WashConfig:
    """Wash-trade pair detection (C4).

    ``time_unit_divisor`` turns the raw epoch-microsecond difference into the
    unit compared against ``max_time_diff``: 1 keeps the surveyed code's
    behaviour (pairs < 1000 µs apart), 1000 the documented one (< 1000 ms).
    ``exact`` drops the same-second restriction (J1b) so pairs straddling a
    second boundary are found too.
    """

    time_unit_divisor: int = 1
    max_time_diff: float = 1000.0
    max_price_diff_pct: float = 0.1
    min_qty_similarity_pct: float = 90.0
    min_score: float = 0.8
    high_confidence_score: float = 0.95
    time_weight: float = 0.40
    price_weight: float = 0.35
    qty_weight: float = 0.25
    exact: bool = False
    # Second-bucket width of the same-bucket join, in raw time units (µs).
    bucket_width: int = 1_000_000
    # Width of the time cells in raw units; any width of at least twice the
    # time band is exact. ``None``: twice the band, but no less than
    # ``min_time_cell`` so sparse seconds do not split into one-row cells.
    time_cell: int | None = None
    min_time_cell: int = 10_000
    # Join cells with more buy x sell pairs than this are dealt out over several tasks, which costs
    # a count of the trades per second first; ``None`` leaves them to the join as they are. The
    # daily run sets it.
    hot_cell_pairs: int | None = None
    # Value dimensions also cut into band cells: "auto" adds ``qty`` whenever
    # the time cells are a bucket or wider (documented unit, J1 and J1b).
    value_bands: tuple[str, ...] | str = "auto"
