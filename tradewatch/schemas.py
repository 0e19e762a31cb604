"""Table schemas and the warehouse contract.

Output frames are always projected in the order given here, so an empty
result and a non-empty one carry the same columns (S8).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Column names and order of a landing trade file (header-less CSV).
LANDING_COLUMNS = ["trade_id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match"]

LANDING = StructType([StructField(c, StringType(), True) for c in LANDING_COLUMNS])
LANDING_DDL = ", ".join(f"{c} STRING" for c in LANDING_COLUMNS)

BRONZE = StructType(
    LANDING.fields
    + [
        StructField("_source_file", StringType(), True),
        StructField("_ingested_at", TimestampNTZType(), True),
        StructField("trade_date", DateType(), True),
    ]
)

# The cleaned trade table's column names and types, as its consumers read them.
SILVER = StructType(
    [
        StructField("trade_id", LongType(), True),
        StructField("price", DoubleType(), True),
        StructField("qty", DoubleType(), True),
        StructField("quote_qty", DoubleType(), True),
        StructField("time", LongType(), True),
        StructField("is_buyer_maker", BooleanType(), True),
        StructField("is_best_match", BooleanType(), True),
        StructField("trade_time", TimestampNTZType(), True),
        StructField("trade_hour", IntegerType(), True),
        StructField("trade_minute", IntegerType(), True),
        StructField("is_sell", BooleanType(), True),
        StructField("usd_value", DoubleType(), True),
        StructField("processed_date", DateType(), True),
    ]
)

# Silver as stored: the typed columns plus the bronze lineage columns.
SILVER_STORED = StructType(
    SILVER.fields
    + [StructField("_source_file", StringType(), True), StructField("_ingested_at", TimestampNTZType(), True)]
)

# The gold candle table's column names, as its consumers read them.
OHLCV = StructType(
    [
        StructField("open", DoubleType(), True),
        StructField("high", DoubleType(), True),
        StructField("low", DoubleType(), True),
        StructField("close", DoubleType(), True),
        StructField("volume_pepe", DoubleType(), True),
        StructField("volume_usdt", DoubleType(), True),
        StructField("trade_count", LongType(), False),
        StructField("buyer_initiated_count", LongType(), False),
        StructField("seller_initiated_count", LongType(), False),
        StructField("window_start", TimestampNTZType(), True),
        StructField("window_end", TimestampNTZType(), True),
        StructField("buy_sell_ratio", DoubleType(), True),
        StructField("trade_date", DateType(), True),
    ]
)

# The pump-and-dump table's column names, types and order.
PUMP_DUMP = StructType(
    [
        StructField("pump_window_start", TimestampNTZType(), True),
        StructField("pump_window_end", TimestampNTZType(), True),
        StructField("price_at_pump_start", DoubleType(), True),
        StructField("price_at_peak", DoubleType(), True),
        StructField("price_after_dump", DoubleType(), True),
        StructField("pump_pct", DoubleType(), True),
        StructField("dump_pct", DoubleType(), True),
        StructField("volume_usdt_during_pump", DoubleType(), True),
        StructField("estimated_profit_pct", DoubleType(), True),
        StructField("severity", StringType(), True),
        StructField("trade_date", DateType(), True),
        StructField("processed_date", DateType(), True),
    ]
)

# The wash-pair table's column names, types and order.
WASH_PAIRS = StructType(
    [
        StructField("trade_date", DateType(), True),
        StructField("buy_trade_id", LongType(), True),
        StructField("sell_trade_id", LongType(), True),
        StructField("time_diff_ms", LongType(), True),
        StructField("price_diff_pct", DoubleType(), True),
        StructField("qty_similarity_pct", DoubleType(), True),
        StructField("wash_score", DoubleType(), True),
        StructField("processed_date", DateType(), True),
    ]
)

# The calendar dimension's column names, types and order.
DIM_DATE = StructType(
    [
        StructField("date_id", IntegerType(), False),
        StructField("full_date", DateType(), False),
        StructField("year", IntegerType(), False),
        StructField("month", IntegerType(), False),
        StructField("day_of_month", IntegerType(), False),
        StructField("day_of_week", IntegerType(), False),
        StructField("is_weekend", BooleanType(), False),
    ]
)

# The time-window dimension's column names, types and order.
DIM_TIME_WINDOW = StructType(
    [
        StructField("window_id", LongType(), False),
        StructField("window_start", TimestampNTZType(), False),
        StructField("window_end", TimestampNTZType(), False),
        StructField("window_size_minutes", IntegerType(), False),
        StructField("hour_of_day", IntegerType(), False),
    ]
)

# The warehouse contract — column order, NOT NULL and decimal scale
# of each fact table. ``None`` keeps the Spark type.
FACT_TRADES_CONTRACT: list[tuple[str, DecimalType | None]] = [
    ("trade_id", None),
    ("date_id", None),
    ("price", DecimalType(20, 10)),
    ("qty", DecimalType(20, 8)),
    ("quote_qty", DecimalType(20, 8)),
    ("trade_time", None),
    ("is_buyer_maker", None),
    ("is_sell", None),
    ("usd_value", DecimalType(20, 8)),
    ("trade_hour", None),
    ("processed_date", None),
]

FACT_PUMP_DUMP_CONTRACT: list[tuple[str, DecimalType | None]] = [
    ("trade_date", None),
    ("pump_window_start", None),
    ("pump_window_end", None),
    ("price_at_pump_start", DecimalType(20, 10)),
    ("price_at_peak", DecimalType(20, 10)),
    ("price_after_dump", DecimalType(20, 10)),
    ("pump_pct", DecimalType(10, 4)),
    ("dump_pct", DecimalType(10, 4)),
    ("volume_usdt_during_pump", DecimalType(20, 8)),
    ("estimated_profit_pct", DecimalType(10, 4)),
    ("severity", None),
    ("processed_date", None),
]

FACT_WASH_CONTRACT: list[tuple[str, DecimalType | None]] = [
    ("trade_date", None),
    ("buy_trade_id", None),
    ("sell_trade_id", None),
    ("time_diff_ms", None),
    ("price_diff_pct", DecimalType(10, 6)),
    ("qty_similarity_pct", DecimalType(10, 4)),
    ("wash_score", DecimalType(5, 4)),
    ("processed_date", None),
]



def _fact_schema(contract: list[tuple[str, DecimalType | None]], source: StructType) -> StructType:
    """A fact table's stored schema: the contract's decimals, else the source column's type."""
    types = {f.name: f.dataType for f in source.fields} | {"date_id": IntegerType()}
    return StructType([StructField(c, t or types[c], True) for c, t in contract])


# Fact table -> (day column, stored schema).
FACTS: dict[str, tuple[str, StructType]] = {
    "fact_trades": ("processed_date", _fact_schema(FACT_TRADES_CONTRACT, SILVER)),
    "fact_pump_dump_events": ("trade_date", _fact_schema(FACT_PUMP_DUMP_CONTRACT, PUMP_DUMP)),
    "fact_wash_trade_pairs": ("trade_date", _fact_schema(FACT_WASH_CONTRACT, WASH_PAIRS)),
}

# Allowed severities of fact_pump_dump_events.
SEVERITIES = ["HIGH", "MEDIUM", "LOW"]


def project_to(df: DataFrame, schema: StructType, *extra: Column) -> DataFrame:
    """Select ``schema``'s columns in its order, cast to its types, then ``extra``."""
    cols: list[Column] = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *extra)


def symbol_keys(df: DataFrame) -> list[str]:
    """``["symbol"]`` if ``df`` carries a symbol, which then belongs to every key; else no key."""
    return ["symbol"] if "symbol" in df.columns else []
