"""Spark SQL views over a layout, named like the warehouse tables.

    register_views(spark, Layout(root))
    spark.sql("SELECT COUNT(*) FROM fact_trades WHERE processed_date = DATE'2026-04-13'")

The fact views are the versions valid when they are made, of one commit for all three; make the
views again to see a later one. Filters on the day columns prune partitions and the star joins
(fact -> dim_date on ``date_id``) are planned by Catalyst like any other join.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradewatch.plans.daily_run import Layout, facts_at
from tradewatch.schemas import BRONZE, FACTS, OHLCV, PUMP_DUMP, SILVER_STORED, WASH_PAIRS
from tradewatch.sources.calendar import read_calendar
from tradewatch.sources.layers import has_files, read_days
from tradewatch.sources.manifest import load_manifest


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Create (or replace) a temp view per existing table; returns the view names."""
    layers = {
        "bronze_trades": (layout.bronze, BRONZE, "trade_date"),
        "silver_trades": (layout.silver, SILVER_STORED, "processed_date"),
        "ohlcv_5min": (layout.ohlcv, OHLCV, "trade_date"),
        "pump_dump_signals": (layout.pump, PUMP_DUMP, "trade_date"),
        "wash_trade_signals": (layout.wash, WASH_PAIRS, "trade_date"),
    }
    made = {}
    for name, (path, schema, day_col) in layers.items():
        if has_files(spark, path):
            made[name] = read_days(spark, path, day_col, schema=schema)
    if has_files(spark, layout.dw("dim_date")):
        made["dim_date"] = read_calendar(spark, layout.dw("dim_date"))
    manifest = load_manifest(spark, layout.manifest)
    for table in FACTS if manifest.number else ():
        made[table] = facts_at(spark, layout, manifest, table)
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return list(made)
