"""Registered queries and their DuckDB oracle SQL.

Each query reads the given tables at ``sf_dir`` (only ``events`` has
trade-like timing; see FIXTURES.md) and runs one operator of the library over
all of it. Floating results that are sums, averages or ratios are rounded to
6 decimals on both sides, after every threshold was applied to the unrounded
value; decimal warehouse columns are compared as doubles after the cast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewatch.config import DQConfig, WashConfig
from tradewatch.operators import candles as C
from tradewatch.operators import clean as CL
from tradewatch.operators import dq as DQ
from tradewatch.operators import pump as P
from tradewatch.operators import staged as ST
from tradewatch.operators import warehouse as WH
from tradewatch.operators import wash as W
from tradewatch.sources import calendar as CAL
from tradewatch.sources import facts as FT
from tradewatch.sources import fixtures as FX
from tradewatch.sources import landing as LD
from tradewatch.sources import layers as LY
from tradewatch.sources import manifest as MF
from tradewatch.functions import date_id, epoch_us_to_ts, to_epoch_us
from tradewatch.plans import daily_run as DR
from tradewatch.schemas import DIM_DATE, PUMP_DUMP
from tradewatch.session import scratch_path

R = 6


def _r(c: str) -> F.Column:
    return F.round(F.col(c), R).alias(c)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.read_table(spark, sf_dir, "events")


def _candles(spark, sf_dir):
    return C.ohlcv(FX.trades_sparse(_events(spark, sf_dir)))


def _dirty_typed(spark, sf_dir):
    return CL.typed_trades(FX.bronze_text(FX.bronze_dirty(_events(spark, sf_dir))))


def _silver(spark, sf_dir):
    return CL.clean_trades(FX.bronze_text(FX.bronze_dirty(_events(spark, sf_dir))))


def _dense(spark, sf_dir):
    return FX.trades_dense(_events(spark, sf_dir))


# ---------------------------------------------------------------- cleaning
def q_clean_trades(spark, sf_dir):
    return _silver(spark, sf_dir).drop("_source_file")


def q_clean_step_counts(spark, sf_dir):
    return DQ.step_counts(_dirty_typed(spark, sf_dir))


def q_dedup_trades(spark, sf_dir):
    return CL.dedup_trades(FX.bronze_dirty(_events(spark, sf_dir)))


def q_time_enrichment(spark, sf_dir):
    t = FX.trades_sparse(_events(spark, sf_dir)).withColumn("time", to_epoch_us("trade_time"))
    t = CL.enrich(t.withColumn("trade_time", epoch_us_to_ts("time")))
    return t.select("trade_id", "time", "trade_time", "trade_hour", "trade_minute", "is_sell", "usd_value")


def q_dq_report(spark, sf_dir):
    return DQ.dq_report(_dirty_typed(spark, sf_dir))


# ---------------------------------------------------------------- candles
def q_ohlcv_5min(spark, sf_dir):
    c = _candles(spark, sf_dir)
    return c.select(*[_r(x) if x in ("volume_pepe", "volume_usdt", "buy_sell_ratio") else F.col(x) for x in c.columns])


def q_side_counts(spark, sf_dir):
    c = C.ohlcv(CL.enrich(_dirty_typed(spark, sf_dir)))
    return c.select("trade_date", "window_start", "trade_count", "buyer_initiated_count", "seller_initiated_count", _r("buy_sell_ratio"))


# ---------------------------------------------------------------- pump & dump
def q_candle_change(spark, sf_dir):
    f = P.candle_features(_candles(spark, sf_dir))
    return f.select("trade_date", "window_start", "close", "prev_close", _r("pct_change"))


def q_rolling_volume(spark, sf_dir):
    f = P.candle_features(_candles(spark, sf_dir))
    return f.select("trade_date", "window_start", _r("volume_usdt"), _r("avg_volume"))


def q_pump_candles(spark, sf_dir):
    f = P.pump_candles(_candles(spark, sf_dir))
    return f.select("trade_date", "window_start", "close", "prev_close", _r("pct_change"), _r("volume_usdt"), _r("avg_volume"))


def q_lookahead_min(spark, sf_dir):
    f = P.candle_features(_candles(spark, sf_dir))
    return f.select("trade_date", "window_start", "close", "lookahead_min_close")


def q_lookahead_join(spark, sf_dir):
    j = P.lookahead_join(_candles(spark, sf_dir))
    return j.select("trade_date", "window_start", "close", _r("pct_change"), "price_after_dump")


def _round_events(ev: DataFrame) -> DataFrame:
    rnd = {"pump_pct", "dump_pct", "volume_usdt_during_pump", "estimated_profit_pct"}
    return ev.select(*[_r(c) if c in rnd else F.col(c) for c in ev.columns])


def q_pump_dump_events(spark, sf_dir):
    return _round_events(P.pump_dump(_candles(spark, sf_dir)))


def q_severity_counts(spark, sf_dir):
    ev = P.pump_dump(_candles(spark, sf_dir))
    return ev.groupBy("trade_date", "severity").agg(F.count(F.lit(1)).alias("events"))


# ---------------------------------------------------------------- wash trades
def _round_pairs(p: DataFrame) -> DataFrame:
    rnd = {"price_diff_pct", "qty_similarity_pct", "wash_score"}
    return p.select(*[_r(c) if c in rnd else F.col(c) for c in p.columns])


def q_wash_candidates(spark, sf_dir):
    return _round_pairs(W.wash_candidates(_dense(spark, sf_dir), WashConfig()))


def q_wash_pairs(spark, sf_dir):
    return _round_pairs(W.wash_pairs(_dense(spark, sf_dir), WashConfig()))


def q_wash_pairs_documented_unit(spark, sf_dir):
    return _round_pairs(W.wash_pairs(_dense(spark, sf_dir), WashConfig(time_unit_divisor=1000)))


def q_wash_pairs_exact(spark, sf_dir):
    return _round_pairs(W.wash_pairs(_dense(spark, sf_dir), WashConfig(exact=True)))


def q_wash_pairs_exact_documented_unit(spark, sf_dir):
    return _round_pairs(W.wash_pairs(_dense(spark, sf_dir), WashConfig(exact=True, time_unit_divisor=1000)))


def q_wash_tiers(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    parts = []
    for div in (1, 1000):
        cfg = WashConfig(time_unit_divisor=div)
        parts.append(W.wash_tiers(W.wash_pairs(dense, cfg), cfg).withColumn("time_unit_divisor", F.lit(div)))
    out = parts[0].unionByName(parts[1])
    return out.select("trade_date", "time_unit_divisor", "pairs", "high_confidence_pairs")


# ---------------------------------------------------------------- warehouse
def q_dim_date(spark, sf_dir):
    return WH.dim_date_span(FX.trades_sparse(_events(spark, sf_dir)), "trade_date")


def q_dim_date_upsert(spark, sf_dir):
    existing = WH.dim_date_for(FX.trades_sparse(_events(spark, sf_dir)), "trade_date")
    new = WH.dim_date_for(FX.bronze_dirty(_events(spark, sf_dir)).select(F.to_date("trade_time").alias("d")), "d")
    return WH.dim_date_upsert(existing, new)


def q_dim_time_window(spark, sf_dir):
    return WH.dim_time_window(FX.trades_sparse(_events(spark, sf_dir)), "trade_date")


def _as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields])


def q_fact_trades(spark, sf_dir):
    return _as_double(WH.fact_trades(_silver(spark, sf_dir)))


def q_fact_trades_contract(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    # Ids that come again a day later and prices too large for the warehouse's decimals.
    again = silver.where(F.col("trade_id") % 90 == 11).withColumn("processed_date", F.date_add("processed_date", 1))
    large = F.when(F.col("trade_id") % 700 == 5, F.lit(1e11)).otherwise(F.col("price"))
    bad = silver.withColumn("price", large).unionByName(again)
    v = WH.contract_violations(WH.fact_trades(bad), "processed_date", key="trade_id")
    return v.select(
        "processed_date", "rows", "null_violations", F.col("nulls")["is_sell"].alias("null_sides"),
        F.col("nulls")["price"].alias("null_prices"), "duplicate_keys",
    )


def q_fact_pump_dump(spark, sf_dir):
    return _as_double(WH.fact_pump_dump(P.pump_dump(_candles(spark, sf_dir))))


def q_fact_wash_pairs(spark, sf_dir):
    return _as_double(WH.fact_wash_pairs(W.wash_pairs(_dense(spark, sf_dir), WashConfig())))


def q_orphan_dates(spark, sf_dir):
    dim = WH.dim_date_span(FX.trades_sparse(_events(spark, sf_dir)), "trade_date")
    # A calendar with holes.
    return WH.orphan_dates(WH.fact_trades(_silver(spark, sf_dir)), dim.where(F.col("day_of_month") % 5 != 0))


def q_dw_counts(spark, sf_dir):
    days = WH.dim_date_span(FX.trades_sparse(_events(spark, sf_dir)), "trade_date").select(F.col("full_date").alias("trade_date"))
    return WH.dw_counts(
        WH.fact_trades(_silver(spark, sf_dir)),
        P.pump_dump(_candles(spark, sf_dir)),
        W.wash_pairs(_dense(spark, sf_dir), WashConfig()),
        days,
    )


# ---------------------------------------------------------------- landing and sinks
def _landing_rows(spark, sf_dir) -> DataFrame:
    return FX.trades_sparse(_events(spark, sf_dir)).select(
        "trade_id", "price", "qty", (F.col("price") * F.col("qty")).alias("quote_qty"),
        to_epoch_us("trade_time").alias("time"), "is_buyer_maker", F.lit(True).alias("is_best_match"), "trade_date",
    )


def _landing(spark, sf_dir, days=None) -> str:
    """Write the landing zips of ``trades_sparse`` to a fresh scratch folder, of the ``days`` that a condition names."""
    rows = _landing_rows(spark, sf_dir)
    rows = rows if days is None else rows.where(days)
    landing = scratch_path(spark, "landing")
    LD.write_landing(rows, landing, scratch_path(spark, "landing-staging"))
    return landing


def q_missing_days(spark, sf_dir):
    landing = _landing(spark, sf_dir, F.dayofmonth("trade_date") % 7 != 3)
    days = WH.dim_date_span(FX.trades_sparse(_events(spark, sf_dir)), "trade_date").select(F.col("full_date").alias("trade_date"))
    return LD.landing_inventory(spark, landing, days).select("trade_date", "found")


def q_zip_ingest(spark, sf_dir):
    bronze = LD.read_landing(spark, _landing(spark, sf_dir))
    typed = CL.typed_trades(bronze)
    # Stamped in UTC, whatever the session's zone.
    age = F.timestamp_diff("SECOND", F.col("_ingested_at"), F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp()))
    return typed.select(
        "trade_id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match", "trade_time", "_source_file",
        "symbol", "trade_date", (F.abs(age) < 3600).alias("stamped"),
    )


def q_day_overwrite(spark, sf_dir):
    candles = _candles(spark, sf_dir)
    root = scratch_path(spark, "gold-ohlcv")
    days = [r.trade_date for r in candles.select("trade_date").distinct().collect()]  # one row per day
    LY.replace_days(candles, root, "trade_date", days, sort_within=["window_start"])
    # Re-run two days; the second one now finds nothing and must end up empty.
    d1, d2 = sorted(days)[len(days) // 2], sorted(days)[len(days) // 2 + 1]
    LY.replace_days(candles.where(F.col("trade_date") == d1), root, "trade_date", [d1, d2])
    back = spark.read.parquet(root)
    return back.groupBy("trade_date").agg(F.count(F.lit(1)).alias("candles"))


# ---------------------------------------------------------------- calendar, reads by day, the load
def q_dim_date_seed(spark, sf_dir):
    """400 calendar days from the first trade's day, none after the year."""
    first = FX.trades_sparse(_events(spark, sf_dir)).agg(F.min("trade_date")).first()[0]  # one value
    return WH.dim_date(spark, first, WH.SEED_DAYS, first.replace(month=12, day=31))


def q_day_reads(spark, sf_dir):
    """Every second day of a written layer, by partition pruning."""
    t = FX.trades_sparse(_events(spark, sf_dir))
    root = scratch_path(spark, "silver-days")
    LY.replace_days(t, root, "trade_date", None)
    days = [r.trade_date for r in t.select("trade_date").distinct().collect() if r.trade_date.day % 2 == 0]  # calendar days
    return LY.read_days(spark, root, "trade_date", days).groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("trade_id").alias("ids")
    )


def q_empty_day(spark, sf_dir):
    """A pump table whose every day found nothing is read with its schema: no rows on any day."""
    t = FX.trades_sparse(_events(spark, sf_dir))
    days = [r.trade_date for r in t.select("trade_date").distinct().collect()]  # calendar days
    root = scratch_path(spark, "gold-pump")
    LY.replace_days(P.pump_dump(_candles(spark, sf_dir)), root, "trade_date", days)
    LY.replace_days(P.pump_dump(_candles(spark, sf_dir)).where(F.lit(False)), root, "trade_date", days)
    left = LY.read_days(spark, root, "trade_date", days, schema=PUMP_DUMP)
    per_day = t.select("trade_date").distinct().join(left.groupBy("trade_date").agg(F.count(F.lit(1)).alias("rows")), "trade_date", "left")
    return per_day.fillna(0, ["rows"])


def q_warehouse_load(spark, sf_dir):
    """The whole run from landing archives to the star schema, read back through its calendar."""
    base = scratch_path(spark, "warehouse-load")
    layout = DR.Layout(base)
    rows = _landing_rows(spark, sf_dir)
    LD.write_landing(rows, layout.landing, base + "/staging")
    days = [r.trade_date for r in rows.select("trade_date").distinct().collect()]  # calendar days
    DR.run_days(spark, layout, days)
    dim = CAL.read_calendar(spark, layout.dw("dim_date"))
    trades = DR.read_facts(spark, layout, "fact_trades").groupBy("date_id").agg(
        F.count(F.lit(1)).alias("trades"), F.round(F.sum(F.col("usd_value").cast("double")), 4).alias("usd")
    )
    pumps = DR.read_facts(spark, layout, "fact_pump_dump_events").groupBy(date_id("trade_date").alias("date_id")).agg(F.count(F.lit(1)).alias("pumps"))
    return trades.join(dim.select("date_id", "day_of_week"), "date_id").join(pumps, "date_id", "left").fillna(0, ["pumps"])


# ---------------------------------------------------------------- two symbols
def _two_symbols(spark, sf_dir):
    """Two symbols that share ids and days: the second at twice the price and half the quantity."""
    one = FX.trades_sparse(_events(spark, sf_dir))
    two = one.where(F.col("trade_id") % 3 != 0).withColumns({"price": F.col("price") * 2, "qty": F.col("qty") / 2})
    return one.withColumn("symbol", F.lit("AAAUSDT")).unionByName(two.withColumn("symbol", F.lit("BBBUSDT")))


def _both(df):
    return df.withColumn("symbol", F.lit("AAAUSDT")).unionByName(df.withColumn("symbol", F.lit("BBBUSDT")))


def q_symbols_dedup(spark, sf_dir):
    t = _two_symbols(spark, sf_dir)
    kept = CL.dedup_trades(t.unionByName(t.where(F.col("trade_id") % 7 == 0)), first=("trade_time",))
    return kept.groupBy("symbol", "trade_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("trade_id").alias("ids"), F.round(F.sum("price"), 4).alias("price_sum")
    )


def q_symbols_candles(spark, sf_dir):
    c = C.ohlcv(_two_symbols(spark, sf_dir))
    return c.select(
        "symbol", "window_start", "open", "close", "high", "low", F.round("volume_pepe", 6).alias("volume"),
        F.col("trade_count").alias("trades"),
    )


def q_symbols_pump(spark, sf_dir):
    """The same candles under two symbols: windows must not run from one into the other."""
    events = P.pump_dump(_both(_candles(spark, sf_dir)))
    return events.groupBy("symbol").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("pump_pct"), 6).alias("pump_sum"))


def q_symbols_wash(spark, sf_dir):
    """The same trades under two symbols: each symbol's own pairs and none across."""
    pairs = W.wash_pairs(_both(_dense(spark, sf_dir)), WashConfig())
    return pairs.select("symbol", "trade_date", "buy_trade_id", "sell_trade_id", F.round("wash_score", 6).alias("wash_score"))


# ---------------------------------------------------------------- publishing, commits, registry
def _days_of(df: DataFrame) -> list:
    return sorted(r.trade_date for r in df.select("trade_date").distinct().collect())  # calendar days


def q_staged_audit(spark, sf_dir):
    """DQ measures and step counts as the staged cleaning carries them."""
    return ST.staged_measures(ST.audited_trades(FX.bronze_text(FX.bronze_dirty(_events(spark, sf_dir)))))


def q_silver_publish(spark, sf_dir):
    """Silver after one run that passes its gates and one, of half the trades at a bad price, that does not."""
    layout = DR.Layout(scratch_path(spark, "publish"))
    bronze = FX.bronze_text(FX.bronze_dirty(_events(spark, sf_dir))).withColumn("_ingested_at", F.lit(None).cast("timestamp_ntz"))
    days = _days_of(bronze)
    open_gates = DQConfig(max_invalid_price_rate=1.0, max_invalid_qty_rate=1.0, max_out_of_range_rate=1.0)
    DR.write_bronze(bronze, layout, days)
    DR.bronze_to_silver(spark, layout, days, DR.RunConfig(dq=open_gates))
    DR.write_bronze(bronze.withColumn("price", F.when(F.col("trade_id").cast("long") % 2 == 0, F.lit("0")).otherwise(F.col("price"))), layout, days)
    refused = False
    try:
        DR.bronze_to_silver(spark, layout, days, DR.RunConfig(dq=DQConfig(max_invalid_qty_rate=1.0, max_out_of_range_rate=1.0)))
    except DQ.DataQualityError:
        refused = True
    silver = spark.read.parquet(layout.silver)
    return silver.groupBy("processed_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("trade_id").alias("ids"), F.round(F.sum("price"), 4).alias("prices")
    ).withColumn("refused", F.lit(refused))


def _loaded_layout(spark, sf_dir, name: str) -> tuple:
    """A layout whose silver and events are those of ``trades_sparse``, loaded once; and its days."""
    layout = DR.Layout(scratch_path(spark, name))
    bronze = _landing_rows(spark, sf_dir).withColumns(
        {"_source_file": F.lit("fixture"), "_ingested_at": F.lit(None).cast("timestamp_ntz")}
    )
    days = _days_of(bronze)
    silver = CL.clean_trades(bronze)
    LY.replace_days(silver, layout.silver, "processed_date", days)
    cfg = DR.RunConfig()
    for stage in (DR.candles_stage, DR.pump_stage, DR.wash_stage):
        stage(spark, layout, days, cfg)
    DR.load_warehouse(spark, layout, days, cfg)
    return layout, days


def q_facts_by_commit(spark, sf_dir):
    """Facts by the commit log: the load's, though a later load wrote half the trades again and died before its commit."""
    layout, days = _loaded_layout(spark, sf_dir, "commits")
    manifest = MF.load_manifest(spark, layout.manifest)
    half = DR.facts_at(spark, layout, manifest, "fact_trades").where("trade_id % 2 = 0")
    FT.write_version(half, layout.dw("fact_trades"), "processed_date", manifest.next_version())
    trades = DR.read_facts(spark, layout, "fact_trades", days).groupBy(F.col("processed_date").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("trades"), F.sum("trade_id").alias("ids")
    )
    pumps = DR.read_facts(spark, layout, "fact_pump_dump_events", days).groupBy("trade_date").agg(F.count(F.lit(1)).alias("pumps"))
    keys = spark.createDataFrame([(e.day, e.keys[0]) for e in manifest.entries.values()], "day string, keys long")  # one a day
    keys = keys.select(F.col("day").cast("date").alias("trade_date"), "keys")
    return trades.join(pumps, "trade_date", "left").fillna(0, ["pumps"]).join(keys, "trade_date")


def q_loaded_keys(spark, sf_dir):
    """Trade ids of each day that the registry of other trades has: every seventh, and many beyond the last."""
    t = FX.trades_sparse(_events(spark, sf_dir)).select("trade_id", F.col("trade_date").alias("processed_date"))
    far = t.select((F.col("trade_id") + 10_000_000).alias("trade_id"), "processed_date")
    known = WH.key_words(t.where("trade_id % 7 = 0").unionByName(far), "processed_date", "trade_id")
    return WH.loaded_keys(WH.key_words(t, "processed_date", "trade_id"), known.drop("processed_date"), "processed_date")


def q_calendar(spark, sf_dir):
    """dim_date after two loads that started from the same empty state."""
    root, days = scratch_path(spark, "dim-date"), _days_of(FX.trades_sparse(_events(spark, sf_dir)))
    loads = [CAL.missing_blocks(spark, root, days), CAL.missing_blocks(spark, root, days[1:])]
    for new in loads:
        CAL.write_blocks(new, root)
    return spark.read.parquet(root).select(*DIM_DATE.names)


def q_symbols_warehouse(spark, sf_dir):
    """Two archives a day, from landing to facts per symbol; then the second symbol again with half its trades."""
    layout = DR.Layout(scratch_path(spark, "symbols"))
    rows = _landing_rows(spark, sf_dir)
    days = _days_of(rows)
    other = rows.where("trade_id % 3 <> 0").withColumn("price", F.col("price") * 2)
    for s, r in (("AAAUSDT", rows), ("BBBUSDT", other)):
        LD.write_landing(r, layout.landing, f"{layout.root}/staging-{s}", s)
    DR.run_days(spark, layout, days, DR.RunConfig(symbols="all"))
    LD.write_landing(other.where("trade_id % 2 = 0"), layout.landing, f"{layout.root}/staging-again", "BBBUSDT")
    DR.run_days(spark, layout, _days_of(other.where("trade_id % 2 = 0")), DR.RunConfig(symbol="BBBUSDT"))
    return DR.read_facts(spark, layout, "fact_trades").groupBy("symbol", "processed_date").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("trade_id").alias("ids"), F.round(F.sum(F.col("price").cast("double")), 4).alias("prices")
    )


def q_landing_csv(spark, sf_dir):
    """Extracted CSV files, one a day, named as the archives are."""
    folder, parts = scratch_path(spark, "csv"), scratch_path(spark, "csv-parts")
    rows = _landing_rows(spark, sf_dir)
    rows.repartition("trade_date").write.partitionBy("trade_date").option("header", False).csv(parts)
    for day in LY.child_names(spark, parts):
        for part in LY.child_names(spark, f"{parts}/{day}"):
            if part.startswith("part-"):
                LY.rename(spark, f"{parts}/{day}/{part}", f"{folder}/{LD.DEFAULT_SYMBOL}-trades-{day.partition('=')[2]}.csv")
    typed = CL.typed_trades(LD.read_landing_csv(spark, folder))
    return typed.select("trade_id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match", "_source_file", "trade_date")


def q_candle_order(spark, sf_dir):
    """Candles of each day as stored, and how many of them stand in their file before an earlier one (O1)."""
    root = scratch_path(spark, "candle-order")
    LY.replace_days(_candles(spark, sf_dir), root, "trade_date", None, sort_within=["window_start"])
    stored = spark.read.parquet(root).select("trade_date", "window_start", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    late = F.lead("window_start").over(Window.partitionBy("f").orderBy("i")) < F.col("window_start")
    return stored.withColumn("late", late).groupBy("trade_date").agg(F.count(F.lit(1)).alias("candles"), F.count_if("late").alias("out_of_order"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_trades": q_clean_trades,
    "clean_step_counts": q_clean_step_counts,
    "dedup_trades": q_dedup_trades,
    "time_enrichment": q_time_enrichment,
    "dq_report": q_dq_report,
    "ohlcv_5min": q_ohlcv_5min,
    "side_counts": q_side_counts,
    "candle_change": q_candle_change,
    "rolling_volume": q_rolling_volume,
    "pump_candles": q_pump_candles,
    "lookahead_min": q_lookahead_min,
    "lookahead_join": q_lookahead_join,
    "pump_dump_events": q_pump_dump_events,
    "severity_counts": q_severity_counts,
    "wash_candidates": q_wash_candidates,
    "wash_pairs": q_wash_pairs,
    "wash_pairs_documented_unit": q_wash_pairs_documented_unit,
    "wash_pairs_exact": q_wash_pairs_exact,
    "wash_pairs_exact_documented_unit": q_wash_pairs_exact_documented_unit,
    "wash_tiers": q_wash_tiers,
    "dim_date": q_dim_date,
    "dim_date_upsert": q_dim_date_upsert,
    "dim_time_window": q_dim_time_window,
    "fact_trades": q_fact_trades,
    "fact_trades_contract": q_fact_trades_contract,
    "fact_pump_dump": q_fact_pump_dump,
    "fact_wash_pairs": q_fact_wash_pairs,
    "orphan_dates": q_orphan_dates,
    "dw_counts": q_dw_counts,
    "missing_days": q_missing_days,
    "zip_ingest": q_zip_ingest,
    "day_overwrite": q_day_overwrite,
    "dim_date_seed": q_dim_date_seed,
    "day_reads": q_day_reads,
    "empty_day": q_empty_day,
    "warehouse_load": q_warehouse_load,
    "symbols_dedup": q_symbols_dedup,
    "symbols_candles": q_symbols_candles,
    "symbols_pump": q_symbols_pump,
    "symbols_wash": q_symbols_wash,
    "staged_audit": q_staged_audit,
    "silver_publish": q_silver_publish,
    "facts_by_commit": q_facts_by_commit,
    "loaded_keys": q_loaded_keys,
    "calendar": q_calendar,
    "symbols_warehouse": q_symbols_warehouse,
    "landing_csv": q_landing_csv,
    "candle_order": q_candle_order,
}
