import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewatch.functions import to_epoch_us
from tradewatch.plans.daily_run import Layout, run_days
from tradewatch.schemas import WASH_PAIRS
from tradewatch.sources import landing as LD
from tradewatch.sources.fixtures import read_table, trades_sparse
from tradewatch.streaming import landing_trigger

from conftest import SF001


def _landing_rows(spark):
    t = trades_sparse(read_table(spark, SF001, "events"))
    return t.select("trade_id", "price", "qty", (F.col("price") * F.col("qty")).alias("quote_qty"),
                    to_epoch_us("trade_time").alias("time"), "is_buyer_maker", F.lit(True).alias("is_best_match"), "trade_date")


def test_two_days_end_to_end_and_idempotent(spark, tmpdir_run):
    lay = Layout(tmpdir_run)
    rows = _landing_rows(spark)
    LD.write_landing(rows, lay.landing, tmpdir_run + "/staging")
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    out = run_days(spark, lay, days)
    counts = {r["trade_date"]: r for r in out["counts"]}
    want = {r.trade_date: r["count"] for r in rows.where(F.col("trade_date").isin(days)).groupBy("trade_date").count().collect()}
    assert {d: c["fact_trades"] for d, c in counts.items()} == want
    first = sorted(spark.read.parquet(lay.pump).collect())
    assert out["written"]["bronze"] == sum(want.values())
    assert out["written"]["pump_dump_signals"] == len(first)
    assert out["written"]["ohlcv_5min"] == spark.read.parquet(lay.ohlcv).count()
    run_days(spark, lay, days)  # re-run: same tables, no duplicates
    assert sorted(spark.read.parquet(lay.pump).collect()) == first
    # The seeded calendar (S11) and the run's two days, once.
    assert spark.read.parquet(lay.dw("dim_date")).count() == 400 + 2
    assert len(out["warnings"]) == 2 and all("fewer than" in w for w in out["warnings"])
    high = spark.read.schema(WASH_PAIRS).parquet(lay.wash).where("wash_score >= 0.95").count()
    assert set(out["high_confidence_pairs"]) == {"2024-01-01", "2024-01-02"} and sum(out["high_confidence_pairs"].values()) == high
    assert spark.read.parquet(lay.dw("fact_trades")).count() == sum(want.values())


def test_stream_processes_each_archive_once(spark, tmpdir_run):
    lay = Layout(tmpdir_run)
    rows = _landing_rows(spark).where(F.col("trade_date") <= date(2024, 1, 3))
    LD.write_landing(rows, lay.landing, tmpdir_run + "/staging")
    q = landing_trigger.start(spark, lay, tmpdir_run + "/ckpt")
    q.awaitTermination()
    assert spark.read.parquet(lay.dw("fact_trades")).count() == rows.count()
    q2 = landing_trigger.start(spark, lay, tmpdir_run + "/ckpt")
    q2.awaitTermination()
    assert not q2.recentProgress or all(p["numInputRows"] == 0 for p in q2.recentProgress)


def test_day_without_pumps(spark, tmpdir_run):
    lay = Layout(tmpdir_run)
    day1 = _landing_rows(spark).where(F.col("trade_date") == date(2024, 1, 1))
    # the same trades one day later at a flat price: no pump can occur
    day2 = day1.select(
        (F.col("trade_id") + 10_000_000).alias("trade_id"), F.lit(1.0).alias("price"), "qty",
        F.col("qty").alias("quote_qty"), (F.col("time") + 86_400_000_000).alias("time"),
        "is_buyer_maker", "is_best_match", F.lit(date(2024, 1, 2)).alias("trade_date"))
    rows = day1.unionByName(day2)
    LD.write_landing(rows, lay.landing, tmpdir_run + "/staging")
    out = run_days(spark, lay, [date(2024, 1, 1), date(2024, 1, 2)])
    c = {r["trade_date"]: r for r in out["counts"]}
    assert c[date(2024, 1, 1)]["fact_pump_dump_events"] > 0
    assert c[date(2024, 1, 2)]["fact_pump_dump_events"] == 0
    assert c[date(2024, 1, 2)]["fact_trades"] == day2.count()
    # candles exist for both days; the pump table has no folder for day 2
    assert {r.trade_date for r in spark.read.parquet(lay.ohlcv).select("trade_date").distinct().collect()} == {
        date(2024, 1, 1), date(2024, 1, 2)}
    assert not os.path.exists(f"{lay.pump}/trade_date=2024-01-02")


def test_cli_stages(spark, tmpdir_run):
    from tradewatch.__main__ import main

    lay = Layout(tmpdir_run)
    LD.write_landing(_landing_rows(spark).where(F.col("trade_date") == date(2024, 1, 5)), lay.landing, tmpdir_run + "/staging")
    args = ["--root", tmpdir_run, "--ds", "2024-01-05"]
    for stage in ["ingest", "bronze-to-silver", "ohlcv", "pump-dump", "wash-trade", "load"]:
        main([stage, *args])
    counts = main(["validate", *args])["counts"]
    assert counts[0]["fact_trades"] > 0
    with pytest.raises(SystemExit):
        main(["run", "--root", tmpdir_run])


def test_sql_views_over_the_warehouse(spark, tmpdir_run):
    from tradewatch.plans.views import register_views

    lay = Layout(tmpdir_run)
    rows = _landing_rows(spark).where(F.col("trade_date") <= date(2024, 1, 2))
    LD.write_landing(rows, lay.landing, tmpdir_run + "/staging")
    run_days(spark, lay, [date(2024, 1, 1), date(2024, 1, 2)])
    names = register_views(spark, lay)
    assert {"fact_trades", "dim_date", "ohlcv_5min", "fact_pump_dump_events"} <= set(names)
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_trades WHERE processed_date = DATE'2024-01-01'").first().n
    assert n == rows.where(F.col("trade_date") == date(2024, 1, 1)).count()
    star = spark.sql("""
        SELECT d.day_of_week, d.is_weekend, COUNT(*) AS trades, SUM(t.usd_value) AS notional
        FROM fact_trades t JOIN dim_date d ON t.date_id = d.date_id
        GROUP BY d.day_of_week, d.is_weekend""").collect()
    assert len(star) == 2 and sum(r.trades for r in star) == rows.count()


def test_stream_retries_a_failed_batch(spark, tmpdir_run):
    from tradewatch.config import DQConfig
    from tradewatch.plans.daily_run import RunConfig

    lay = Layout(tmpdir_run)
    day = _landing_rows(spark).where(F.col("trade_date") == date(2024, 1, 7))
    bad = day.withColumn("price", F.when(F.col("trade_id") % 10 == 0, F.lit(-1.0)).otherwise(F.col("price")))
    LD.write_landing(bad, lay.landing, tmpdir_run + "/staging")
    strict = landing_trigger.start(spark, lay, tmpdir_run + "/ckpt")
    with pytest.raises(Exception, match="price invalidity"):
        strict.awaitTermination()
    assert not os.path.exists(lay.dw("fact_trades"))
    # same checkpoint, looser gate: the uncommitted batch is retried and now loads
    loose = RunConfig(dq=DQConfig(max_invalid_price_rate=0.5))
    q = landing_trigger.start(spark, lay, tmpdir_run + "/ckpt", cfg=loose)
    q.awaitTermination()
    assert spark.read.parquet(lay.dw("fact_trades")).count() == bad.where("price > 0").count()


def test_contract_stops_the_load(spark, tmpdir_run):
    from tradewatch.operators.warehouse import ContractError
    from tradewatch.plans.daily_run import load_warehouse

    days = [date(2024, 1, 1), date(2024, 1, 2)]
    day1 = _landing_rows(spark).where(F.col("trade_date") == days[0])
    moved = day1.where("trade_id % 2 = 0").select(
        "trade_id", "price", "qty", "quote_qty", (F.col("time") + 86_400_000_000).alias("time"), "is_buyer_maker", "is_best_match",
        F.lit(days[1]).alias("trade_date"))
    cases = {
        "duplicate keys": day1.unionByName(moved),
        "without a valid price": day1.withColumn("price", F.when(F.col("trade_id") % 10 == 0, F.lit(1e11)).otherwise(F.col("price"))),
        "without a valid is_sell": day1.withColumn("is_buyer_maker", F.when(F.col("trade_id") % 10 != 0, F.col("is_buyer_maker"))),
    }
    for n, (message, rows) in enumerate(cases.items()):
        lay = Layout(f"{tmpdir_run}/{n}")
        LD.write_landing(rows, lay.landing, f"{tmpdir_run}/staging-{n}")
        with pytest.raises(ContractError, match=message):
            run_days(spark, lay, sorted({r.trade_date for r in rows.select("trade_date").distinct().collect()}))
        assert not os.path.exists(lay.dw("fact_trades"))
    # An id that an earlier load already has.
    lay = Layout(f"{tmpdir_run}/0")
    load_warehouse(spark, lay, days[:1])
    with pytest.raises(ContractError, match="2024-01-02: [0-9]+ keys are loaded already"):
        load_warehouse(spark, lay, days[1:])
