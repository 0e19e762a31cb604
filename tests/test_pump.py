from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tradewatch.config import PumpConfig
from tradewatch.functions import severity
from tradewatch.operators import pump as P
from tradewatch.operators.candles import ohlcv
from tradewatch.schemas import OHLCV, project_to
from tradewatch.sources.fixtures import read_table, trades_sparse

from conftest import SF001, SF01

DAY = date(2024, 1, 1)


def candles(spark, closes, vols, day=DAY):
    t0 = datetime(day.year, day.month, day.day)
    rows = [
        (day, t0 + timedelta(minutes=5 * i), t0 + timedelta(minutes=5 * (i + 1)), float(c), float(v))
        for i, (c, v) in enumerate(zip(closes, vols))
    ]
    df = spark.createDataFrame(rows, "trade_date date, window_start timestamp_ntz, window_end timestamp_ntz, close double, volume_usdt double")
    df = df.select("*", F.col("close").alias("open"), F.col("close").alias("high"), F.col("close").alias("low"),
                   F.lit(1.0).alias("volume_pepe"), F.lit(1).cast("long").alias("trade_count"),
                   F.lit(1).cast("long").alias("buyer_initiated_count"), F.lit(0).cast("long").alias("seller_initiated_count"),
                   F.lit(1.0).alias("buy_sell_ratio"))
    return project_to(df, OHLCV)


def events(spark, closes, vols):
    c = candles(spark, closes, vols)
    a = sorted(P.pump_dump(c).collect())
    b = sorted(P.pump_dump_join_form(c).collect())
    assert a == b  # window form and join form agree
    return a


def test_pump_thresholds_inclusive(spark):
    closes = [50, 55, 55, 55, 55] + [51] * 12
    vols = [1, 4, 1, 1, 1] + [1] * 12  # avg over rows 0..4 = 1.6; 1.6 * 2.5 = 4.0
    ev = events(spark, closes, vols)
    assert len(ev) == 1
    e = ev[0]
    assert e.pump_pct == 10.0 and e.severity == "MEDIUM" and e.price_at_pump_start == 50 and e.price_at_peak == 55
    assert e.price_after_dump == 51 and e.estimated_profit_pct == e.pump_pct
    assert e.trade_date == DAY and e.processed_date == DAY
    vols[1] = 3.99
    assert events(spark, closes, vols) == []


def test_dump_threshold(spark):
    base = [50, 100, 100, 100, 100]
    vols = [1, 10, 1, 1, 1] + [1] * 12
    assert len(events(spark, base + [93] + [100] * 11, vols)) == 1  # -7.000000000000001
    assert events(spark, base + [93.01] + [100] * 11, vols) == []  # -6.99


def test_last_candle_and_lookahead_horizon(spark):
    # pump on the last candle: no future, no event
    assert events(spark, [50, 50, 50, 100], [1, 1, 1, 10]) == []
    n = 20
    vols = [1, 10] + [1] * n
    on12 = [50, 100] + [100] * 11 + [90] + [100] * (n - 12)
    on13 = [50, 100] + [100] * 12 + [90] + [100] * (n - 13)
    assert len(events(spark, on12, vols)) == 1
    assert events(spark, on13, vols) == []


def test_pct_change_null_cases(spark):
    f = P.candle_features(candles(spark, [0.0, 5.0, 6.0], [1, 1, 1])).orderBy("window_start").collect()
    assert f[0].prev_close is None and f[0].pct_change is None
    assert f[1].prev_close == 0.0 and f[1].pct_change is None
    assert abs(f[2].pct_change - 20.0) < 1e-12


def test_severity_bands(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (19.99,), (20.0,)], "p double")
    assert [r.s for r in df.select(severity("p").alias("s")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_days_are_separate(spark):
    # a pump at the end of day 1 must not look ahead into day 2
    d1 = candles(spark, [50, 50, 100], [1, 1, 10], DAY)
    d2 = candles(spark, [10] * 13, [1] * 13, DAY + timedelta(days=1))
    assert P.pump_dump(d1.unionByName(d2)).count() == 0


def test_fixture_counts(spark):
    c1 = ohlcv(trades_sparse(read_table(spark, SF001, "events")))
    assert P.pump_candles(c1).count() == 75
    ev = P.pump_dump(c1)
    sev = {r.severity: r["count"] for r in ev.groupBy("severity").count().collect()}
    assert ev.count() == 73 and sev == {"HIGH": 70, "MEDIUM": 3}
    assert sorted(ev.collect()) == sorted(P.pump_dump_join_form(c1).collect())
    c2 = ohlcv(trades_sparse(read_table(spark, SF01, "events")))
    assert P.pump_candles(c2).count() == 413 and P.pump_dump(c2).count() == 412


def test_frame_is_a_parameter(spark):
    c = candles(spark, [50, 55, 55, 55, 55] + [51] * 12, [1, 4, 1, 1, 1] + [1] * 12)
    # trailing-only average (row itself and 6 before): avg at row 1 = 2.5, 2.5*2.5 > 4 -> no pump
    assert P.pump_dump(c, PumpConfig(avg_frame=(-6, 0))).count() == 0


def test_plans_have_no_nested_loops(spark):
    c = ohlcv(trades_sparse(read_table(spark, SF001, "events")))
    for df in (P.pump_dump(c), P.pump_dump_join_form(c)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        # windows are partitioned by day, never a single partition
        assert "SinglePartition" not in plan
