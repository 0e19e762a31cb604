from datetime import date, datetime

from pyspark.sql import functions as F

from tradewatch.operators.candles import ohlcv
from tradewatch.sources.fixtures import read_table, trades_sparse

from conftest import SF001, SF01

COLS = "trade_id long, price double, qty double, usd_value double, trade_time timestamp_ntz, is_sell boolean"


def _t(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_open_close_by_time_then_id(spark):
    rows = [
        (4, 4.0, 1.0, 4.0, datetime(2024, 1, 1, 0, 1, 0), True),  # latest: close
        (1, 1.0, 1.0, 1.0, datetime(2024, 1, 1, 0, 0, 30), False),
        (3, 3.0, 1.0, 3.0, datetime(2024, 1, 1, 0, 0, 10), False),  # same time, larger id
        (2, 2.0, 1.0, 2.0, datetime(2024, 1, 1, 0, 0, 10), False),  # same time, smaller id: open
    ]
    for parts in (1, 3):
        c = ohlcv(_t(spark, rows).repartition(parts)).collect()
        assert len(c) == 1
        r = c[0]
        assert (r.open, r.close, r.high, r.low) == (2.0, 4.0, 4.0, 1.0)
        assert r.trade_count == 4 and r.buyer_initiated_count == 3 and r.seller_initiated_count == 1
        assert r.trade_date == date(2024, 1, 1)


def test_window_edge_and_null_side(spark):
    rows = [
        (1, 1.0, 1.0, 1.0, datetime(2024, 1, 1, 0, 4, 59, 999999), True),
        (2, 2.0, 1.0, 2.0, datetime(2024, 1, 1, 0, 5, 0), None),
    ]
    c = {r.window_start: r for r in ohlcv(_t(spark, rows)).collect()}
    edge = c[datetime(2024, 1, 1, 0, 5)]
    assert edge.window_end == datetime(2024, 1, 1, 0, 10)
    assert edge.trade_count == 1 and edge.buyer_initiated_count == 0 and edge.seller_initiated_count == 0
    assert edge.buy_sell_ratio == 0.0
    assert c[datetime(2024, 1, 1, 0, 0)].seller_initiated_count == 1


def test_all_null_ids_ratio_is_null(spark):
    rows = [(None, 1.0, 1.0, 1.0, datetime(2024, 1, 1, 0, 0, 1), False)]
    r = ohlcv(_t(spark, rows)).collect()[0]
    assert r.trade_count == 0 and r.buy_sell_ratio is None


def test_fixture_counts_and_invariants(spark):
    for sf, n in ((SF001, 936), (SF01, 5944)):
        t = trades_sparse(read_table(spark, sf, "events"))
        c = ohlcv(t)
        agg = c.agg(
            F.count("*").alias("n"),
            F.sum("trade_count").alias("trades"),
            F.count_if((F.col("low") > F.col("open")) | (F.col("open") > F.col("high"))
                       | (F.col("low") > F.col("close")) | (F.col("close") > F.col("high"))).alias("bad_ohlc"),
            F.count_if(F.col("buyer_initiated_count") + F.col("seller_initiated_count") > F.col("trade_count")).alias("bad_sides"),
        ).collect()[0]
        assert agg.n == n
        assert agg.trades == t.count()
        assert agg.bad_ohlc == 0 and agg.bad_sides == 0


def test_independent_of_partitioning(spark):
    t = trades_sparse(read_table(spark, SF001, "events"))
    a = ohlcv(t).collect()
    b = ohlcv(t.repartition(7, "trade_id").sortWithinPartitions(F.desc("trade_time"))).collect()
    assert sorted(a) == sorted(b)
