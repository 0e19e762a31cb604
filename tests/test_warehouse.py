from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewatch.operators import warehouse as WH


def test_dim_date_seed(spark):
    d = WH.dim_date(spark)
    rows = {r.full_date: r for r in d.collect()}
    assert len(rows) == 400
    assert max(rows) == date(2027, 2, 4)
    first = rows[date(2026, 1, 1)]
    assert (first.date_id, first.day_of_week, first.is_weekend) == (20260101, 3, False)
    sat = rows[date(2026, 1, 3)]
    assert sat.day_of_week == 5 and sat.is_weekend


def test_upsert_inserts_only_new_days(spark):
    existing = WH.dim_date(spark, date(2026, 1, 1), 10)
    new = WH.dim_date(spark, date(2026, 1, 5), 10)
    ins = WH.dim_date_upsert(existing, new)
    assert sorted(r.full_date for r in ins.collect()) == [date(2026, 1, d) for d in range(11, 15)]


def test_time_windows(spark):
    days = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 1),), (date(2026, 1, 2),)], "trade_date date")
    w = WH.dim_time_window(days)
    assert w.count() == 2 * 288
    last = w.orderBy(F.desc("window_start")).first()
    assert last.window_end == datetime(2026, 1, 3) and last.hour_of_day == 23
    assert w.select("window_id").distinct().count() == 576


def test_fact_contract_and_orphans(spark):
    silver = spark.createDataFrame(
        [(1, 0.123456789012, 2.0, 0.25, datetime(2026, 1, 1, 1), True, False, 0.246913578024, 1, date(2026, 1, 1)),
         (1, 0.5, 1.0, 0.5, datetime(2026, 1, 1, 2), None, None, 0.5, 2, date(2026, 1, 1)),
         (2, 0.5, 1.0, 0.5, datetime(2026, 3, 1, 2), True, False, 0.5, 2, date(2026, 3, 1))],
        "trade_id long, price double, qty double, quote_qty double, trade_time timestamp_ntz, is_buyer_maker boolean, "
        "is_sell boolean, usd_value double, trade_hour int, processed_date date")
    f = WH.fact_trades(silver)
    assert [c for c in f.columns] == [c for c, _ in WH.FACT_TRADES_CONTRACT]
    assert str(f.schema["price"].dataType) == "DecimalType(20,10)"
    assert str(f.where("trade_id = 1").orderBy("trade_hour").first().price) == "0.1234567890"
    v = {r.processed_date: r for r in WH.contract_violations(f, "processed_date", key="trade_id").collect()}
    assert v[date(2026, 1, 1)].null_violations == 1 and v[date(2026, 1, 1)].duplicate_keys == 1
    dim = WH.dim_date(spark, date(2026, 1, 1), 31)
    o = {r.processed_date: (r.fact_rows, r.orphan_rows) for r in WH.orphan_dates(f, dim).collect()}
    assert o == {date(2026, 1, 1): (2, 0), date(2026, 3, 1): (1, 1)}


def test_validate_counts(spark):
    days = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 2),)], "trade_date date")
    trades = spark.createDataFrame([(1, date(2026, 1, 1))], "trade_id long, processed_date date")
    empty = spark.createDataFrame([], "trade_date date")
    counts = WH.dw_counts(trades, empty, empty, days)
    with pytest.raises(ValueError, match="2026-01-02"):
        WH.validate_counts(counts)
    assert WH.validate_counts(WH.dw_counts(trades, empty, empty, days.where("trade_date = '2026-01-01'")))[0]["fact_trades"] == 1


def test_seed_end_bound_and_second_rounding(spark):
    assert WH.dim_date(spark, date(2029, 12, 1), 400).count() == 31
    from tradewatch.functions import round_to_second

    df = spark.createDataFrame([(datetime(2026, 1, 1, 23, 59, 59, 600000),), (datetime(2026, 1, 1, 1, 0, 0, 400000),)], "t timestamp_ntz")
    got = [r.r for r in df.select(round_to_second("t").alias("r")).collect()]
    assert got == [datetime(2026, 1, 2, 0, 0, 0), datetime(2026, 1, 1, 1, 0, 0)]


def test_fact_trades_datetime_rounding(spark):
    silver = spark.createDataFrame(
        [(1, 1.0, 1.0, 1.0, datetime(2026, 1, 1, 23, 59, 59, 600000), True, False, 1.0, 23, date(2026, 1, 1))],
        "trade_id long, price double, qty double, quote_qty double, trade_time timestamp_ntz, is_buyer_maker boolean, "
        "is_sell boolean, usd_value double, trade_hour int, processed_date date")
    assert WH.fact_trades(silver).first().trade_time == datetime(2026, 1, 1, 23, 59, 59, 600000)
    assert WH.fact_trades(silver, round_datetime=True).first().trade_time == datetime(2026, 1, 2)


def test_keys_are_counted_over_all_days(spark):
    rows = [(7, date(2026, 1, 1)), (7, date(2026, 1, 2)), (8, date(2026, 1, 2)), (8, date(2026, 1, 2)), (None, date(2026, 1, 1)), (None, date(2026, 1, 2))]
    f = spark.createDataFrame(rows, "trade_id long, processed_date date")
    got = {r.processed_date.day: (r.null_violations, r.duplicate_keys) for r in WH.contract_violations(f, "processed_date", "trade_id").collect()}
    assert got == {1: (1, 0), 2: (1, 2)}
