import os
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewatch.functions import to_epoch_us
from tradewatch.sources import landing as LD
from tradewatch.sources import layers as LY
from tradewatch.sources.fixtures import read_table, trades_sparse

from conftest import SF001

D1, D2 = date(2026, 4, 13), date(2026, 4, 14)


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members:
            z.writestr(name, text)


def test_landing_members_and_missing_days(spark, tmpdir_run):
    land = os.path.join(tmpdir_run, "landing")
    os.makedirs(land)
    _zip(f"{land}/ABCUSDT-trades-{D1}.zip", [
        ("readme.txt", "x"),
        ("a.csv", "1,0.5,10,5,1776038400000000,True,True,extra\n2,0.6,10,6,1776038400000001,False,True\n"),
        ("b.csv", "9,9,9,9,9,True,True\n"),
    ])
    _zip(f"{land}/ABCUSDT-trades-{D2}.zip", [("notes.txt", "no csv")])
    days = spark.createDataFrame([(D1,), (D2,), (date(2026, 4, 15),)], "trade_date date")
    inv = {r.trade_date: r.found for r in LD.landing_inventory(spark, land, days).collect()}
    assert inv == {D1: True, D2: True, date(2026, 4, 15): False}
    with pytest.raises(FileNotFoundError, match="2026-04-15"):
        LD.require_landing(spark, land, days)
    rows = LD.read_landing(spark, land, [D1]).orderBy("trade_id").collect()
    assert [r.trade_id for r in rows] == ["1", "2"]  # first csv only, surplus field ignored
    assert rows[0].is_buyer_maker == "True" and rows[0]._source_file == f"ABCUSDT-trades-{D1}.zip"
    assert rows[0].trade_date == D1
    with pytest.raises(Exception, match="no CSV entry"):
        LD.read_landing(spark, land, [D2]).collect()


def test_write_and_read_landing_round_trip(spark, tmpdir_run):
    t = trades_sparse(read_table(spark, SF001, "events"))
    rows = t.select("trade_id", "price", "qty", (F.col("price") * F.col("qty")).alias("quote_qty"),
                    to_epoch_us("trade_time").alias("time"), "is_buyer_maker", F.lit(True).alias("is_best_match"), "trade_date")
    land = os.path.join(tmpdir_run, "landing")
    written = LD.write_landing(rows, land, os.path.join(tmpdir_run, "staging"))
    assert written.count() == 30
    back = LD.read_landing(spark, land).select(
        F.col("trade_id").cast("long").alias("trade_id"), F.col("price").cast("double").alias("price"),
        F.col("time").cast("long").alias("time"), "trade_date")
    want = rows.select("trade_id", "price", "time", "trade_date")
    assert back.count() == want.count() == 1000
    assert back.exceptAll(want).count() == 0


def test_small_chunks(spark, tmpdir_run, monkeypatch):
    t = trades_sparse(read_table(spark, SF001, "events")).where(F.col("trade_date") <= date(2024, 1, 2))
    rows = t.select("trade_id", "price", "qty", (F.col("price") * F.col("qty")).alias("quote_qty"),
                    to_epoch_us("trade_time").alias("time"), "is_buyer_maker", F.lit(True).alias("is_best_match"), "trade_date")
    land = os.path.join(tmpdir_run, "landing")
    LD.write_landing(rows, land, os.path.join(tmpdir_run, "staging"))
    monkeypatch.setattr(LD, "CHUNK_BYTES", 100)  # lines straddle chunk edges
    want = rows.select(F.col("trade_id").cast("string").alias("trade_id"), F.col("time").cast("string").alias("time"))
    back = LD.read_landing(spark, land).select("trade_id", "time")
    assert back.count() == want.count()
    assert back.exceptAll(want).count() == 0


def _small_landing(spark, root, symbols=("ABCUSDT",)):
    rows = spark.createDataFrame([(i, 1.0 + i, 2.0, 2.0 + i, 1704067200_000000 + i, True, True, date(2024, 1, 1)) for i in range(5)],
                                 "trade_id long, price double, qty double, quote_qty double, time long, is_buyer_maker boolean, "
                                 "is_best_match boolean, trade_date date")
    land = os.path.join(root, "landing")
    for n, s in enumerate(symbols):
        LD.write_landing(rows.withColumn("price", F.col("price") * (n + 1)), land, os.path.join(root, f"staging-{s}"), s)
    return land


def test_foreign_names_and_impossible_days_are_ignored(spark, tmpdir_run):
    land = _small_landing(spark, tmpdir_run)
    for name in ("notes.zip", "ABCUSDT-trades-2026-02-31.zip", "old-ABCUSDT-trades-2024-01-01.zip"):
        with open(os.path.join(land, name), "wb") as f:
            f.write(b"not an archive")
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),)], "trade_date date")
    assert {(r.trade_date.day, r.found) for r in LD.landing_inventory(spark, land, days).collect()} == {(1, True), (2, False)}
    with pytest.raises(FileNotFoundError, match="2024-01-02"):
        LD.require_landing(spark, land, days)
    assert {r.file_name for r in LD.ignored_files(spark, land).collect()} == {
        "notes.zip", "ABCUSDT-trades-2026-02-31.zip", "old-ABCUSDT-trades-2024-01-01.zip"}
    assert LD.read_landing(spark, land).count() == 5
    assert LD.read_landing(spark, land, []).count() == 0


def test_symbols_are_kept_apart(spark, tmpdir_run):
    from tradewatch.plans.daily_run import Layout, RunConfig, ingest

    land = _small_landing(spark, tmpdir_run, ("ABCUSDT", "XYZUSDT"))
    both = LD.read_landing(spark, land)
    assert {(r.symbol, r["count"]) for r in both.groupBy("symbol").count().collect()} == {("ABCUSDT", 5), ("XYZUSDT", 5)}
    assert LD.read_landing(spark, land, symbols=["XYZUSDT"]).count() == 5
    layout, days = Layout(tmpdir_run), [date(2024, 1, 1)]
    with pytest.raises(ValueError, match="ABCUSDT, XYZUSDT"):
        ingest(spark, layout, days)
    assert ingest(spark, layout, days, RunConfig(symbol="XYZUSDT"))["rows"] == 5


def test_load_time_is_utc(spark, tmpdir_run):
    from datetime import datetime, timezone

    land, zone = _small_landing(spark, tmpdir_run), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = LD.read_landing(spark, land).first()._ingested_at
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - at).total_seconds()) < 600


def test_paths_and_schemes(spark):
    assert LD.qualified(spark, "/tmp/x").startswith("file:")
    assert LD._fs("file:///tmp/x")[1] == "/tmp/x" and LD._fs("file:/tmp/x")[1] == "/tmp/x"
    with pytest.raises(ValueError, match="odd"):
        LD._fs("odd://host/x")


def test_no_days_write_nothing(spark, tmpdir_run):
    root = os.path.join(tmpdir_run, "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1))], "id long, trade_date date")
    assert LY.replace_days(df, root, "trade_date", []) == {"rows": 0, "days": []}
    assert not os.path.exists(root)
    LY.replace_days(df, root, "trade_date", None)
    assert LY.read_days(spark, root, "trade_date").count() == 1
    assert LY.read_days(spark, root, "trade_date", []).count() == 0
    with pytest.raises(ValueError, match="days_cleared"):
        LY.append_jdbc(df, "jdbc:none", "t", {})


def test_replace_days_clears_days_without_rows(spark, tmpdir_run):
    root = os.path.join(tmpdir_run, "gold")
    df = spark.createDataFrame([(1, D1), (2, D1), (3, D2)], "x long, trade_date date")
    LY.replace_days(df, root, "trade_date", [D1, D2])
    assert spark.read.parquet(root).count() == 3
    # re-run D2 with rows, D1 with none: D1 must end up empty, D2 replaced
    LY.replace_days(spark.createDataFrame([(4, D2)], "x long, trade_date date"), root, "trade_date", [D1, D2])
    back = sorted((r.x, r.trade_date) for r in spark.read.parquet(root).collect())
    assert back == [(4, D2)]
    # a run for another day leaves both untouched
    LY.replace_days(spark.createDataFrame([(5, date(2026, 4, 20))], "x long, trade_date date"), root, "trade_date", [date(2026, 4, 20)])
    assert spark.read.parquet(root).count() == 2
    assert LY.read_days(spark, root, "trade_date", [D2]).count() == 1


def test_extracted_csv_reader(spark, tmpdir_run):
    d = os.path.join(tmpdir_run, "csv")
    os.makedirs(d)
    with open(os.path.join(d, "ABCUSDT-trades-2026-04-13.csv"), "w") as f:
        f.write("1,0.5,10,5,1776038400000000,True,True,extra\n2,0.6,10,6,1776038400000001,False\n")
    rows = LD.read_landing_csv(spark, d).orderBy("trade_id").collect()
    assert [r.trade_id for r in rows] == ["1", "2"]
    assert rows[0].is_best_match == "True" and rows[1].is_best_match is None
    assert rows[0].trade_date == D1 and rows[0]._source_file == "ABCUSDT-trades-2026-04-13.csv"
