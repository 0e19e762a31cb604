"""The landing zone as a data source: pruned archives stay closed, the stream reads each archive once."""

import os
import zipfile
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tradewatch.sources import archives as AR
from tradewatch.sources import landing as LD

DAY = date(2026, 4, 13)


def put(folder, symbol, day, text="1,0.5,10,5,1776038400000000,True,True\n"):
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(f"{folder}/{LD.landing_name(day, symbol)}", "w") as z:
        z.writestr("t.csv", text)


def broken(folder, symbol, day):
    """A file that cannot be opened as a zip."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{LD.landing_name(day, symbol)}", "wb") as f:
        f.write(b"not a zip")


def test_ruled_out_archives_are_not_opened(spark, tmpdir_run):
    put(tmpdir_run, "AAAUSDT", DAY)
    broken(tmpdir_run, "AAAUSDT", DAY + timedelta(1))
    broken(tmpdir_run, "BBBUSDT", DAY)
    rows = LD.read_landing(spark, tmpdir_run, [DAY], ["AAAUSDT"])
    assert [(r.trade_id, r.symbol, r.trade_date) for r in rows.collect()] == [("1", "AAAUSDT", DAY)]
    assert LD.read_landing(spark, tmpdir_run, []).count() == 0 == LD.read_landing(spark, tmpdir_run, None, []).count()
    assert LD.read_landing(spark, tmpdir_run, [DAY + timedelta(9)]).count() == 0
    assert AR.read_archives(spark, tmpdir_run, content=False).count() == 3  # lists without opening
    with pytest.raises(Exception, match="zip"):
        LD.read_landing(spark, tmpdir_run, [DAY]).collect()


def test_one_frame_under_many_filters(spark, tmpdir_run):
    for i in range(4):
        put(tmpdir_run, "AAAUSDT" if i % 2 else "BBBUSDT", DAY + timedelta(i))
    files = AR.read_archives(spark, tmpdir_run, content=False)
    assert files.where(F.col("symbol").startswith("A")).count() == 2
    assert files.where((F.col("symbol") == "AAAUSDT") | (F.col("trade_date") == DAY)).count() == 3
    assert files.where(F.dayofmonth("trade_date") == 14).select("_source_file").collect()[0][0] == "AAAUSDT-trades-2026-04-14.zip"
    assert files.where("size_bytes < 0").count() == 0
    assert files.count() == 4
    a, b = (files.where(F.col("symbol") == s) for s in ("AAAUSDT", "BBBUSDT"))
    assert sorted(r.symbol for r in a.union(b).collect()) == ["AAAUSDT"] * 2 + ["BBBUSDT"] * 2
    rows = LD.read_landing(spark, tmpdir_run)
    assert [rows.where(F.col("symbol") == s).count() for s in ("AAAUSDT", "none")] + [rows.count()] == [2, 0, 4]
    assert files.where("symbol IS NOT NULL AND trade_date IS NULL").count() == 0


def test_other_files_and_empty_folder(spark, tmpdir_run):
    assert AR.read_archives(spark, tmpdir_run).count() == 0
    put(tmpdir_run, "AAAUSDT", DAY, text="")
    for name in ("AAAUSDT-trades-2026-02-30.zip", "notes.zip", "AAAUSDT-trades-2026-04-15.zip.part"):
        open(f"{tmpdir_run}/{name}", "wb").close()
    os.makedirs(f"{tmpdir_run}/AAAUSDT-trades-2026-04-16.zip")
    assert [r._source_file for r in AR.read_archives(spark, tmpdir_run, content=False).collect()] == [LD.landing_name(DAY, "AAAUSDT")]
    assert LD.read_landing(spark, tmpdir_run).count() == 0  # an archive without a line


def test_packed_by_size():
    some = [(f"f{i}", size << 20, "A", DAY) for i, size in enumerate([300, 1, 1, 1, 100, 20])]
    parts = [p.value for p in AR.packed(some, 4)]
    assert sorted(x for p in parts for x in p) == sorted(some)
    assert [x[0] for x in parts[0]] == ["f0"]
    assert all(len(p) == 1 or sum(x[1] + AR.SMALLEST_TASK for x in p) <= AR.LARGEST_TASK for p in parts)
    assert len(parts) < len(some) and AR.packed([], 4) == []


def test_ranges():
    text = AR.ranges([5, 3, 4, 9, 3])
    assert text == "3-5,9-9" and [d for d in range(12) if AR.within(d, text)] == [3, 4, 5, 9]
    assert AR.ranges([]) == "" and not AR.within(1, "")


def test_stream_reads_each_archive_once(spark, tmpdir_run):
    land, check = tmpdir_run + "/landing", tmpdir_run + "/check"
    seen = []

    def run():
        seen.clear()

        def batch(df, _):
            seen.extend((r.symbol, r.trade_date, r.text) for r in df.collect())

        q = AR.stream_archives(spark, land).writeStream.foreachBatch(batch).option("checkpointLocation", check)
        q.trigger(availableNow=True).start().awaitTermination()
        return sorted((s, d) for s, d, _ in seen)

    put(land, "AAAUSDT", DAY + timedelta(2))
    put(land, "BBBUSDT", DAY)
    assert run() == [("AAAUSDT", DAY + timedelta(2)), ("BBBUSDT", DAY)]
    assert run() == []
    put(land, "AAAUSDT", DAY)  # late, for an earlier day
    put(land, "BBBUSDT", DAY, text="2,1,1,1,1,True,True\n")  # delivered again
    assert run() == [("AAAUSDT", DAY)]
    assert all(t.startswith("1,") for _, _, t in seen)
