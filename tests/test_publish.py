"""Write, audit, publish; versions and commits of the warehouse; key registry; calendar; symbols."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewatch.config import CleanConfig, DQConfig
from tradewatch.functions import to_epoch_us
from tradewatch.operators import clean as CL
from tradewatch.operators import dq as DQ
from tradewatch.operators import staged as ST
from tradewatch.operators import warehouse as WH
from tradewatch.plans import daily_run as DR
from tradewatch.schemas import FACTS, SILVER_STORED
from tradewatch.sources import calendar as CAL
from tradewatch.sources import facts as FT
from tradewatch.sources import landing as LD
from tradewatch.sources import layers as LY
from tradewatch.sources import manifest as MF
from tradewatch.sources.fixtures import bronze_dirty, bronze_text, read_table, trades_sparse

from conftest import SF001

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
LOOSE = DQConfig(max_invalid_price_rate=1.0, max_invalid_qty_rate=1.0, max_out_of_range_rate=1.0)


def _bronze(spark):
    text = bronze_text(bronze_dirty(read_table(spark, SF001, "events")))
    return text.withColumn("_ingested_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


def _landing_rows(spark):
    t = trades_sparse(read_table(spark, SF001, "events"))
    return t.select("trade_id", "price", "qty", (F.col("price") * F.col("qty")).alias("quote_qty"),
                    to_epoch_us("trade_time").alias("time"), "is_buyer_maker", F.lit(True).alias("is_best_match"), "trade_date")


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ write, audit, publish
def test_published_rows_and_report_equal_the_operators(spark, tmpdir_run):
    lay, days = DR.Layout(tmpdir_run), [date(2024, 1, d) for d in range(1, 31)]
    DR.write_bronze(_bronze(spark), lay, days)
    rows = DR.bronze_to_silver(spark, lay, days, DR.RunConfig(dq=LOOSE))
    assert _rows(LY.read_days(spark, lay.silver, "processed_date", schema=SILVER_STORED)) == _rows(CL.clean_trades(_bronze(spark)))
    want = DQ.dq_report(CL.typed_trades(_bronze(spark)), days, dq=LOOSE, with_steps=True).orderBy("trade_date").collect()
    assert rows == [r.asDict() for r in want]
    assert os.listdir(os.path.dirname(lay.silver)) == ["trades"]  # no staging left


def test_a_failing_day_leaves_silver_as_it_was(spark, tmpdir_run):
    lay, cfg = DR.Layout(tmpdir_run), DR.RunConfig(dq=LOOSE)
    DR.write_bronze(_bronze(spark), lay, [D1, D2])
    DR.bronze_to_silver(spark, lay, [D1, D2], cfg)
    before = _rows(spark.read.parquet(lay.silver))
    files = {d: sorted(os.listdir(f"{lay.silver}/processed_date={d}")) for d in (D1, D2)}
    half = F.when(F.col("trade_date") == D2, F.lit("-1")).otherwise(F.col("price"))
    DR.write_bronze(_bronze(spark).where("trade_id % 2 = 0").withColumn("price", half), lay, [D1, D2])
    with pytest.raises(DQ.DataQualityError, match="2024-01-02: price invalidity 100.00%"):
        DR.bronze_to_silver(spark, lay, [D1, D2], DR.RunConfig(dq=DQConfig(max_invalid_price_rate=0.5, max_invalid_qty_rate=1.0, max_out_of_range_rate=1.0)))
    assert _rows(spark.read.parquet(lay.silver)) == before
    assert {d: sorted(os.listdir(f"{lay.silver}/processed_date={d}")) for d in (D1, D2)} == files
    assert os.listdir(os.path.dirname(lay.silver)) == ["trades"]
    # Without the gate the day is published empty, and its folder goes.
    DR.bronze_to_silver(spark, lay, [D1, D2], cfg)
    assert {r.processed_date for r in spark.read.parquet(lay.silver).select("processed_date").distinct().collect()} == {D1}
    assert not os.path.exists(f"{lay.silver}/processed_date={D2}")


def test_one_scan_and_one_keyed_shuffle(spark, tmpdir_run):
    lay = DR.Layout(tmpdir_run)
    DR.write_bronze(_bronze(spark), lay, [D1])
    bronze = LY.read_days(spark, lay.bronze, "trade_date", [D1])
    plan = _plan(ST.audited_trades(bronze))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_audit_of_odd_rows(spark):
    text = "trade_id string, price string, qty string, time string, is_buyer_maker string, trade_date date"
    t0 = 1704067200000000
    rows = [("1", "1", "1", str(t0), "true", D1), ("1", "0", "1", str(t0), "true", D1), ("1", "1", "1", str(t0), "true", D1),
            (None, "1", "1", str(t0), "true", D1), (None, "2", "1", str(t0), "true", D1), ("x", "1", "0", str(t0), "true", D1),
            ("3", "NaN", "1", str(t0), None, D1), ("4", "1", "1", str(t0 + 86_400_000_000), "true", D1), ("5", None, None, None, None, D2)]
    bronze = spark.createDataFrame(rows, text)
    for cfg in (CleanConfig(), CleanConfig(reject_nan=True)):
        got = ST.staged_measures(ST.audited_trades(bronze, cfg)).orderBy("trade_date").collect()
        assert got == DQ.audit(CL.typed_trades(bronze, cfg), cfg).select(*got[0].__fields__).orderBy("trade_date").collect()
        kept = ST.audited_trades(bronze, cfg).where(F.col("part") == ST.KEPT).drop("part", "_audit")
        assert _rows(kept) == _rows(CL.clean_trades(bronze, cfg))
    empty = ST.audited_trades(bronze.limit(0))
    assert empty.count() == 0 and ST.staged_measures(empty).count() == 0


def test_a_failed_rename_puts_the_old_day_back(spark, tmpdir_run, monkeypatch):
    root, staging = f"{tmpdir_run}/t", f"{tmpdir_run}/t.staging"
    LY.replace_days(spark.createDataFrame([(1, D1), (2, D2)], "x long, d date"), root, "d", [D1, D2])
    LY.write_clustered(spark.createDataFrame([(3, D1)], "x long, d date"), staging, ["d"], "overwrite")
    real = LY.rename

    def failing(s, src, dst):
        if src.startswith(staging):
            raise OSError("store is away")
        real(s, src, dst)

    monkeypatch.setattr(LY, "rename", failing)
    with pytest.raises(OSError, match="away"):
        LY.publish_days(spark, staging, root, "d", [D1])
    assert sorted(r.x for r in spark.read.parquet(root).collect()) == [1, 2]
    monkeypatch.undo()
    assert LY.publish_days(spark, staging, root, "d", [D1, D2]) == [f"d={D1}"]
    assert [r.x for r in spark.read.parquet(root).collect()] == [3]  # D2 found nothing


# ------------------------------------------------------------------ versions and commits
class Killed(BaseException):
    """Not an Exception: nothing of the load may clean up after it."""


def _facts(spark, lay):
    return {t: _rows(DR.read_facts(spark, lay, t, [D1])) for t in FACTS}


def test_a_load_that_dies_between_two_tables_changes_nothing(spark, tmpdir_run, monkeypatch):
    lay = DR.Layout(tmpdir_run)
    rows = _landing_rows(spark).where(F.col("trade_date") == D1)
    LD.write_landing(rows, lay.landing, tmpdir_run + "/staging")
    DR.run_days(spark, lay, [D1])
    before = _facts(spark, lay)
    assert before["fact_trades"] and before["fact_pump_dump_events"]
    # The day's silver changes; the load dies after each of the writes in turn.
    fewer = rows.where("trade_id % 2 = 0")
    LD.write_landing(fewer, lay.landing, tmpdir_run + "/staging-2")
    DR.ingest(spark, lay, [D1])
    DR.bronze_to_silver(spark, lay, [D1], DR.RunConfig())
    DR.gold(spark, lay, [D1], DR.RunConfig())
    real, calls = FT.write_version, []
    for dies_at in (2, 3, 4):
        calls.clear()

        def write(*a, **k):
            calls.append(a[1])
            if len(calls) == dies_at:
                raise Killed()
            return real(*a, **k)

        monkeypatch.setattr(FT, "write_version", write)
        with pytest.raises(Killed):
            DR.load_warehouse(spark, lay, [D1])
        assert _facts(spark, lay) == before
    assert len(os.listdir(f"{lay.dw('fact_trades')}/processed_date={D1}/symbol=ABCUSDT")) > 1  # what the dead loads left
    monkeypatch.undo()
    DR.load_warehouse(spark, lay, [D1])
    assert DR.read_facts(spark, lay, "fact_trades", [D1]).count() == fewer.count() < rows.count()
    for t, (day_col, _) in FACTS.items():
        left = LY.child_names(spark, f"{lay.dw(t)}/{day_col}={D1}/symbol=ABCUSDT")
        assert len(left) <= 1


def test_an_error_before_the_commit_removes_its_files(spark, tmpdir_run, monkeypatch):
    lay = DR.Layout(tmpdir_run)
    LD.write_landing(_landing_rows(spark).where(F.col("trade_date") == D1), lay.landing, tmpdir_run + "/staging")
    DR.run_days(spark, lay, [D1])
    before, trees = _facts(spark, lay), {t: sorted(os.walk(lay.dw(t))) for t in FACTS}

    def refuse(*a):
        raise MF.CommitConflict("another load")

    monkeypatch.setattr(MF, "commit", refuse)
    with pytest.raises(MF.CommitConflict):
        DR.load_warehouse(spark, lay, [D1])
    assert _facts(spark, lay) == before and {t: sorted(os.walk(lay.dw(t))) for t in FACTS} == trees


def test_commits(spark, tmpdir_run, monkeypatch):
    monkeypatch.setattr(MF, "FULL_EVERY", 3)
    root = f"{tmpdir_run}/_commits"
    empty = MF.load_manifest(spark, root)
    assert empty == MF.Manifest()
    one = MF.commit(spark, root, empty, [MF.Entry("2024-01-01", "", "a", ("t",), (3, 1, 9))])
    # From the same start state: another day goes in behind, the same day is refused.
    two = MF.commit(spark, root, empty, [MF.Entry("2024-01-02", "", "b")])
    assert (one.number, two.number) == (1, 2) and set(two.entries) == {("2024-01-01", ""), ("2024-01-02", "")}
    with pytest.raises(MF.CommitConflict, match="2024-01-01"):
        MF.commit(spark, root, empty, [MF.Entry("2024-01-01", "", "c")])
    now = two
    for i in range(8):
        now = MF.commit(spark, root, now, [MF.Entry(f"2024-02-{i + 1:02d}", "S", str(i))])
    assert MF.load_manifest(spark, root) == now and now.number == 10 and len(now.entries) == 10
    assert now.entries["2024-01-01", ""] == MF.Entry("2024-01-01", "", "a", ("t",), (3, 1, 9))
    assert [n for n in os.listdir(root) if not n.startswith(".")] and not [n for n in os.listdir(root) if n.startswith("_new")]
    # Only the last full commit and what follows is read.
    os.remove(f"{root}/00000002.json")
    assert MF.load_manifest(spark, root) == now


# ------------------------------------------------------------------ key registry
def _trades(spark, ids, day):
    rows = spark.createDataFrame([(i,) for i in ids], "trade_id long")
    t0 = F.timestamp_add("MICROSECOND", F.abs(F.col("trade_id")) % 1000, F.lit(day).cast("timestamp_ntz"))
    one = F.lit(1.0)
    return rows.select(
        "trade_id", one.alias("price"), one.alias("qty"), one.alias("quote_qty"), to_epoch_us(t0).alias("time"),
        F.lit(True).alias("is_buyer_maker"), F.lit(True).alias("is_best_match"), t0.alias("trade_time"), F.lit(0).alias("trade_hour"),
        F.lit(0).alias("trade_minute"), F.lit(False).alias("is_sell"), one.alias("usd_value"), F.lit(day).alias("processed_date"),
        F.lit("f").alias("_source_file"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("_ingested_at"),
    )


def _load(spark, lay, ids, day):
    silver = _trades(spark, ids, day)
    LY.replace_days(silver, lay.silver, "processed_date", [day])
    DR.candles_stage(spark, lay, [day], DR.RunConfig())
    DR.pump_stage(spark, lay, [day], DR.RunConfig())
    DR.wash_stage(spark, lay, [day], DR.RunConfig())
    DR.load_warehouse(spark, lay, [day])


def _read_roots(monkeypatch):
    """Which tables the load reads from the warehouse's history."""
    seen, real = [], FT.read_entries

    def reading(spark, manifest, entries, root, table, *rest):
        seen.extend((table, e.day) for e in entries)
        return real(spark, manifest, entries, root, table, *rest)

    monkeypatch.setattr(FT, "read_entries", reading)
    return seen


def test_disjoint_ids_read_no_history(spark, tmpdir_run, monkeypatch):
    lay = DR.Layout(tmpdir_run)
    _load(spark, lay, range(1000, 1300), D1)
    seen = _read_roots(monkeypatch)
    _load(spark, lay, range(5000, 5200), D2)  # other range: the commit log rules day 1 out
    assert {day for _, day in seen} == {str(D2)}
    seen.clear()
    # Ids between those of day 1: its registry is read, its facts are not; a fact file that cannot be read proves it.
    for path, _, names in os.walk(f"{lay.dw('fact_trades')}/processed_date={D1}"):
        for n in names:
            os.truncate(os.path.join(path, n), 0)
    _load(spark, lay, [*range(900, 1000), *range(1300, 1400)], D3)
    assert ("key_words", str(D1)) in seen and not [t for t, _ in seen if t in FACTS]


def test_overlaps_are_exact(spark, tmpdir_run):
    lay = DR.Layout(tmpdir_run)
    first, second = [-130, -65, -64, -1, 0, 63, 64, *range(100, 1000, 3)], [-64, -63, 63, 65, *range(101, 1000, 3), 103, 400, 2**62]
    _load(spark, lay, first, D1)
    again = len(set(first) & set(second))
    assert again == 4
    with pytest.raises(WH.ContractError, match=f"2024-01-02: {again} keys are loaded already"):
        _load(spark, lay, second, D2)
    assert DR.read_facts(spark, lay, "fact_trades", [D2]).count() == 0
    _load(spark, lay, sorted(set(second) - set(first)), D2)
    # The same day again: its own keys are replaced, not repeated.
    _load(spark, lay, sorted(set(second) - set(first)), D2)
    assert DR.read_facts(spark, lay, "fact_trades").count() == len(set(first) | set(second))
    entry = MF.load_manifest(spark, lay.manifest).entries[str(D1), ""]
    assert entry.keys == (len(first), -3, 999 // 64)


def test_key_words_against_sets(spark):
    rows = [(1, D1), (1, D1), (64, D1), (None, D1), (-1, D2), (2**63 - 1, D2), (-(2**63), D2)]
    words = WH.key_words(spark.createDataFrame(rows, "k long, d date"), "d", "k")
    got = {(r.d, r.word, r.bits) for r in words.collect()}
    assert got == {(D1, 0, 2), (D1, 1, 1), (D2, -1, -(2**63)), (D2, 2**57 - 1, -(2**63)), (D2, -(2**57), 1)}
    assert {(r.d, r.n) for r in WH.key_ranges(words, "d").collect()} == {(D1, 2), (D2, 3)}
    assert WH.loaded_keys(words, words.limit(0).drop("d"), "d").count() == 0


# ------------------------------------------------------------------ calendar
def test_two_loads_from_one_state_leave_one_row_a_date(spark, tmpdir_run):
    root, days = f"{tmpdir_run}/dim_date", [D1, D2, date(2026, 5, 1)]
    first, second = CAL.missing_blocks(spark, root, days), CAL.missing_blocks(spark, root, days[1:])
    CAL.write_blocks(first, root)
    CAL.write_blocks(second, root)
    for dim in (spark.read.parquet(root), CAL.read_calendar(spark, root)):
        assert dim.count() == dim.select("date_id").distinct().count() == WH.SEED_DAYS + 2
    assert CAL.missing_blocks(spark, root, days) is None
    want = WH.dim_date(spark).union(WH.dim_date(spark, D1, 2, None))
    assert _rows(CAL.read_calendar(spark, root)) == _rows(want)


# ------------------------------------------------------------------ symbols
def test_two_symbols_share_a_layout(spark, tmpdir_run):
    lay, alone = DR.Layout(tmpdir_run + "/both"), DR.Layout(tmpdir_run + "/one")
    rows = _landing_rows(spark).where(F.col("trade_date") <= D2)
    other = rows.where("trade_id % 3 <> 0").withColumn("price", F.col("price") * 2)
    for root, archives in ((lay, {"AAAUSDT": rows, "BBBUSDT": other}), (alone, {"AAAUSDT": rows})):
        for s, r in archives.items():
            LD.write_landing(r, root.landing, f"{root.root}/staging-{s}", s)
    out = DR.run_days(spark, lay, [D1, D2], DR.RunConfig(symbols="all"))
    DR.run_days(spark, alone, [D1, D2])
    n = {(r["trade_date"], r["symbol"]): r["fact_trades"] for r in out["counts"]}
    for d in (D1, D2):
        assert n[d, "AAAUSDT"] == rows.where(F.col("trade_date") == d).count()
        assert n[d, "BBBUSDT"] == other.where(F.col("trade_date") == d).count()
    assert {(r["symbol"], r["trade_date"]) for r in out["dq"]} == set((s, d) for d, s in n)
    # The first symbol's rows are those of a layout that it has for itself.
    for t in FACTS:
        assert _rows(DR.read_facts(spark, lay, t, symbols=["AAAUSDT"])) == _rows(DR.read_facts(spark, alone, t))
    for a, b in ((lay.silver, alone.silver), (lay.ohlcv, alone.ohlcv), (lay.pump, alone.pump)):
        mine = spark.read.parquet(a).where("symbol = 'AAAUSDT'").drop("_ingested_at", "_audit")
        assert _rows(mine) == _rows(spark.read.parquet(b).drop("_ingested_at", "_audit"))
    # Both carry the same ids: no duplicate, and a run of one symbol leaves the other's days alone.
    before = {t: _rows(DR.read_facts(spark, lay, t, symbols=["AAAUSDT"])) for t in FACTS}
    LD.write_landing(other.where("trade_id % 2 = 0"), lay.landing, f"{lay.root}/staging-b2", "BBBUSDT")
    again = DR.run_days(spark, lay, [D1, D2], DR.RunConfig(symbol="BBBUSDT"))
    assert {r["symbol"] for r in again["counts"]} == {"BBBUSDT"}
    assert {t: _rows(DR.read_facts(spark, lay, t, symbols=["AAAUSDT"])) for t in FACTS} == before
    assert DR.read_facts(spark, lay, "fact_trades", symbols=["BBBUSDT"]).count() == other.where("trade_id % 2 = 0").count()
    # Reads prune by both.
    plan = _plan(LY.read_days(spark, lay.silver, "processed_date", [D1], symbols=["BBBUSDT"]))
    assert "symbol" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
