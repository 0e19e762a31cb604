"""The daily run (C0-C6) for any set of days at once.

landing zips -> bronze -> DQ gate -> silver -> candles -> pump-and-dump events
                                            \\-> wash pairs
-> warehouse (dim_date, three fact tables) -> count validation.

Each stage writes its table (Parquet partitioned by day and symbol under ``root``) and the
next stage reads it back: the written table is the lineage cut, so a lost
executor only recomputes work of the stage it belonged to, and a failed run
can be resumed stage by stage. Every write replaces exactly the run's days and symbols,
including days that now have no rows. Candles run before pump detection (the
surveyed schedule ran them in parallel and raced, T5).

Silver is written, audited and then published: a day that fails its gate never touches what
silver holds. The warehouse's facts are loaded under a new version and become valid by one
commit (:mod:`tradewatch.sources.manifest`); read them with :func:`read_facts`.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.config import CandleConfig, CleanConfig, DQConfig, PumpConfig, WashConfig
from tradewatch.operators import candles as C
from tradewatch.operators import clean as CL
from tradewatch.operators import dq as DQ
from tradewatch.operators import pump as P
from tradewatch.operators import staged as ST
from tradewatch.operators import warehouse as WH
from tradewatch.operators import wash as W
from tradewatch.schemas import BRONZE, FACTS, OHLCV, PUMP_DUMP, SILVER_STORED, WASH_PAIRS
from tradewatch.sources import calendar as CAL
from tradewatch.sources import facts as FT
from tradewatch.sources import landing as LD
from tradewatch.sources import layers as LY
from tradewatch.sources import manifest as MF


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    @property
    def landing(self) -> str:
        return self.path("landing")

    @property
    def bronze(self) -> str:
        return self.path("bronze", "trades")

    @property
    def silver(self) -> str:
        return self.path("silver", "trades")

    @property
    def ohlcv(self) -> str:
        return self.path("gold", "ohlcv_5min")

    @property
    def pump(self) -> str:
        return self.path("gold", "pump_dump_signals")

    @property
    def wash(self) -> str:
        return self.path("gold", "wash_trade_signals")

    def dw(self, table: str) -> str:
        return self.path("warehouse", table)

    @property
    def manifest(self) -> str:
        return self.path("warehouse", "_commits")


@dataclass(frozen=True)
class RunConfig:
    clean: CleanConfig = field(default_factory=CleanConfig)
    dq: DQConfig = field(default_factory=DQConfig)
    candles: CandleConfig = field(default_factory=CandleConfig)
    pump: PumpConfig = field(default_factory=PumpConfig)
    wash: WashConfig = field(default_factory=lambda: WashConfig(hot_cell_pairs=W.HOT_CELL_PAIRS))
    # The symbols of the run; the layout's others are left alone. ``symbol``: one. ``symbols``: several, or
    # "all" that have archives of the run's days. Neither: the only one that has archives, and later
    # stages take whatever the days hold.
    symbol: str | None = None
    symbols: tuple[str, ...] | str | None = None

    def chosen(self) -> list[str] | None:
        """The symbols named; None for no restriction."""
        if self.symbol is not None:
            return [self.symbol]
        return None if self.symbols in (None, "all") else list(self.symbols)


def _days_frame(spark: SparkSession, days: list[date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "trade_date date")


def _run_symbols(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig) -> list[str]:
    """The symbols to ingest: those named, else those with archives of the days; more than one has to be asked for."""
    if cfg.chosen() is not None:
        return cfg.chosen()
    files = LD.landing_files(spark, layout.landing).where(F.col("trade_date").isin(list(days)))
    found = sorted(r.symbol for r in files.select("symbol").distinct().collect())  # file names only
    if len(found) > 1 and cfg.symbols != "all":
        raise ValueError(f"archives of several symbols in {layout.landing}: {', '.join(found)}; name one of them")
    return found


def ingest(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig = RunConfig()) -> dict:
    """Check the landing archives of ``days`` (of each symbol) and load them into bronze."""
    symbols = _run_symbols(spark, layout, days, cfg)
    for s in symbols or [None]:  # symbols named or found among the archives
        LD.require_landing(spark, layout.landing, _days_frame(spark, days), [s] if s else None)
    bronze = LD.read_landing(spark, layout.landing, days, symbols or None)
    return LY.replace_days(bronze, layout.bronze, "trade_date", days, symbols=symbols)


def _expected(spark: SparkSession, root: str, day_col: str, days: list[date], symbols: list[str] | None) -> DataFrame:
    """(trade_date[, symbol]) that a stage must find: the days, and of each the symbols named, else those
    that ``root`` holds on any of the days."""
    found = [FT.slice_of(n)[1] for n in LY.stored_slices(spark, root, day_col, days, symbols)]
    named = sorted({s for s in found if s} | set(symbols or [])) if any(found) else []
    frame = _days_frame(spark, days)
    return frame.crossJoin(spark.createDataFrame([(s,) for s in named], "symbol string")) if named else frame  # file names


def bronze_to_silver(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig) -> list[dict]:
    """Write, audit, publish. Returns the DQ report rows, with step counts.

    Bronze is cleaned and written once, to a staging folder beside silver, with the audit of every
    key (:mod:`tradewatch.operators.staged`). The gates (raise) are judged on what was written; only
    if all days pass are they moved into silver, by renames.
    """
    symbols = cfg.chosen()
    bronze = LY.read_days(spark, layout.bronze, "trade_date", days, schema=BRONZE, symbols=symbols)
    expected = _expected(spark, layout.bronze, "trade_date", days, symbols)
    staging = f"{layout.silver}.staging-{uuid.uuid4().hex[:12]}"
    try:
        audited = ST.audited_trades(bronze, cfg.clean)
        LY.write_clustered(audited, staging, LY.partition_columns(audited, "processed_date"), "overwrite", below="part")
        staged = spark.read.schema(ST.staged_schema("symbol" in audited.columns)).parquet(staging)
        measures = expected.join(ST.staged_measures(staged), expected.columns, "left")
        counts = {c: 0 for c in measures.columns if c not in expected.columns}
        rows = DQ.enforce(DQ.gated_report(measures.fillna(counts), cfg.dq, with_steps=True), cfg.dq)
        LY.publish_days(spark, staging, layout.silver, "processed_date", days, f"part={ST.KEPT}", symbols)
    finally:
        LY.delete_path(spark, staging)
    return rows


def candles_stage(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig) -> dict:
    """Silver -> 5-minute candles."""
    silver = LY.read_days(spark, layout.silver, "processed_date", days, SILVER_STORED, cfg.chosen())
    candles = C.ohlcv(silver, cfg.candles)
    return LY.replace_days(candles, layout.ohlcv, "trade_date", days, ["window_start"], cfg.chosen())


def pump_stage(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig) -> dict:
    """Written candles -> pump-and-dump events (runs after C2, T5)."""
    written = LY.read_days(spark, layout.ohlcv, "trade_date", days, OHLCV, cfg.chosen())
    return LY.replace_days(P.pump_dump(written, cfg.pump), layout.pump, "trade_date", days, symbols=cfg.chosen())


def wash_stage(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig) -> dict:
    """C4: silver -> wash-trade pairs.

    A pair belongs to the day of its buy. Pairs that may cross midnight (``exact``) need the
    neighbour days' trades as well; the write keeps the run's days only.
    """
    near = {d + timedelta(days=k) for d in days for k in ((-1, 0, 1) if cfg.wash.exact else (0,))}
    silver = LY.read_days(spark, layout.silver, "processed_date", sorted(near), SILVER_STORED, cfg.chosen())
    trades = silver.withColumnRenamed("processed_date", "trade_date")
    return LY.replace_days(W.wash_pairs(trades, cfg.wash), layout.wash, "trade_date", days, symbols=cfg.chosen())


def gold(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig) -> dict:
    """Candles, then pump-and-dump on the written candles; wash pairs on silver.

    Returns the rows written per table (observed during the writes)."""
    return {
        "ohlcv_5min": candles_stage(spark, layout, days, cfg)["rows"],
        "pump_dump_signals": pump_stage(spark, layout, days, cfg)["rows"],
        "wash_trade_signals": wash_stage(spark, layout, days, cfg)["rows"],
    }


KEYS = "key_words"  # registry of the loaded trade ids, versioned with the facts


def load_warehouse(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig = RunConfig()) -> None:
    """The calendar's days, then the fact tables' days in one commit, each day replaced.

    The first load seeds dim_date with its calendar (S11). Every table's contract (NOT NULL,
    decimals, severity, key over all days, date in dim_date) is checked before any fact is written,
    and keys loaded on other days are looked up in the registry. The three tables' rows and the
    registry's are written under a new version, which one commit makes valid: until then readers
    see the old version of all, from then on the new one, and a load that dies changes nothing.
    """
    symbols, manifest = cfg.chosen(), MF.load_manifest(spark, layout.manifest)
    version = manifest.next_version()
    trades = WH.fact_trades(LY.read_days(spark, layout.silver, "processed_date", days, SILVER_STORED, symbols))
    pumps = WH.fact_pump_dump(LY.read_days(spark, layout.pump, "trade_date", days, PUMP_DUMP, symbols))
    washes = WH.fact_wash_pairs(LY.read_days(spark, layout.wash, "trade_date", days, WASH_PAIRS, symbols))
    tables = {"fact_trades": trades, "fact_pump_dump_events": pumps, "fact_wash_trade_pairs": washes}
    CAL.ensure_days(spark, layout.dw("dim_date"), days)

    # Silver's days and symbols, and those an earlier load has that are empty now.
    slices = {FT.slice_of(n) for n in LY.stored_slices(spark, layout.silver, "processed_date", days, symbols)}
    slices |= {e.slice for e in FT.chosen(manifest, days, symbols)}
    plain = [MF.Entry(d, s, version) for d, s in sorted(slices)]
    roots = [(layout.dw(KEYS), "processed_date"), *[(layout.dw(t), FACTS[t][0]) for t in tables]]
    try:
        words = WH.key_words(trades, "processed_date", "trade_id")
        FT.write_version(words, layout.dw(KEYS), "processed_date", version, ["word"])
        mine = [MF.Entry(*e.slice, version, (KEYS,)) for e in plain]
        words = _read_keys(spark, layout, manifest, mine, words.schema)
        ranges = {
            (str(r.processed_date), r["symbol"] if "symbol" in r else ""): (r.n, r.least, r.greatest)
            for r in WH.key_ranges(words, "processed_date").collect()  # one row per day and symbol
        }
        WH.enforce_contract("fact_trades", trades, "processed_date", "trade_id", _loaded(spark, layout, manifest, words, ranges))
        WH.enforce_contract("fact_pump_dump_events", pumps, "trade_date")
        WH.enforce_contract("fact_wash_trade_pairs", washes, "trade_date")
        dim = CAL.read_calendar(spark, layout.dw("dim_date"))
        lost = [r for r in WH.orphan_dates(trades, dim).collect() if r.orphan_rows]  # one row per day
        if lost:
            raise WH.ContractError("; ".join(f"fact_trades {r.processed_date}: {r.orphan_rows} rows without a dim_date row" for r in lost))
        found = {t: FT.write_version(df, layout.dw(t), FACTS[t][0], version) for t, df in tables.items()}
        found[KEYS] = set(ranges)
        entries = [
            MF.Entry(*e.slice, version, tuple(t for t in found if e.slice in found[t]), ranges.get(e.slice)) for e in plain
        ]
        MF.commit(spark, layout.manifest, manifest, entries)
    except Exception:
        for root, day_col in roots:
            FT.drop_version(spark, root, day_col, plain, version)
        raise
    for root, day_col in roots:
        FT.remove_versions(spark, root, day_col, entries, version)


def _read_keys(spark: SparkSession, layout: Layout, manifest: MF.Manifest, entries: list[MF.Entry], schema) -> DataFrame:
    """The registry's rows of ``entries``; one whose day has no trades has no folder."""
    stored = [e for e in entries if f"{FT.VERSION}={e.version}" in LY.child_names(spark, f"{layout.dw(KEYS)}/{FT.folder('processed_date', e)}")]
    every = MF.Manifest(manifest.number, {**manifest.entries, **{e.slice: e for e in stored}})
    bare = type(schema)([f for f in schema.fields if f.name != "symbol"])
    return FT.read_entries(spark, every, stored, layout.dw(KEYS), KEYS, "processed_date", bare)


def _loaded(spark: SparkSession, layout: Layout, manifest: MF.Manifest, words: DataFrame, ranges: dict) -> DataFrame | None:
    """:func:`tradewatch.operators.warehouse.loaded_keys` against the days not being replaced; None, and nothing is
    read, if the commit log's ranges rule all of them out. No fact is read in any case."""
    others = [
        e for e in manifest.entries.values()
        if e.keys and e.slice not in ranges
        and any(s == e.symbol and lo <= e.keys[2] and e.keys[1] <= hi for (_, s), (_, lo, hi) in ranges.items())
    ]
    if not others:
        return None
    known = _read_keys(spark, layout, manifest, others, words.schema)
    lo, hi = min(r[1] for r in ranges.values()), max(r[2] for r in ranges.values())
    return WH.loaded_keys(words, known.where(F.col("word").between(lo, hi)), "processed_date")


def read_facts(
    spark: SparkSession, layout: Layout, table: str, days: list[date] | None = None, symbols: list[str] | None = None
) -> DataFrame:
    """A fact table's valid rows, by the commit log: tables read one after the other may be of different commits
    (read the log once with :func:`facts_at` to avoid that)."""
    return facts_at(spark, layout, MF.load_manifest(spark, layout.manifest), table, days, symbols)


def facts_at(
    spark: SparkSession, layout: Layout, manifest: MF.Manifest, table: str,
    days: list[date] | None = None, symbols: list[str] | None = None,
) -> DataFrame:
    day_col, schema = FACTS[table]
    return FT.read_entries(spark, manifest, FT.chosen(manifest, days, symbols), layout.dw(table), table, day_col, schema)


def validate(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig = RunConfig()) -> list[dict]:
    """Fact counts per day and symbol; raises if one has no fact_trades rows."""
    manifest, symbols = MF.load_manifest(spark, layout.manifest), cfg.chosen()
    entries = FT.chosen(manifest, days, symbols)
    named = sorted({e.symbol for e in entries if e.symbol} | set(symbols or []))
    expected = _days_frame(spark, days)
    if any(e.symbol for e in entries):
        expected = expected.crossJoin(spark.createDataFrame([(s,) for s in named], "symbol string"))  # from the log
    facts = [facts_at(spark, layout, manifest, t, days, symbols) for t in FACTS]
    return WH.validate_counts(WH.dw_counts(*facts, expected))


def run_days(spark: SparkSession, layout: Layout, days: list[date], cfg: RunConfig = RunConfig(), from_landing: bool = True) -> dict:
    """C0-C6 for ``days``; returns the DQ report (with step counts) and its warnings, the rows
    written per table, the pairs of high confidence per day (F9) and the warehouse counts per day and symbol."""
    days = sorted(set(days))
    written = {}
    if from_landing:
        written["bronze"] = ingest(spark, layout, days, cfg)["rows"]
        if cfg.chosen() is None:  # what the archives hold, and no symbol that an earlier run brought
            cfg = replace(cfg, symbols=tuple(_run_symbols(spark, layout, days, cfg)))
    dq_rows = bronze_to_silver(spark, layout, days, cfg)
    written.update(gold(spark, layout, days, cfg))
    load_warehouse(spark, layout, days, cfg)
    washes = LY.read_days(spark, layout.wash, "trade_date", days, WASH_PAIRS, cfg.chosen())
    tiers: dict = {}
    for r in W.wash_tiers(washes, cfg.wash).collect():  # one row per day and symbol
        tiers[r.trade_date] = tiers.get(r.trade_date, 0) + r.high_confidence_pairs
    return {
        "dq": dq_rows,
        "warnings": DQ.warnings_of(dq_rows, cfg.dq),
        "written": written,
        "high_confidence_pairs": {str(d): tiers.get(d, 0) for d in days},
        "counts": validate(spark, layout, days, cfg),
    }


def write_bronze(trades: DataFrame, layout: Layout, days: list[date]) -> None:
    """Bronze straight from a frame (no landing zips): for replays and tests."""
    bronze = trades.select(
        *[F.col(c) for c in trades.columns if c != "trade_date"],
        F.col("trade_date").cast("date").alias("trade_date"),
    )
    LY.replace_days(bronze, layout.bronze, "trade_date", days)
