"""Command line: one sub-command per stage, for one or many days.

    python -m tradewatch <stage> --root ROOT --ds 2026-04-13 [--ds 2026-04-14 ...]
    python -m tradewatch run --root ROOT --from 2026-04-01 --to 2026-04-30

Stages: ingest, bronze-to-silver, ohlcv, pump-dump, wash-trade, load, validate, run.
The session comes from ``spark-submit`` (master, resources); thresholds keep
their defaults except the wash time unit and join form.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, timedelta

from pyspark.sql import SparkSession

from tradewatch.config import WashConfig
from tradewatch.operators.wash import HOT_CELL_PAIRS
from tradewatch.plans import daily_run as DR
from tradewatch.session import ensure_checkpoint_dir

STAGES = ["ingest", "bronze-to-silver", "ohlcv", "pump-dump", "wash-trade", "load", "validate", "run"]


def _days(args) -> list[date]:
    days = {date.fromisoformat(d) for d in args.ds or []}
    if args.date_from:
        lo = date.fromisoformat(args.date_from)
        hi = date.fromisoformat(args.date_to or args.date_from)
        days |= {lo + timedelta(days=i) for i in range((hi - lo).days + 1)}
    if not days:
        raise SystemExit("give --ds (repeatable) or --from/--to")
    return sorted(days)


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="tradewatch")
    ap.add_argument("stage", choices=STAGES)
    ap.add_argument("--root", required=True, help="layout root (landing/, bronze/, silver/, gold/, warehouse/)")
    ap.add_argument("--ds", action="append", help="processing date YYYY-MM-DD; repeatable")
    ap.add_argument("--from", dest="date_from")
    ap.add_argument("--to", dest="date_to")
    ap.add_argument("--time-unit-divisor", type=int, default=1, help="1: as coded (µs), 1000: as documented (ms)")
    ap.add_argument("--exact-wash", action="store_true", help="also pair trades across a second boundary")
    ap.add_argument("--symbol", action="append", help="symbol to run; repeatable. Default: the only one with archives")
    ap.add_argument("--all-symbols", action="store_true", help="run every symbol that has archives of the days")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tradewatch-{args.stage}").getOrCreate()
    ensure_checkpoint_dir(spark)
    layout, days = DR.Layout(args.root), _days(args)
    cfg = DR.RunConfig(wash=WashConfig(time_unit_divisor=args.time_unit_divisor, exact=args.exact_wash, hot_cell_pairs=HOT_CELL_PAIRS),
                       symbols="all" if args.all_symbols else tuple(args.symbol) if args.symbol else None)
    out: dict = {"stage": args.stage, "days": [str(d) for d in days]}
    if args.stage == "ingest":
        DR.ingest(spark, layout, days, cfg)
    elif args.stage == "bronze-to-silver":
        out["dq"] = DR.bronze_to_silver(spark, layout, days, cfg)
    elif args.stage == "ohlcv":
        DR.candles_stage(spark, layout, days, cfg)
    elif args.stage == "pump-dump":
        DR.pump_stage(spark, layout, days, cfg)
    elif args.stage == "wash-trade":
        DR.wash_stage(spark, layout, days, cfg)
    elif args.stage == "load":
        DR.load_warehouse(spark, layout, days, cfg)
    elif args.stage == "validate":
        out["counts"] = DR.validate(spark, layout, days, cfg)
    else:
        out.update(DR.run_days(spark, layout, days, cfg))
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
