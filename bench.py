"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned by the library and executed to completion with the
``noop`` sink (full computation, nothing collected to the driver). One
warm-up run, then the median of ``BENCH_RUNS`` timed runs. ``daily_run_30d``
is the whole C0-C6 run (landing zips -> warehouse) over all 30 days,
``daily_run_1d`` the same for one day (median of 2 after a warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tradewatch.config import WashConfig  # noqa: E402
from tradewatch.functions import to_epoch_us  # noqa: E402
from tradewatch.operators import candles as C  # noqa: E402
from tradewatch.operators import clean as CL  # noqa: E402
from tradewatch.operators import dq as DQ  # noqa: E402
from tradewatch.operators import pump as P  # noqa: E402
from tradewatch.operators import wash as W  # noqa: E402
from tradewatch.plans.daily_run import Layout, run_days  # noqa: E402
from tradewatch.session import build_session, scratch_path  # noqa: E402
from tradewatch.sources import fixtures as FX  # noqa: E402
from tradewatch.sources import landing as LD  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def main() -> None:
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=CPUS, app="tradewatch-bench")
    ev = FX.read_table(spark, SF_DIR, "events")
    sparse = FX.trades_sparse(ev)
    dense = FX.trades_dense(ev)
    bronze = FX.bronze_text(FX.bronze_dirty(ev))
    candles_df = C.ohlcv(sparse)

    plans = {
        "clean_trades": lambda: CL.clean_trades(bronze),
        "dq_report": lambda: DQ.dq_report(CL.typed_trades(bronze)),
        "ohlcv_5min": lambda: C.ohlcv(sparse),
        "pump_dump_window": lambda: P.pump_dump(candles_df),
        "pump_dump_join": lambda: P.pump_dump_join_form(candles_df),
        "wash_pairs_div1": lambda: W.wash_pairs(dense, WashConfig()),
        "wash_pairs_div1000": lambda: W.wash_pairs(dense, WashConfig(time_unit_divisor=1000)),
        "wash_pairs_exact": lambda: W.wash_pairs(dense, WashConfig(exact=True)),
        "wash_pairs_exact_div1000": lambda: W.wash_pairs(dense, WashConfig(exact=True, time_unit_divisor=1000)),
    }
    results, spread = {}, {}
    for name, mk in plans.items():
        times = []
        for i in range(RUNS + 1):
            t0 = time.perf_counter()
            mk().write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]

    # Whole run, landing zips -> warehouse, all days.
    rows = sparse.select(
        "trade_id", "price", "qty", (F.col("price") * F.col("qty")).alias("quote_qty"),
        to_epoch_us("trade_time").alias("time"), "is_buyer_maker", F.lit(True).alias("is_best_match"), "trade_date",
    )
    base = scratch_path(spark, "bench-run")
    lay = Layout(base)
    LD.write_landing(rows, lay.landing, base + "/staging")
    days = sorted(r.trade_date for r in rows.select("trade_date").distinct().collect())
    times = []
    for i in range(2):
        t0 = time.perf_counter()
        run_days(spark, lay, days)
        if i:
            times.append(time.perf_counter() - t0)
    results["daily_run_30d"] = round(statistics.median(times), 3)

    # One day, the surveyed pipeline's unit of work (re-run: replaces the day).
    times = []
    for i in range(3):
        t0 = time.perf_counter()
        run_days(spark, lay, days[len(days) // 2: len(days) // 2 + 1])
        if i:
            times.append(time.perf_counter() - t0)
    results["daily_run_1d"] = round(statistics.median(times), 3)

    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "spread_min_max": spread,
                "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                "config": {"master": f"local[{CPUS}]", "runs": RUNS, "warmup": 1, "spark": spark.version},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
