"""Shuffle volume per headline query, from Spark's event log.

    python tools/shuffle_profile.py [sf_dir]

Runs each query once (noop sink) in a session whose event log goes to a fresh
scratch folder, then sums the task metrics of that query's jobs: input rows,
shuffle records and bytes written, and spill. Prints one JSON line per query.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tradewatch.config import WashConfig  # noqa: E402
from tradewatch.operators import candles as C  # noqa: E402
from tradewatch.operators import clean as CL  # noqa: E402
from tradewatch.operators import dq as DQ  # noqa: E402
from tradewatch.operators import pump as P  # noqa: E402
from tradewatch.operators import staged as ST  # noqa: E402
from tradewatch.operators import wash as W  # noqa: E402
from tradewatch.sources import fixtures as FX  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="/tmp/run-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the shuffle plans of the cluster case
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ev = FX.read_table(spark, sf_dir, "events")
    sparse, dense = FX.trades_sparse(ev), FX.trades_dense(ev)
    bronze = FX.bronze_text(FX.bronze_dirty(ev))
    plans = {
        "clean_trades": lambda: CL.clean_trades(bronze),
        "dq_report": lambda: DQ.dq_report(CL.typed_trades(bronze)),
        "audited_trades": lambda: ST.audited_trades(bronze),  # both of the above in one pass, as the daily run does
        "ohlcv_5min": lambda: C.ohlcv(sparse),
        "pump_dump_events": lambda: P.pump_dump(C.ohlcv(sparse)),
        "wash_pairs_div1": lambda: W.wash_pairs(dense, WashConfig()),
        "wash_pairs_div1000": lambda: W.wash_pairs(dense, WashConfig(time_unit_divisor=1000)),
        "wash_pairs_div1000_same_second": lambda: W.wash_pairs(dense, WashConfig(time_unit_divisor=1000, value_bands=())),
    }
    for name, mk in plans.items():
        spark.sparkContext.setJobGroup(name, name)
        mk().write.format("noop").mode("overwrite").save()
    spark.stop()

    job_group, stage_group, totals = {}, {}, {}
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(files):
        if path.endswith(".zstd") or path.endswith(".lz4") or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(e.get("Stage ID"))
                    m = e.get("Task Metrics") or {}
                    if not g or not m:
                        continue
                    t = totals.setdefault(g, {"input_rows": 0, "shuffle_records": 0, "shuffle_bytes": 0, "spill_bytes": 0})
                    t["input_rows"] += m.get("Input Metrics", {}).get("Records Read", 0)
                    sw = m.get("Shuffle Write Metrics", {})
                    t["shuffle_records"] += sw.get("Shuffle Records Written", 0)
                    t["shuffle_bytes"] += sw.get("Shuffle Bytes Written", 0)
                    t["spill_bytes"] += m.get("Disk Bytes Spilled", 0)
    for name in plans:
        print(json.dumps({"query": name, **totals.get(name, {})}))


if __name__ == "__main__":
    main()
