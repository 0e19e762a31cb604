"""Run the daily pipeline for each newly landed archive, exactly once.

The surveyed project scheduled one batch per day. The Spark-native equivalent
is a stream over the landing folder through the same data source as the batch
(``trade_archives``): the stream's checkpoint (in
the shared checkpoint folder) records which archives were processed, and each
micro-batch runs :func:`tradewatch.plans.daily_run.run_days` for the days of
its new archives. With ``availableNow`` the query processes everything landed
so far and stops, which is what a scheduled job wants; without it, the same
query keeps running and picks up archives as they land.

The stream only carries one row per archive and opens none; the archives
themselves are read by the batch run.
A failing run (a DQ gate, a missing file) fails the micro-batch, which is not
committed to the checkpoint, so the next start retries the same archives. An
archive re-delivered under a name already processed is not picked up again;
re-run its day with :func:`run_days` directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tradewatch.plans.daily_run import Layout, RunConfig, run_days
from tradewatch.sources.archives import stream_archives


def landed_days(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Streaming frame of the archives appearing in ``landing_dir``: file, symbol, day and size."""
    return stream_archives(spark, landing_dir, content=False)


def start(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    cfg: RunConfig = RunConfig(),
    available_now: bool = True,
) -> StreamingQuery:
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        days = sorted({r.trade_date for r in batch.select("trade_date").distinct().collect() if r.trade_date})
        if days:  # one row per landed day
            run_days(spark, layout, days, cfg)

    writer = landed_days(spark, layout.landing).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
