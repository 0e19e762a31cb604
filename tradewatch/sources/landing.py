"""Landing zone: one zip of header-less trade CSV per day.

* :func:`landing_inventory` lists the archives with Spark's ``binaryFile``
  source, reading only path and length (the content column is pruned), and
  anti-joins the expected days against the found ones (S1).
* :func:`read_landing` turns archives into bronze rows (S2-S4): the data source
  ``trade_archives`` (:mod:`tradewatch.sources.archives`) decompresses the first
  ``*.csv`` member of each into line-aligned text chunks (bounded memory), and
  Spark's CSV parser (``from_csv``) splits the lines after AQE has dealt the chunks out by size.
  A zip member is one sequential deflate stream, so decompression is the only
  per-archive step.
* :func:`read_landing_csv` reads already-extracted CSV files (S3).
* :func:`write_landing` produces archives from trade rows (used to build test
  landings from the given tables): Spark writes the day's CSV parts in
  parallel, then one task per day streams them into the zip.
"""

from __future__ import annotations

import os
import sys
import uuid
import zipfile
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.schemas import LANDING, LANDING_COLUMNS, LANDING_DDL


def _ship_by_value() -> None:
    """Send this module's task functions with the tasks, so executors need not
    have the package installed (they only need pandas and pyarrow)."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()

# Landing file name pattern ``<SYMBOL>-trades-<YYYY-MM-DD>.zip``.
DEFAULT_SYMBOL = "ABCUSDT"
NAME_RE = r"^([A-Z0-9]+)-trades-(\d{4}-\d{2}-\d{2})\.zip$"
CHUNK_BYTES = 8 << 20


def landing_name(day: date | str, symbol: str = DEFAULT_SYMBOL) -> str:
    return f"{symbol}-trades-{day}.zip"


# Hadoop schemes whose store pyarrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority; without a scheme it belongs to Spark's default file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def _fs(path: str):
    """(pyarrow file system, path inside it) of a qualified path."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon:
        raise ValueError(f"{path}: a path with a scheme is expected")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    except Exception as e:
        raise ValueError(f"{path}: archives in a store of scheme {scheme!r} cannot be opened") from e


def _open(path: str):
    """Open a file for random access (zip reading) on any supported file system."""
    filesystem, inner = _fs(path)
    return filesystem.open_input_file(inner)


def landing_day(name: Column) -> Column:
    """Day in an archive's file name; NULL for any other name and for a day that does not exist."""
    return F.regexp_extract(name, NAME_RE, 2).try_cast("date")


def _archives(spark: SparkSession, landing_dir: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(landing_dir)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        "path",
        name.alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.regexp_extract(name, NAME_RE, 1).alias("symbol"),
        landing_day(name).alias("trade_date"),
    )


def landing_files(spark: SparkSession, landing_dir: str, symbols: list[str] | None = None) -> DataFrame:
    """Archives in ``landing_dir``: path, file name, size, symbol and day; of ``symbols`` only, if given."""
    files = _archives(spark, landing_dir).where(F.col("trade_date").isNotNull())
    return files if symbols is None else files.where(F.col("symbol").isin(list(symbols)) if symbols else F.lit(False))


def ignored_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Zip files whose name is not that of a day's archive: path, file name and size."""
    return _archives(spark, landing_dir).where(F.col("trade_date").isNull()).select("path", "file_name", "size_bytes")


def landing_inventory(
    spark: SparkSession, landing_dir: str, days: DataFrame, symbols: list[str] | None = None
) -> DataFrame:
    """S1 for many days: one row per expected day with ``found`` and ``size_bytes``.

    ``days`` has a ``trade_date`` column. Missing days are the rows with
    ``found = false``; a caller that needs the surveyed hard failure raises
    on them (:func:`require_landing`).
    """
    found = landing_files(spark, landing_dir, symbols).groupBy("trade_date").agg(
        F.sum("size_bytes").alias("size_bytes"), F.count(F.lit(1)).alias("files")
    )
    return (
        days.select("trade_date").distinct()
        .join(found, "trade_date", "left")
        .select("trade_date", F.col("files").isNotNull().alias("found"), F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"))
    )


def missing_days(spark: SparkSession, landing_dir: str, days: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    found = landing_files(spark, landing_dir, symbols).select("trade_date")
    return days.select("trade_date").distinct().join(found, "trade_date", "left_anti")


def require_landing(spark: SparkSession, landing_dir: str, days: DataFrame, symbols: list[str] | None = None) -> None:
    """Raise ``FileNotFoundError`` naming the missing days (collects only those days)."""
    miss = sorted(str(r.trade_date) for r in missing_days(spark, landing_dir, days, symbols).collect())
    if miss:
        raise FileNotFoundError(f"landing files missing for: {', '.join(miss)} in {landing_dir}")


def _csv_member(archive: zipfile.ZipFile, path: str) -> zipfile.ZipInfo:
    """The trades of an archive: its first entry that is a CSV file."""
    for entry in archive.infolist():
        if not entry.is_dir() and entry.filename.endswith(".csv"):
            return entry
    raise ValueError(f"{path}: the archive has no CSV entry")


def _line_blocks(stream, size: int) -> Iterator[bytes]:
    """Whole lines of a byte stream in blocks of about ``size`` bytes."""
    rest = b""
    while block := stream.read(size):
        head, newline, tail = block.rpartition(b"\n")
        if newline:
            yield rest + head + newline
            rest = tail
        else:
            rest += block
    if rest:
        yield rest


def _utc_now() -> Column:
    """The load time as a UTC timestamp without zone, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def read_landing_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3 for already-extracted files: header-less CSV, the 7 landing columns as text.

    PERMISSIVE mode drops surplus trailing fields and fills missing ones with
    NULL, like the surveyed reader; ``_source_file`` comes from the file name
    and ``trade_date`` from the name's date when it follows the landing pattern.
    """
    csv = (
        spark.read.schema(LANDING)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    name = F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)$", 1)
    day = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1)
    return csv.select(
        *LANDING_COLUMNS,
        name.alias("_source_file"),
        _utc_now().alias("_ingested_at"),
        day.try_cast("date").alias("trade_date"),
    )


def read_landing(
    spark: SparkSession, landing_dir: str, days: list[date] | None = None, symbols: list[str] | None = None
) -> DataFrame:
    """Bronze rows (all text) of the archives, with lineage columns and the symbol.

    ``None`` means every day (every symbol), an empty list none. Days and symbols
    are options of the data source, so other archives are not opened; its tasks
    are packed by archive size and only decompress (a zip member is one sequential
    deflate stream). The
    line-aligned chunks are then dealt out by AQE in partitions of its advisory
    size, whatever the number of archives, and Spark's own CSV parser
    (``from_csv``) splits them into the 7 columns, dropping surplus trailing
    fields as the surveyed reader did. ``_ingested_at`` is the load time in UTC;
    ``trade_date`` and ``symbol`` come from the file name. Fields are not quoted
    in exchange trade files, so a record never spans two lines.
    """
    from tradewatch.sources.archives import read_archives

    chunks = read_archives(spark, landing_dir, days, symbols).hint("rebalance")
    lines = chunks.select(F.explode(F.split("text", "\r?\n")).alias("line"), "_source_file", "symbol", "trade_date")
    parsed = lines.where(F.length("line") > 0).select(
        F.from_csv("line", LANDING_DDL, {"mode": "PERMISSIVE"}).alias("r"), "_source_file", "symbol", "trade_date"
    )
    return parsed.select(
        *[F.col(f"r.{c}").alias(c) for c in LANDING_COLUMNS],
        "_source_file",
        _utc_now().alias("_ingested_at"),
        "trade_date",
        "symbol",
    )


def _zip_day(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs

    for batch in batches:
        for src, dst, member in zip(batch["src"], batch["dst"], batch["member"]):
            src_fs, src_dir = _fs(src)
            dst_fs, dst_path = _fs(dst)
            parts = sorted(
                i.path for i in src_fs.get_file_info(pafs.FileSelector(src_dir)) if os.path.basename(i.path).startswith("part-")
            )
            dst_fs.create_dir(os.path.dirname(dst_path), recursive=True)
            size = 0
            # Written under a private name, then renamed: a retried or speculative
            # attempt never exposes a half-written archive.
            tmp = f"{dst_path}.inprogress-{uuid.uuid4().hex}"
            with dst_fs.open_output_stream(tmp) as raw, zipfile.ZipFile(raw, "w", compression=zipfile.ZIP_DEFLATED) as zf:
                with zf.open(member, "w", force_zip64=True) as out:
                    for p in parts:
                        with src_fs.open_input_stream(p) as f:
                            while chunk := f.read(1 << 20):
                                out.write(chunk)
                                size += len(chunk)
            dst_fs.move(tmp, dst_path)
            yield pd.DataFrame({"dst": [dst], "csv_bytes": [size]})


def write_landing(trades: DataFrame, landing_dir: str, staging_dir: str, symbol: str = DEFAULT_SYMBOL) -> DataFrame:
    """Write one zip per day from typed trades (``trade_date`` + the 7 landing columns).

    Returns one row per archive written (path and CSV bytes); runs eagerly.
    Paths may be local or any URI pyarrow can open (the shared checkpoint
    folder of a cluster, or local disk in tests).
    """
    text = trades.select(*[F.col(c).cast("string").alias(c) for c in LANDING_COLUMNS], F.col("trade_date").cast("string").alias("trade_date"))
    text.write.mode("overwrite").partitionBy("trade_date").option("header", False).csv(staging_dir)
    days = [r.trade_date for r in text.select("trade_date").distinct().collect()]  # one row per day
    spark = trades.sparkSession
    staging_dir, landing_dir = qualified(spark, staging_dir), qualified(spark, landing_dir)
    jobs = spark.createDataFrame(
        [
            (f"{staging_dir}/trade_date={d}", f"{landing_dir}/{landing_name(d, symbol)}", f"{symbol}-trades-{d}.csv")
            for d in days
        ],
        "src string, dst string, member string",
    )
    jobs = jobs.repartition(max(1, min(len(days), spark.sparkContext.defaultParallelism)))
    return _run(jobs)


def _run(jobs: DataFrame) -> DataFrame:
    rows = jobs.mapInPandas(_zip_day, "dst string, csv_bytes long").collect()  # one row per day
    return jobs.sparkSession.createDataFrame(rows, "dst string, csv_bytes long")
