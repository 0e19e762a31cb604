"""Bronze / silver / gold layer I/O.

Every layer is one Parquet table partitioned by its day column and, where its rows carry a
``symbol``, by the symbol below it. Reads filter on the partition columns, so Spark prunes to
the folders asked for and pushes the remaining predicates into the Parquet scan.

Re-running a day must replace that day, also when the re-run finds nothing (T9). Dynamic
partition overwrite replaces exactly the (day, symbol) folders present in the new rows; folders
asked for but absent from them are deleted through the Hadoop file system (a metadata
operation, no Spark job), so a re-run that finds no event for a day leaves that day empty. A
run for some symbols leaves the others' folders alone.

:func:`publish_days` replaces days by renames instead: rows are first written to a staging
folder, can be audited there, and are published only if the caller goes on.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def read_days(
    spark: SparkSession, root: str, day_col: str, days: list[date] | None = None, schema: StructType | None = None,
    symbols: list[str] | None = None,
) -> DataFrame:
    """A layer's rows, restricted to ``days`` and ``symbols`` by partition pruning; ``None`` is every one, an empty list none."""
    df = (spark.read if schema is None else spark.read.schema(schema)).parquet(root)
    if "symbol" in df.columns and df.schema["symbol"].dataType != StringType():
        # A folder name like symbol=1000 would be taken for a number.
        typed = StructType([f for f in (schema or df.schema).fields if f.name != "symbol"]).add("symbol", StringType())
        df = spark.read.schema(typed).parquet(root)
    df = df if days is None else df.where(_is_one_of(day_col, days))
    return df if symbols is None or "symbol" not in df.columns else df.where(_is_one_of("symbol", symbols))


def _is_one_of(name: str, values: list):
    return F.col(name).isin(list(values)) if values else F.lit(False)


def partition_columns(df: DataFrame, day_col: str) -> list[str]:
    return [day_col, "symbol"] if "symbol" in df.columns else [day_col]


def _slice_names(df: DataFrame, day_col: str):
    """A row's partition folder, relative to the table's root."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_columns(df, day_col)])


def write_clustered(
    df: DataFrame, root: str, by: list[str], mode: str, sort_within: list[str] | None = None, below: str | None = None
) -> dict:
    """Writes ``df`` partitioned by ``by`` (and ``below``, a constant column); returns rows and ``slices``, the
    folders of ``by`` that got rows, observed during the write itself (A12)."""
    # Rows are clustered by day and symbol for few files each, and AQE splits a folder much
    # larger than the others and merges small ones, so no day lands in one task.
    out = df.hint("rebalance", *by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    seen = Observation("written_slices")
    out = out.observe(seen, F.collect_set(_slice_names(df, by[0])).alias("slices"), F.count(F.lit(1)).alias("rows"))
    # Per-write option: only the folders present in ``out`` are replaced.
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by, *([below] if below else [])).parquet(root)
    got = seen.get
    return {"rows": int(got.get("rows") or 0), "slices": sorted(got.get("slices") or [])}


def replace_days(
    df: DataFrame, root: str, day_col: str, days: list[date] | None, sort_within: list[str] | None = None,
    symbols: list[str] | None = None,
) -> dict:
    """Make ``root`` hold exactly ``df``'s rows for each day in ``days`` (and symbol in ``symbols``).

    Returns the rows and days written. ``days`` ``None`` replaces whatever folders ``df`` has; an
    empty list writes nothing. ``symbols`` ``None`` is every symbol of the days. Folders with rows:
    dynamic partition overwrite (others untouched); folders without: deleted after the write.
    """
    if days is not None and not days:
        return {"rows": 0, "days": []}
    out = df if days is None else df.where(_is_one_of(day_col, days))
    if symbols is not None and "symbol" in df.columns:
        out = out.where(_is_one_of("symbol", symbols))
    got = write_clustered(out, root, partition_columns(df, day_col), "overwrite", sort_within)
    if days is not None:
        spark = df.sparkSession
        for name in stored_slices(spark, root, day_col, days, symbols):
            if name not in got["slices"]:
                delete_path(spark, f"{root}/{name}")
        _drop_empty_days(spark, root, day_col, days)
    return {"rows": got["rows"], "days": sorted({s.split("/")[0].partition("=")[2] for s in got["slices"]})}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def stored_slices(
    spark: SparkSession, root: str, day_col: str, days: list[date], symbols: list[str] | None = None
) -> Iterator[str]:
    """Folders (relative to ``root``) that hold rows of the days and symbols."""
    for d in days:
        day = f"{day_col}={d}"
        inside = child_names(spark, f"{root}/{day}")
        found = [n for n in inside if n.startswith("symbol=")]
        if not found and inside:
            yield day
        yield from (f"{day}/{n}" for n in found if symbols is None or n.partition("=")[2] in symbols)


def _drop_empty_days(spark: SparkSession, root: str, day_col: str, days: list[date]) -> None:
    for d in days:
        path = f"{root}/{day_col}={d}"
        if not [n for n in child_names(spark, path) if not n.startswith((".", "_"))]:
            delete_path(spark, path)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Moves a folder or file within one file system; raises if that fails."""
    fs, p = _fs(spark, src)
    to = _fs(spark, dst)[1]
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{src} cannot be moved to {dst}")


def publish_days(
    spark: SparkSession, staging: str, root: str, day_col: str, days: list[date], below: str = "",
    symbols: list[str] | None = None,
) -> list[str]:
    """Replaces the days' folders of ``root`` by those of ``staging`` (their sub-folder ``below``), by renames alone.

    A replaced folder is set aside first, put back if its successor cannot be moved in, and removed
    at the end; a folder that ``staging`` lacks is removed (T9). A day is at every moment the old
    one, the new one, or, between its two renames, absent. Returns the folders published.
    """
    aside = f"{root}/_replaced-{uuid.uuid4().hex[:12]}"
    staged = list(stored_slices(spark, staging, day_col, days, symbols))
    new = [n for n in staged if not below or below in child_names(spark, f"{staging}/{n}")]
    old = list(stored_slices(spark, root, day_col, days, symbols))
    for name in sorted({*new, *old}):
        if name in old:
            rename(spark, f"{root}/{name}", f"{aside}/{name}")
        if name in new:
            try:
                rename(spark, f"{staging}/{name}/{below}" if below else f"{staging}/{name}", f"{root}/{name}")
            except Exception:
                if name in old:
                    rename(spark, f"{aside}/{name}", f"{root}/{name}")
                raise
    delete_path(spark, aside)
    _drop_empty_days(spark, root, day_col, days)
    return new


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on whatever file system it lives on."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder holds a data file; a folder may lack one when every day was emptied."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().startswith("part-"):
            return True
    return False


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 5000, days_cleared: bool = False
) -> None:
    """S9 towards a relational warehouse: append in batches of ``batch_size`` rows.

    Spark's JDBC writer has no predicate delete, so the run's days have to be cleared in the
    database first; the caller confirms it by ``days_cleared``, as appending a day twice doubles
    it. The partitioned Parquet tables of :func:`replace_days` are the re-runnable target.
    """
    if not days_cleared:
        raise ValueError(f"clear the run's days in {table} first and pass days_cleared=True")
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)
