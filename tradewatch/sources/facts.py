"""The warehouse's versioned fact tables: written beside the valid version, read by the commit log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tradewatch.sources.layers import child_names, delete_path, partition_columns, write_clustered
from tradewatch.sources.manifest import Entry, Manifest

VERSION = "version"


def folder(day_col: str, entry: Entry) -> str:
    """An entry's folder in a table, relative to its root."""
    symbol = f"/symbol={entry.symbol}" if entry.symbol else ""
    return f"{day_col}={entry.day}{symbol}"


def slice_of(name: str) -> tuple[str, str]:
    """(day, symbol) of a folder such as ``trade_date=2024-01-01/symbol=ABCUSDT``."""
    values = [part.partition("=")[2] for part in name.split("/")]
    return values[0], values[1] if len(values) > 1 else ""


def write_version(
    df: DataFrame, root: str, day_col: str, version: str, sort_within: list[str] | None = None
) -> set[tuple[str, str]]:
    """Adds ``df``'s days to the table under ``version``; returns the (day, symbol) that got rows. No reader sees it yet."""
    got = write_clustered(
        df.withColumn(VERSION, F.lit(version)), root, partition_columns(df, day_col), "append", sort_within, VERSION
    )
    return {slice_of(s) for s in got["slices"]}


def chosen(manifest: Manifest, days: list[date] | None = None, symbols: list[str] | None = None) -> list[Entry]:
    wanted = None if days is None else {str(d) for d in days}
    return [
        e for e in manifest.entries.values()
        if (wanted is None or e.day in wanted) and (symbols is None or not e.symbol or e.symbol in symbols)
    ]


def read_entries(
    spark: SparkSession, manifest: Manifest, entries: list[Entry], root: str, table: str, day_col: str, schema: StructType
) -> DataFrame:
    """A table's rows of ``entries``: their folders are named to Spark, so nothing else is listed or read."""
    paths = [f"{root}/{folder(day_col, e)}/{VERSION}={e.version}" for e in entries if table in e.tables]
    # Symbols are a partition column wherever the warehouse knows any.
    if any(e.symbol for e in manifest.entries.values()):
        schema = StructType([*schema.fields]).add("symbol", StringType())
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)


def remove_versions(spark: SparkSession, root: str, day_col: str, entries: list[Entry], before: str) -> None:
    """Deletes the entries' folders of other versions numbered up to that of ``before``: replaced ones and those of
    dead loads. One with the same number belongs to a load that died or will be refused, as ``before`` is committed."""
    for e in entries:
        path = f"{root}/{folder(day_col, e)}"
        for name in child_names(spark, path):
            version = name.partition("=")[2]
            if name.startswith(f"{VERSION}=") and version != e.version and version[:8] <= before[:8]:
                delete_path(spark, f"{path}/{name}")
        while path != root and not child_names(spark, path):
            delete_path(spark, path)
            path = path.rpartition("/")[0]


def drop_version(spark: SparkSession, root: str, day_col: str, entries: list[Entry], version: str) -> None:
    """Deletes a version that will not be committed."""
    for e in entries:
        path = f"{root}/{folder(day_col, e)}"
        delete_path(spark, f"{path}/{VERSION}={version}")
        while path != root and not child_names(spark, path):
            delete_path(spark, path)
            path = path.rpartition("/")[0]
