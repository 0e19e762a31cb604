"""dim_date as a stored table (S10, S11): blocks of fixed contents, partitioned by year and block.

Insert-if-absent without a race: a load writes the blocks that its days need and that are not
there yet, each whole (:func:`tradewatch.operators.warehouse.calendar_blocks`). Loads that run at
once may write the same block twice; dynamic overwrite leaves one copy, and readers take one row
a date whatever they find.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradewatch.operators import warehouse as WH
from tradewatch.schemas import DIM_DATE
from tradewatch.sources.layers import child_names, has_files


def stored_blocks(spark: SparkSession, root: str) -> set[str]:
    return {
        b.partition("=")[2]
        for year in child_names(spark, root) if year.startswith("year=")
        for b in child_names(spark, f"{root}/{year}") if has_files(spark, f"{root}/{year}/{b}")
    }


def missing_blocks(spark: SparkSession, root: str, days: list[date]) -> DataFrame | None:
    """Rows of the seed and of the blocks of ``days`` as far as they are not stored; None if all are."""
    stored = stored_blocks(spark, root)
    wanted = spark.createDataFrame([(d,) for d in days], "d date")
    rows = WH.calendar_blocks(WH.dim_date(spark).union(WH.dim_date_for(wanted, "d")).distinct())
    new = rows.where(~F.col("block").isin(sorted(stored))) if stored else rows
    return None if new.isEmpty() else new


def write_blocks(rows: DataFrame, root: str) -> None:
    """Stores whole blocks; a block that is there already is replaced by the same rows."""
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "block").parquet(root)


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    """dim_date, one row a date."""
    stored = spark.read.schema(StructType([*DIM_DATE.fields, StructField("block", StringType())])).parquet(root)
    return stored.select(*DIM_DATE.names).dropDuplicates(["date_id"])


def ensure_days(spark: SparkSession, root: str, days: list[date]) -> None:
    """Stores the seed and ``days`` where they are missing."""
    new = missing_blocks(spark, root, days)
    if new is not None:
        write_blocks(new, root)
