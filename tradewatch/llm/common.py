"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.session import ensure_checkpoint_dir

# A word is a run of anything but ASCII blanks, tab .. carriage return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


BATCH_ROWS = 256

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_package(spark: SparkSession) -> None:
    """Readies a session for Python workers: hands them this package, once per application, and
    bounds an Arrow batch to ``BATCH_ROWS`` texts, as one text may be very long."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="tradewatch-py-"), os.path.basename(package))
    root, name = os.path.split(package)
    sc.addPyFile(shutil.make_archive(base, "zip", root, name))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, LOWER)


def shingle_hashes(w: Column, k: int) -> Column:
    """XXH64 (seed 42) of every run of ``k`` words joined by a space, repeats included.

    Fewer than ``k`` words: the whole sequence is one shingle; no words: an empty array.
    """
    n = F.size(w)
    many = F.transform(
        F.sequence(F.lit(1), n - (k - 1)),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + (j - 1)) for j in range(k)])),
    )
    one = F.array(F.xxhash64(F.concat_ws(" ", w)))
    return F.when(n >= k, many).when(n > 0, one).otherwise(F.array().cast("array<bigint>"))


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut: written as a table to the shared folder of ``spark.checkpoint.dir`` and read from there.

    The shuffles behind it are removed with the write, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tradewatch-llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    got = spark.read.schema(df.schema).parquet(path)
    got.cut_path = path
    return got


def discard(df: DataFrame) -> None:
    """Removes the table that ``cut`` wrote, once nothing reads it any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df.cut_path)
    path.getFileSystem(conf).delete(path, True)


def settle(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with more columns that are worked out once a row.

    Spark copies a projected expression into every later filter and projection that uses it,
    which for long array expressions repeats the whole work. A one-row generator is a border
    that neither is moved across. A column of the same name is replaced.
    """
    old = [df[c] for c in df.columns if c not in cols]
    return df.select(*old, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named c0, c1, .. and the new name of each, so that an operator's own
    columns (``__`` and a word) cannot meet a user's, whatever the user's are called."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(df: DataFrame, names: dict[str, str]) -> list[Column]:
    """The columns that ``numbered`` renamed, under their own names."""
    return [df[n].alias(c) for c, n in names.items()]
