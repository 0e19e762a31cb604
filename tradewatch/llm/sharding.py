"""Sharding by a permutation-filled lookup table (native).

Each shard has a preference order over the slots of a prime-sized table: an offset and a
skip taken from digests of its name, so slot ``(offset + j * skip) mod size`` is its j-th
choice and, the size being prime, the order visits every slot. The shards take turns and
each claims its best slot that is still free, until the table is full. A key's digest
modulo the table size then names its shard by one look-up.

The table depends on the shard names and the size alone, never on the data. Its size is a
parameter (``MAX_SLOTS`` at most), which is what bounds the broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 2053  # prime; over a hundred slots a shard keep shards within about one percent of even
N_SHARDS = 16
MAX_SLOTS = 1_000_003


def shard_names(n: int = N_SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(s: str) -> int:
    return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Shard index of every slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards: distinct names, at least one and no more than slots")
    if slots > MAX_SLOTS or not _is_prime(slots):
        raise ValueError(f"slots: a prime of at most {MAX_SLOTS}")
    at = [_number(s + ":offset") % slots for s in shards]
    # One slot leaves a single place to go; else the skip is 1 .. slots - 1.
    skip = [_number(s + ":skip") % max(1, slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            if not free:
                break
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            owner[at[i]] = i
            free -= 1
    return owner


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard), one row per slot."""
    owner = ",".join(map(str, lookup_table(shards, slots)))
    names = F.split(F.lit(",".join(shards)), ",")
    return (
        spark.range(1)
        .select(F.posexplode(F.split(F.lit(owner), ",").cast("array<int>")).alias("slot", "i"))
        .select("slot", F.get(names, F.col("i")).alias("shard"))
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 32 bits of its MD5 digest modulo the size; a null key counts as empty."""
    hexes = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.pmod(F.conv(hexes, 16, 10).cast("long"), F.lit(slots)).cast("int")


def assign_shards(
    df: DataFrame, key: str, shards: list[str] | None = None, slots: int = SLOTS, out: str = "shard"
) -> DataFrame:
    """``df`` with ``<out>_slot`` and ``<out>``; rows, order and other columns stay as they are.

    Equal keys (repeated rows among them) share a shard; null keys go where the empty key goes;
    an empty table stays empty. A column of ``df`` that has one of the two new names is replaced.
    No shuffle: the table has ``slots`` rows, checked against ``MAX_SLOTS``, and is broadcast.
    """
    shards = shard_names() if shards is None else shards
    if any("," in s for s in shards):
        raise ValueError("shard names hold no comma")
    cols = [c for c in df.columns if c not in (out, f"{out}_slot")]
    slot = slot_of(df[key], slots)
    placed = df.select(*[df[c] for c in cols], slot.alias("__slot"))
    t = table_frame(df.sparkSession, shards, slots).select(F.col("slot").alias("__t"), F.col("shard").alias("__shard"))
    return placed.join(F.broadcast(t), F.col("__slot") == F.col("__t"), "inner").select(
        *[placed[c] for c in cols], F.col("__slot").alias(f"{out}_slot"), F.col("__shard").alias(out)
    )


def write_shards(df: DataFrame, key: str, path: str, shards: list[str] | None = None, slots: int = SLOTS) -> None:
    """Parquet under ``path/shard=<name>/``, the files sized by Spark: a large shard has several."""
    assign_shards(df, key, shards, slots).drop("shard_slot").hint("rebalance", "shard").write.partitionBy(
        "shard"
    ).parquet(path)
