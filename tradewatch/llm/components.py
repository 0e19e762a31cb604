"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import cut, discard


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    out = cut(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
    discard(low)
    return out


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = cut(down.groupBy("a").agg(F.min("b").alias("m")))
    rest = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = cut(rest.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    discard(low)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Null ends and loops are ignored. Every round is cut to the shared checkpoint folder and
    only two numbers per round reach the driver (row count and an order-free checksum), so a
    star of any size stays distributed: minima are pre-aggregated before their shuffle and written
    before they are joined, as AQE splits a hub's edges only where neither side of the join is an
    aggregate. An empty edge table gives an empty result.
    """
    e = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        before, large = e, _large_star(e)
        e = _small_star(large)
        discard(large)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        discard(before)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
