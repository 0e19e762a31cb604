"""Near-duplicates by SimHash with multi-index hashing.

A text's fingerprint has 64 bits: bit b is set if it is set in over half of the hashes of
its shingles. Fingerprints at most ``radius`` bits apart are linked. They are cut into
``radius // 2 + 1`` segments, so two linked ones differ by one bit at most in some segment:
every fingerprint stands once per segment in the table and looks up the Hamming ball of
radius one around each of its own segments. A match is kept if the complete distance holds.

Only different fingerprints are compared; equal ones (copies, hot groups) are one row each
from the start, pre-aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import ascii_lower, cut, numbered, restored, ship_package, shingle_hashes, words
from tradewatch.llm.components import components

BITS = 64
SHINGLE = 4
RADIUS = 4
BLOCK = 1 << 17  # hashes unpacked at once


def majority(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run ``values[start : start + size]`` of hashes; an empty run has zero."""
    out = np.zeros(len(starts), np.int64)
    full = np.flatnonzero(sizes)
    at = 0
    while at < len(full):
        # As many whole runs as fit a block, one at least; a longer run is summed piece by piece.
        ends = starts[full[at:]] + sizes[full[at:]] - starts[full[at]]
        n = max(1, int(np.searchsorted(ends, BLOCK, side="right")))
        runs = full[at : at + n]
        first, last = starts[runs[0]], starts[runs[-1]] + sizes[runs[-1]]
        if n == 1:
            ones = sum(
                (_bits(values[i : min(i + BLOCK, last)]).sum(0, dtype=np.int64) for i in range(first, last, BLOCK)),
                np.zeros(BITS, np.int64),
            )[None]
        else:
            ones = np.add.reduceat(_bits(values[first:last]), starts[runs] - first, axis=0, dtype=np.int64)
        set_bits = ones * 2 > sizes[runs][:, None]
        out[runs] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8")[:, 0].view(np.int64)
        at += n
    return out


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values).astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row per row of ``docs``, fp a long of 64 bits. A-Z are lower-cased, null counts as empty.

    The hashes are made by Spark; numpy counts their bits.
    """
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    w = words(ascii_lower(docs[text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(1)
            at = np.asarray(h.offsets, np.int64)
            fp = majority(np.asarray(h.values), at[:-1], np.diff(at))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=out.names)

    ship_package(docs.sparkSession)
    split = docs.select(docs[id_col].alias(id_col), w.alias("w"))
    return split.select(id_col, shingle_hashes(F.col("w"), shingle).alias("h")).mapInArrow(run, out)


def segments(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    n = radius // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(bits: int) -> Column:
    """64 bits as a long."""
    return F.lit(bits - (1 << BITS) if bits >> (BITS - 1) else bits).cast("long")


def _part(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(_signed((1 << width) - 1))


def _flips(part: Column, width: int, tag: Column) -> Column:
    """Look-ups of a segment with one of its zero bits set."""
    bits = F.array(*[_signed(1 << b) for b in range(width)])
    return F.transform(
        F.filter(bits, lambda x: part.bitwiseAND(x) == 0),
        lambda x: F.struct(tag.alias("seg"), part.bitwiseOR(x).alias("key"), F.lit(True).alias("flip")),
    )


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): every pair of different values of ``fp`` at most ``radius`` bits apart, once.

    A ball is probed upwards only (bits that are 0 become 1): of two segments one bit apart
    the lower one finds the other. Each pair is reported by the first segment that can.
    """
    if not 0 <= radius < 40:
        raise ValueError("radius: 0 to 39 bits")
    seg = segments(radius)
    fp = F.col("fp")
    keys, probes = [], []
    for i, (low, width) in enumerate(seg):
        part, tag = _part(fp, low, width), F.lit(i)
        keys.append(F.struct(tag.alias("seg"), part.alias("key")))
        flips = _flips(part, width, tag)
        probes += [F.array(F.struct(tag.alias("seg"), part.alias("key"), F.lit(False).alias("flip"))), flips]
    table = fps.select(fp.alias("b"), F.inline(F.array(*keys)))
    probe = fps.select(fp.alias("a"), F.inline(F.concat(*probes)))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    sooner = F.lit(False)
    for i, (low, width) in enumerate(seg[:-1]):
        sooner = sooner | ((F.col("p.seg") > i) & (F.bit_count(_part(apart, low, width)) <= 1))
    on = (
        (F.col("p.seg") == F.col("t.seg"))
        & (F.col("p.key") == F.col("t.key"))
        & (F.col("flip") | (F.col("a") < F.col("b")))
        & (F.bit_count(apart) <= radius)
        & ~sooner
    )
    return probe.alias("p").join(table.alias("t"), on).select("a", "b")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id): one row per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the smallest id reachable over
    links, the row's own included. Texts without words (null, empty, blank) have fingerprint
    zero and are linked like any other; a null id is nobody's smallest, so a component of null
    ids alone has a null component_id; repeated rows keep their rows; an empty table gives an
    empty result; other columns are not read.
    """
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    nodes = cut(fps.groupBy("fp").agg(F.min(id_col).alias("low")))
    parts = components(links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "component")
    named = nodes.join(parts, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("part"))
    lows = named.groupBy("part").agg(F.min("low").alias("component_id"))
    ids = named.join(lows, "part").select("fp", "component_id")
    return fps.join(ids, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, of equal ids the one
    with the smallest text hash; rows without an id come last. Of rows that repeat the same id and
    text one stays. Columns and the texts of the rows that stay are as they were.
    """
    ident = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.xxhash64("text").alias("text_key"))
    found = near_duplicates(docs.select(ident.alias("ident"), "text"), shingle, radius, "ident")
    first = found.where("ident = component_id").select("ident.doc_id", "ident.text_key").distinct()
    first = cut(first.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__first")))
    docs, own = numbered(docs)
    keyed = docs.withColumn("__key", F.xxhash64(own["text"]))
    mine = keyed[own["doc_id"]].eqNullSafe(first["__id"]) & (keyed["__key"] == first["__first"])
    kept = keyed.join(first, mine, "left_semi").dropDuplicates([own["doc_id"], "__key"])
    return kept.select(*restored(kept, own))
