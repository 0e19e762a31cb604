"""Removal of byte strings that start at two places or more, by suffix arrays.

A string of ``LENGTH`` bytes is repeated if it also starts anywhere else, in the same text or in
another; every byte that a repeated string covers is removed. The strings of a text are the starts
0 .. n - LENGTH. To bring equal ones together without comparing all texts:

1. A string is filed under one gram of ``GRAM`` bytes: that of the smallest hash in it (the first of
   equal ones). Equal strings hold equal bytes, so they are filed under equal grams. Successive
   strings mostly share their gram, so a text gives one row, a stretch, for each gram it files under:
   where its strings start, the gram's hash, and a digest of all bytes that its strings cover.
2. Stretches of equal digest are counted as one. A stretch that is alone under its gram holds
   nothing repeated, one found twice or more and no other beside it is repeated throughout: neither
   needs its bytes read again. Copies of any number, a hot passage too, end here as one row.
3. The different stretches under one gram are the candidates. Their bytes are fetched, joined to one
   sequence (with a symbol between them that no byte has; blocks of starts that share no core of
   bytes with another stretch are left out, as in 4), and its suffix array is built. The starts
   whose suffix has ``LENGTH`` bytes in common with a neighbour are repeated.
4. Grams with more than ``MOST`` different stretches (the edges of a passage in very many texts) do
   not fit one task. Their stretches are cut into blocks of ``BLOCK`` starts, aligned to the gram; blocks
   whose common core no other stretch has are dropped, the rest is counted string by string.

Everything is joined on grams and digests (128 bits); no task holds more than ``MOST`` stretches of a
gram or one text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import cut, discard, ship_package
from tradewatch.llm.suffix_array import suffix_array

LENGTH = 400
GRAM = 128
MOST = 400
BLOCK = 16
PACK_BYTES = 1 << 16  # stretches joined to one sequence
TEXT_BLOCK = 2 << 20  # bytes of texts hashed at once

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPANS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType(), False) for c in ("first", "last")]), False)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(int(_BASE), -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_cache: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of every run of ``gram`` bytes, by differences of one running sum."""
    n = len(raw)
    if n > TEXT_BLOCK * 2:
        up, down = _powers(n)
    else:
        if "powers" not in _cache:
            _cache["powers"] = _powers(TEXT_BLOCK * 2)
        up, down = (x[:n] for x in _cache["powers"])
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    h = (total[gram:] - total[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _first_minima(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest hash (the first of equal ones) of every window."""
    low = np.uint64((1 << len(h).bit_length()) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    t = 1
    while 2 * t <= window:
        key = np.minimum(key[:-t], key[t:])
        t *= 2
    if t < window:
        key = np.minimum(key[: t - window], key[window - t :])
    return (key & low).astype(np.int64)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of ``count`` numbers each, one after another."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def _file_under_grams(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, first start, starts, place of the gram behind the first start, gram hash) of every stretch."""
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    if not count.sum():
        return [np.zeros(0, np.int64)] * 5
    h = _gram_hashes(raw, gram)
    start = _ranges(offsets[:-1], count)
    at = _first_minima(h, length - gram + 1)[start]
    head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    first = start[head]
    text = np.searchsorted(offsets, first, "right") - 1
    return text, first - offsets[text], np.diff(np.append(head, len(start))), at[head] - first, h[at[head]].view(np.int64)


def _bytes_of(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]], offsets - offsets[0]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, count) of successive texts of about ``TEXT_BLOCK`` bytes together, one at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    block = (np.cumsum(size) - size) // TEXT_BLOCK
    at = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(size) else []
    yield from zip(at, np.diff(np.append(at, len(size))))


def _digest(data) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(id, text_key, first, starts, off, gram, digest): step 1."""
    out = T.StructType([
        docs.schema["id"], docs.schema["text_key"],
        *[T.StructField(c, T.IntegerType()) for c in ("first", "starts", "off")],
        T.StructField("gram", T.LongType()), T.StructField("digest", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, n in _blocks(whole.column(2)):
                b = whole.slice(at, n)
                data, offsets = _bytes_of(b.column(2))
                raw = np.frombuffer(data, np.uint8)
                text, first, starts, off, key = _file_under_grams(raw, offsets, length, gram)
                begin = (offsets[text] + first).tolist()
                digests = [_digest(data[i : i + k + length - 1]) for i, k in zip(begin, starts.tolist())]
                of = b.select([0, 1]).take(pa.array(text))
                cells = [pa.array(x.astype(np.int32)) for x in (first, starts, off)]
                yield pa.RecordBatch.from_arrays(
                    [*of.columns, *cells, pa.array(key), pa.array(digests, pa.binary())], names=out.names
                )

    return docs.select("id", "text_key", "text").mapInArrow(run, out)


def _repeated_starts(stretches: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Step 3: for each stretch, the ranges of starts (from its first one) whose string another start has too."""
    sizes = np.array([len(s) for s in stretches])
    data = np.frombuffer(b"\0".join(stretches) + b"\0" * 8, np.uint8)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    t = data[:-8].astype(np.int64) + 1
    t[begins[1:] - 1] = 0
    sa = np.array(suffix_array(t), np.int64)
    # Starts with a whole string before their stretch's end, in suffix order.
    of = np.searchsorted(begins, sa, "right") - 1
    sa = sa[sa - begins[of] + length <= sizes[of]]
    # Eight bytes at a time; neighbours that differ drop out.
    eight = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))
    pair = np.arange(len(sa) - 1)
    steps = [*range(0, length - 7, 8), length - 8] if length >= 8 else []
    for k in steps:
        pair = pair[eight[sa[pair] + k] == eight[sa[pair + 1] + k]]
    hit = np.zeros(len(sa), bool)
    hit[pair] = hit[pair + 1] = True
    at = np.sort(sa[hit])
    of = np.searchsorted(begins, at, "right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in stretches]
    edge = np.flatnonzero(np.concatenate(([True], (np.diff(at) > 1) | (np.diff(of) > 0)))) if len(at) else []
    for i, j in zip(edge, np.append(edge[1:], len(at)) if len(at) else []):
        base = int(begins[of[i]])
        out[int(of[i])].append((int(at[i]) - base, int(at[j - 1]) - base))
    return out


_FOUND = T.StructType([T.StructField("gram", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("spans", _SPANS)])


def _found_batch(keys: list[tuple[int, bytes]], spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    kept = [(k, s) for k, s in zip(keys, spans) if s]
    pair = pa.struct([pa.field("first", pa.int32(), False), pa.field("last", pa.int32(), False)])
    listed = pa.array([[{"first": a, "last": b} for a, b in s] for _, s in kept], pa.list_(pa.field("element", pair, False)))
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in kept], pa.int64()), pa.array([k[1] for k, _ in kept], pa.binary()), listed], names=_FOUND.names
    )


def _blocks_of_starts(starts: int, off: int) -> Iterator[tuple[int, int, int]]:
    """(aligned start, first start, end) of the blocks of a stretch; alignment counts from the gram."""
    for x in range(-(-off % BLOCK), starts, BLOCK):
        yield x, max(x, 0), min(x + BLOCK, starts)


def _sharing(group: dict[bytes, tuple[int, bytes]], length: int) -> Iterator[tuple[bytes, int, bytes]]:
    """(digest, first start, bytes) of the part of a gram's stretches whose blocks have a core in common with another one."""
    cores = {
        d: [(_digest(memoryview(data)[x + BLOCK - 1 : x + length]), a, z) for x, a, z in _blocks_of_starts(len(data) - length + 1, off)]
        for d, (off, data) in group.items()
    }
    met = Counter(c for blocks in cores.values() for c in {c for c, _, _ in blocks})
    for d, blocks in cores.items():
        shared = [(a, z) for c, a, z in blocks if met[c] > 1]
        if shared:
            first = shared[0][0]
            yield d, first, group[d][1][first : shared[-1][1] + length - 1]


def _by_suffix_array(candidates: DataFrame, length: int) -> DataFrame:
    """(gram, digest, spans) of candidates (gram, digest, off, data): the grams of a partition, a pack at a time.

    Blocks of starts whose common core (as in step 4) no other stretch of the gram has are left out first.
    """

    def settled(pack: list[tuple[int, bytes, int, bytes]]) -> pa.RecordBatch:
        spans = _repeated_starts([p[3] for p in pack], length)
        moved = [[(a + p[2], z + p[2]) for a, z in s] for p, s in zip(pack, spans)]
        return _found_batch([(p[0], p[1]) for p in pack], moved)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, group, last = [], {}, None
        for b in batches:
            for g, d, off, data in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if g != last:
                    pack += [(last, *x) for x in _sharing(group, length)]
                    group, last = {}, g
                    if sum(len(p[3]) for p in pack) >= PACK_BYTES:
                        yield settled(pack)
                        pack = []
                group[d] = (off, data)
        pack += [(last, *x) for x in _sharing(group, length)]
        if pack:
            yield settled(pack)

    dealt = candidates.select("gram", "digest", "off", "data").repartition("gram").sortWithinPartitions("gram", "digest")
    return dealt.mapInArrow(run, _FOUND)


def _by_single_strings(candidates: DataFrame, length: int) -> DataFrame:
    """Step 4: (gram, digest, spans) of candidates (gram, digest, off, data) under grams that are too hot for one task."""
    out = T.StructType([
        T.StructField("gram", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("core", T.BinaryType()),
        T.StructField("first", T.IntegerType()), T.StructField("strings", T.ArrayType(T.LongType())),
    ])

    def short(data) -> int:
        return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for g, d, off, data in zip(*[b.column(i).to_pylist() for i in range(4)]):
                view = memoryview(data)
                for x, first, end in _blocks_of_starts(len(data) - length + 1, off):
                    core = _digest(view[x + BLOCK - 1 : x + length])  # what all strings of the whole block hold
                    rows.append((g, d, core, first, [short(view[i : i + length]) for i in range(first, end)]))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64())]
            cols = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=out.names)

    blocks = cut(candidates.select("gram", "digest", "off", "data").mapInArrow(run, out))
    shared = cut(blocks.groupBy("gram", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram", "core"))
    strings = cut(
        blocks.join(shared, ["gram", "core"]).select("gram", "core", "digest", "first", F.posexplode("strings").alias("i", "string"))
    )
    again = cut(strings.groupBy("gram", "core", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    start = (F.col("first") + F.col("i")).alias("start")
    hits = strings.join(again, ["gram", "core", "string"]).groupBy("gram", "digest").agg(F.array_sort(F.collect_set(start)).alias("at"))
    return hits.select("gram", "digest", F.transform("at", lambda a: F.struct(a.alias("first"), a.alias("last"))).alias("spans"))


def _bytes_for(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (id, text_key, first, starts and others) with ``data``, the bytes its strings cover; one read of each text."""
    rest = [c for c in wanted.columns if c not in ("id", "text_key")]
    lists = wanted.groupBy("id", "text_key").agg(F.collect_list(F.struct(*rest)).alias("wanted"))
    mine = docs["id"].eqNullSafe(lists["id"]) & (docs["text_key"] == lists["text_key"])
    texts = docs.join(lists, mine).select("text", "wanted")
    cells = T.StructType([lists.schema["wanted"].dataType.elementType[c] for c in rest])
    out = T.StructType([*cells.fields, T.StructField("data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text = b.column(0)[i].as_py().encode()
                cell = b.column(1)[i].values
                data = [text[a : a + k + length - 1] for a, k in zip(cell.field("first").to_pylist(), cell.field("starts").to_pylist())]
                yield pa.RecordBatch.from_arrays([*[cell.field(c) for c in rest], pa.array(data, pa.binary())], names=out.names)

    return texts.mapInArrow(run, out)


def _without(docs: DataFrame, id_col: str, spans: DataFrame, length: int) -> DataFrame:
    """(id, n_bytes, spans, kept): every text without the bytes of its repeated strings."""
    cell = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "end")])
    out = T.StructType([
        T.StructField(id_col, docs.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(cell, False)), T.StructField("kept", T.BinaryType()),
    ])
    mine = docs["id"].eqNullSafe(spans["id"]) & (docs["text_key"] == spans["text_key"])
    both = docs.join(spans, mine, "left").select(docs["id"], "text", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
        for b in batches:
            sizes, cuts, kept = [], [], []
            for i in range(b.num_rows):
                text = (b.column(1)[i].as_py() or "").encode()
                merged: list[list[int]] = []
                cell = b.column(2)[i]
                for first, last in sorted((c["first"], c["last"]) for c in cell.as_py()) if cell.is_valid else ():
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], last + length)
                    else:
                        merged.append([first, last + length])
                edges = [0, *[x for m in merged for x in m], len(text)]
                sizes.append(len(text))
                cuts.append([{"start": a, "end": z} for a, z in merged])
                kept.append(b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2])))
            listed = pa.array(cuts, pa.list_(pa.field("element", pair, False)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), listed, pa.array(kept, pa.binary())], names=out.names)

    return both.mapInArrow(run, out)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, spans, kept): one row per row of ``docs``.

    ``spans`` are the removed runs of the text's UTF-8 bytes, (start, end) with the end exclusive, in
    order and apart from each other; ``kept`` is what is left, which may cut a character. A null text
    is empty; texts shorter than ``length`` lose nothing; of repeated rows and exact copies every one
    loses its repeated bytes, none is spared; ids may be null or repeat; an empty table gives an empty
    result; other columns, whatever their names, are not read.
    """
    if not 1 <= gram <= length - BLOCK:
        raise ValueError("gram: at least 1 byte, and a block shorter than the strings")
    ship_package(docs.sparkSession)
    docs = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_key"))
    stretches = cut(_stretches(docs, length, gram))
    place = F.struct("id", "text_key", "first", "starts", "off")
    different = cut(stretches.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place")))
    per_gram = different.groupBy("gram").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    met = cut(per_gram.where("all > 1").drop("all"))
    filed = cut(different.join(met, "gram").select("gram", "digest", "n", "kinds", "place.*"))
    discard(different)
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("starts") - 1).alias("last")))
    copies = filed.where("n > 1").select("gram", "digest", whole.alias("spans"))
    candidates = cut(_bytes_for(docs, filed.where("kinds > 1").select("id", "text_key", "first", "starts", "off", "gram", "digest", "n", "kinds"), length))
    alone = F.col("n") == 1  # the others are repeated as a whole
    few = _by_suffix_array(candidates.where(F.col("kinds") <= MOST), length)
    many = _by_single_strings(candidates.where(F.col("kinds") > MOST), length)
    parts = few.union(many).join(filed.where(alone).select("gram", "digest"), ["gram", "digest"], "left_semi")
    found = cut(copies.union(parts.select("gram", "digest", "spans")))
    span = F.explode("spans").alias("s")
    here = stretches.join(found, ["gram", "digest"]).select("id", "text_key", "first", span)
    at = F.struct((F.col("first") + F.col("s.first")).alias("first"), (F.col("first") + F.col("s.last")).alias("last"))
    spans = here.groupBy("id", "text_key").agg(F.collect_set(at).alias("at"))
    return _without(docs, id_col, spans, length)
