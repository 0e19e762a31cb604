"""Resampling of documents towards a target distribution by importance weights.

Every text is a bag of hashed n-grams. What a bucket gains, the logarithm of its share in the target
texts over its share in all documents, is one number of an array; a text's weight is the sum of that
array at its buckets. Weights get Gumbel noise from a hash of the id, so that the highest scores are a
draw without replacement in proportion to the weights.

The exact ranks come from a parallel sort by regular sampling: each run (a part of the scored table)
is sorted locally and gives samples at regular places, the samples give regular splitters, the rows
between two splitters are exchanged to one task each and merged there, and the prefix sums of the
segments' counts make a place in a segment a rank. Segments that lie wholly behind the last rank
asked for are not exchanged at all.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import cut, ship_package

BUCKETS = 10_000
NGRAM = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
MAX_RUNS = 1024  # locally sorted runs, and segments
SAMPLES = 64  # of a run at least, twice as many at most: the driver gets 131,072 rows of five numbers at most

# The bytes of words after A-Z are lower-cased (0-9, a-z, everything beyond ASCII); 0 for all others.
_BYTE = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8
)


def _words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(different words, number of every word of the texts one after another, words of each text)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    low = _BYTE[raw]
    inside = low > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(raw)]  # a text's first byte goes on with no word
    begin[heads] = inside[heads]
    start = np.flatnonzero(begin)
    # With the other bytes left out, a word ends where the next one starts.
    letters = np.concatenate(([0], np.cumsum(inside)))
    ends = np.append(letters[start], letters[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])])
    coded = words.dictionary_encode()
    sizes = np.diff(np.searchsorted(start, offsets))
    return coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64), sizes


def _features(texts: pa.Array, ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its text, words of each text)."""
    names, ids, sizes = _words(texts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    grams, codes, of = names, ids, text
    found, texts_of = [], []
    for k in range(1, ngram + 1):
        if k > 1:  # a run of k words is a run of k - 1 words and the word behind it, in the same text
            same = text[k - 1 :] == text[: len(text) - k + 1]
            pairs = codes[: len(same)] * max(1, len(names)) + ids[k - 1 :]
            different, codes = np.unique(pairs, return_inverse=True)
            grams = [grams[int(p) // len(names)] + b" " + names[int(p) % len(names)] for p in different]
            of = text[: len(same)]
        else:
            same = np.ones(len(codes), bool)
        bucket = np.fromiter((zlib.crc32(g) % buckets for g in grams), np.int64, len(grams))
        found.append(bucket[codes[same]])
        texts_of.append(of[same])
    return np.concatenate(found), np.concatenate(texts_of), sizes


def bucket_counts(docs: DataFrame, text_col: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in every bucket. A task adds up its texts; the driver gets ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(_features(b.column(0), ngram, buckets)[0], minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])

    ship_package(docs.sparkSession)
    per_task = docs.select(docs[text_col].alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Array of a feature's gain by bucket, in whole thousandths of a nat, from the two counts with one added to each."""
    k, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))
    return np.array([math.floor(1000 * math.log(ratio(int(s), int(t)))) for s, t in zip(raw, target)], np.int64)


def weigh(
    docs: DataFrame, gain: np.ndarray, ngram: int = NGRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_features, weight) of every row of ``docs``; ``gain`` has one number a bucket."""
    out = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, text, sizes = _features(b.column(1), ngram, len(gain))
            n = np.bincount(text, minlength=len(sizes))
            total = np.zeros(len(sizes), np.int64)
            np.add.at(total, text, gain[bucket])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(n), pa.array(total)], names=out.names)

    ship_package(docs.sparkSession)
    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text")).mapInArrow(run, out)


def gumbel(id_col: str, seed: int = SEED) -> F.Column:
    """Noise of an id in whole thousandths, from the first 32 bits of a digest of seed and id; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regular samples of a locally sorted run, each with the number of rows it stands for."""
    kept, stride, seen = [], 1, 0
    for b in batches:
        at = np.arange(-seen % stride, b.num_rows, stride)
        kept.append(b.take(pa.array(at)))
        seen += b.num_rows
        while sum(k.num_rows for k in kept) > 2 * SAMPLES:
            whole = pa.Table.from_batches(kept).combine_chunks()
            kept = whole.take(pa.array(np.arange(0, whole.num_rows, 2))).to_batches()
            stride *= 2
    for k in kept:
        yield k.append_column("stands_for", pa.array(np.full(k.num_rows, stride)))


def _place(score: int, ident, n_features: int, row: int) -> tuple:
    """A row's place in the order: highest score, smallest id (nulls last), fewest features, first row."""
    return (-score, ident is None, 0 if ident is None else ident, n_features, row)


def _splitters(samples: list, segments: int) -> list[tuple]:
    """Places that cut the order into about equal segments, from all runs' regular samples."""
    samples = sorted((_place(*s[:4]), s[4]) for s in samples)
    total, done, out = sum(n for _, n in samples), 0, []
    for place, n in samples:
        if out and place == out[-1]:
            continue
        if done * segments >= total * (len(out) + 1) and len(out) < segments - 1:
            out.append(place)
        done += n
    return out


def exact_ranks(scored: DataFrame, id_col: str, top: int | None = None) -> DataFrame:
    """``scored`` (id, score, n_features, row and others; a written table) with ``rank``, 1, 2, 3, ... by
    :func:`_place`; ranks above ``top`` are null. ``row`` sets rows apart that are alike in all else."""
    segments = min(MAX_RUNS, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = [*scored.columns, "rank"]
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("n_features"), F.col("row")]
    runs = scored.select("score", id_col, "n_features", "row").coalesce(MAX_RUNS).sortWithinPartitions(*order)
    kind = T.StructType([*runs.schema.fields, T.StructField("stands_for", T.LongType())])
    cuts = _splitters([tuple(r) for r in runs.mapInArrow(_samples, kind).collect()], segments)
    high = np.array([c[0] for c in cuts], np.int64)

    def segment_of(b: pa.RecordBatch) -> np.ndarray:
        """Number of splitters at or before each row."""
        score = -np.asarray(b.column(b.schema.get_field_index("score")), np.int64)
        out = np.searchsorted(high, score, "left")
        for i in np.flatnonzero(np.searchsorted(high, score, "right") > out):
            r = [b.column(b.schema.get_field_index(c))[int(i)].as_py() for c in ("score", id_col, "n_features", "row")]
            place = _place(*r)
            at = bisect_left(cuts, place)
            out[i] = at + (at < len(cuts) and cuts[at] == place)
        return out

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("segment", pa.array(segment_of(b).astype(np.int32)))

    dealt_type = T.StructType([*scored.schema.fields, T.StructField("segment", T.IntegerType())])
    dealt = scored.mapInArrow(assign, dealt_type)
    count = dict(dealt.groupBy("segment").agg(F.count(F.lit(1))).collect())  # MAX_RUNS rows at most
    before, at = {}, 0
    for s in range(segments):
        before[s], at = at, at + count.get(s, 0)
    top = at if top is None else top
    wanted = [s for s in range(segments) if count.get(s) and before[s] < top]
    last = max(wanted, default=-1)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            segment = np.asarray(b.column(b.num_columns - 1))
            rank = np.empty(len(segment), np.int64)
            for s in np.unique(segment):
                mine = np.flatnonzero(segment == s)
                rank[mine] = before[int(s)] + seen.get(int(s), 0) + 1 + np.arange(len(mine))
                seen[int(s)] = seen.get(int(s), 0) + len(mine)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(rank, mask=rank > top)], names=names
            )

    ranked_type = T.StructType([*scored.schema.fields, T.StructField("rank", T.LongType())])
    behind = dealt.where(F.col("segment") > last).drop("segment").withColumn("rank", F.lit(None).cast("long"))
    if last < 0:
        return behind
    exchanged = dealt.where(F.col("segment") <= last).repartitionById(last + 1, F.col("segment"))
    ranked = exchanged.sortWithinPartitions("segment", *order).mapInArrow(number, ranked_type)
    return ranked.union(behind)


def importance_ranks(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, ngram: int = NGRAM,
    buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank): one row per row of ``docs``; rank is null for a row not drawn.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn.
    Null, empty and wordless texts have no features, weight 0 and their noise as score; of equal
    scores the smaller id comes first, null ids last, then fewer features, then the row written
    first; repeated rows are ranked one by one; a null id has the noise of an empty one; empty
    documents give an empty result and an empty target leaves all shares to the added ones; other
    columns, whatever their names, are not read. The scored rows are written once, to
    ``spark.checkpoint.dir``, so that all passes of the sort see the same runs.
    """
    if not re.fullmatch(r"tinyint|smallint|int|bigint|string|date", docs.schema[id_col].dataType.simpleString()):
        raise ValueError("ids: whole numbers, strings or dates")
    gain = gains(bucket_counts(docs, text_col, ngram, buckets), bucket_counts(target, target_col, ngram, buckets))
    weighed = weigh(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), gain, ngram, "id")
    scored = cut(
        weighed.withColumn("score", F.col("weight") + gumbel("id", seed)).withColumn("row", F.monotonically_increasing_id())
    )
    able = F.col("n_words") >= min_words
    top = scored.where(able).count() * percent // 100
    few = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    ranked = exact_ranks(scored.where(able), "id", top).union(few)
    return ranked.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The drawn documents, all columns as they are. An id names a document: rows that share an id are
    drawn together if one of them is; rows without an id are never drawn."""
    drawn = importance_ranks(docs, target, id_col=id_col, **how).where("rank IS NOT NULL")
    return docs.join(drawn.select(F.col(id_col).alias(id_col)).distinct(), id_col, "left_semi").select(*docs.columns)
