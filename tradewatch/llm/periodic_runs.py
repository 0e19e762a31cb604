"""Periodic runs in the words of texts, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q and at least ``max(min_length,
exponent * q)`` words that no neighbouring word extends. Periods under ``SHORT`` are found by
direct lag scans: words are compared with the words q places on. Longer periods fall into bands
``[w, 1.5 w)`` and ``[1.5 w, 2 w)`` for w = 8, 16, 32, ... For every band the hashes of grams as
long as the band's longest period are reduced to the minima of sliding windows. Inside a run the
minima stand again one period on, and as a gram spans a whole period it stands nowhere between:
two successive equal minima whose distance lies in the band name the run's exact period and a
place in it. A window and its gram fill two periods at most, so that a run of three periods always
holds such a pair. Every pair is a seed: it is extended word by word at its distance, which also
settles what equal hashes only suggest, and kept if the stretch is long enough and no shorter
period fits it.

Texts are worked on in blocks of many texts joined by words that occur once, so that numpy runs
over long arrays; a very long text is a block of its own. There is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradewatch.llm.common import ship_package

MIN_LENGTH = 24
EXPONENT = 3
SHORT = 8
BLOCK_BYTES = 8 << 20  # text joined into one block

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of pairs of 64-bit hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x165667B19E3779F9)
    return x ^ (x >> np.uint64(32))


def _equal_from(x: np.ndarray, at: int, q: int) -> int:
    """First i >= at with x[i] != x[i + q], or where x ends."""
    end, step = len(x) - q, 64
    while at < end:
        to = min(end, at + step)
        off = np.flatnonzero(x[at:to] != x[at + q : to + q])
        if len(off):
            return at + int(off[0])
        at, step = to, step * 2
    return end


def _equal_back(x: np.ndarray, at: int, q: int) -> int:
    """Smallest i <= at such that x[j] == x[j + q] for all i <= j < at."""
    step = 64
    while at > 0:
        to = max(0, at - step)
        off = np.flatnonzero(x[to:at] != x[to + q : at + q])
        if len(off):
            return to + int(off[-1]) + 1
        at, step = to, step * 2
    return 0


def _is_smallest(x: np.ndarray, start: int, length: int, q: int) -> bool:
    """No period under q fits a stretch of at least two periods q: such a period's greatest common
    divisor with q would fit as well, so the largest proper divisors of q are all that has to be tried."""
    rest, r = q, 2
    while rest > 1:
        if r * r > rest:
            r = rest
        if rest % r == 0:
            if _equal_from(x[start : start + length], 0, q // r) == length - q // r:
                return False
            while rest % r == 0:
                rest //= r
        r += 1
    return True


def _lag_scans(x: np.ndarray, least) -> Iterator[tuple[int, int, int]]:
    """(start, length, q) of the maximal stretches with a period under ``SHORT``."""
    for q in range(1, min(SHORT, len(x))):
        breaks = np.concatenate(([-1], np.flatnonzero(x[q:] != x[:-q]), [len(x) - q]))
        same = np.diff(breaks) - 1
        for i in np.flatnonzero(same >= least(q) - q):
            yield int(breaks[i]) + 1, int(same[i]) + q, q


def _minima(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the minima (the first of equal ones) of all windows, each place once, ascending."""
    low = np.uint64((1 << len(h).bit_length()) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    t = 1
    while t < window:
        key = np.minimum(key[:-t], key[t:])
        t *= 2
    at = (key & low).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def _seeds(h: np.ndarray, window: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of successive equal minima at a distance in [low, high), by distance and place."""
    at = _minima(h, window)
    order = np.argsort(h[at], kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    far = b - a
    ok = (h[a] == h[b]) & (far >= low) & (far < high)
    a, far = a[ok], far[ok]
    order = np.lexsort((a, far))
    return a[order], far[order]


def _extended(x: np.ndarray, a: np.ndarray, far: np.ndarray, least) -> Iterator[tuple[int, int, int]]:
    """(start, length, q) of the maximal stretches around the seeds; a stretch's further seeds are skipped."""
    i = 0
    while i < len(a):
        q = int(far[i])
        end = _equal_from(x, int(a[i]), q)
        start = _equal_back(x, int(a[i]), q) if end > a[i] else end
        if end - start + q >= least(q):
            yield start, end - start + q, q
        to = i + int(np.searchsorted(far[i:], q, "right"))
        i += max(1, int(np.searchsorted(a[i:to], end, "left")))


def find_runs(
    ids: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of many texts: ``ids`` are their words' numbers one text after another (equal words have
    equal numbers, none is negative), ``sizes`` the texts' word counts.

    Returns (text, run): run has the columns start, length, period; by text, start, period.
    """
    if exponent < 3 or min_length < 3 * SHORT:
        raise ValueError(f"exponent: 3 or more, min_length: {3 * SHORT} or more")

    def least(q: int) -> int:
        return max(min_length, exponent * q)

    # Longest texts first, so that the texts long enough for a scale are the front of the block.
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= min_length]
    n = sizes[order]
    none = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    if not len(order):
        return none
    first = np.cumsum(n + 1) - (n + 1)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    x = np.empty(len(within) + len(n), np.int64)
    x[np.repeat(first, n) + within] = ids[np.repeat(begins[order], n) + within]
    x[first + n] = -1 - np.arange(len(n))

    found = set(_lag_scans(x, least))
    grams = _mix(x.astype(np.uint64), np.uint64(0) * x.astype(np.uint64))
    half, g = None, 1  # hashes of grams of g // 2 and of g words
    while g < SHORT:
        half, grams, g = grams, _mix(grams[:-g], grams[g:]), 2 * g
    while True:
        texts = int(np.searchsorted(-n, -exponent * g, "right"))
        if not texts:
            break
        end = int(first[texts - 1] + n[texts - 1]) + 1
        x, half, grams = x[:end], half[: end - g // 2 + 1], grams[: end - g + 1]
        longer = _mix(grams[: end - g * 3 // 2 + 1], half[g:])
        double = _mix(grams[:-g], grams[g:])
        for h, window, low, high in ((longer, g // 2, g, g * 3 // 2), (double, g, g * 3 // 2, 2 * g)):
            found.update(_extended(x, *_seeds(h, window, low, high), least))
        half, grams, g = grams, double, 2 * g
    return _placed(found, first, n, order, ids, begins)


def _placed(found, first, n, order, ids, begins) -> tuple[np.ndarray, np.ndarray]:
    """The stretches that have no shorter period, by text."""
    rows = []
    for start, length, q in found:
        at = int(np.searchsorted(first, start, "right")) - 1
        text = int(order[at])
        start -= int(first[at])
        words = ids[begins[text] : begins[text] + n[at]]
        if _is_smallest(words, start, length, q):
            rows.append((text, start, length, q))
    rows = np.array(sorted(rows, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)
    return rows[:, 0], rows[:, 1:]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words (runs of anything but ASCII blanks) of texts one after another, and their count in each."""
    parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    offsets = np.asarray(parts.offsets, np.int64)
    values = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    word = np.asarray(pc.not_equal(values, ""))
    count = np.concatenate(([0], np.cumsum(word)))
    return values.filter(pa.array(word)), np.diff(count[offsets - offsets[0]])


def joined(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Texts of ``sizes`` words each, joined by one space."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), pa.scalar(" ", words.type))


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, count) of successive texts of about ``BLOCK_BYTES`` together, one at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    block = (np.cumsum(size) - size) // BLOCK_BYTES
    at = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(size) else []
    yield from zip(at, np.diff(np.append(at, len(size))))


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_length: int = MIN_LENGTH, exponent: int = EXPONENT,
) -> DataFrame:
    """(id, n_words, runs, collapsed): one row per row of ``docs``.

    ``runs`` is an array of (start, length, period) in words, by start and then period; ``collapsed``
    is the text's words without those that any run holds after its first period, joined by one
    space. A null, empty or blank text has no words, no runs and an empty ``collapsed``; a null id
    and repeated rows are kept as they are; runs may overlap, each is reported; an empty table
    gives an empty result; other columns, whatever their names, are not read.
    """
    out = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN, False)),
        T.StructField("collapsed", T.StringType()),
    ])

    def block(texts: pa.Array) -> list[pa.Array]:
        words, sizes = split_words(texts)
        ids = np.asarray(words.dictionary_encode().indices, np.int64)
        text, runs = find_runs(ids, sizes, min_length, exponent)
        begins = np.cumsum(sizes) - sizes
        keep = np.ones(len(ids), bool)
        for t, (start, length, period) in zip(text, runs):
            keep[begins[t] + start + period : begins[t] + start + length] = False
        kept = np.concatenate(([0], np.cumsum(keep)))
        left = joined(words.filter(pa.array(keep)), kept[begins + sizes] - kept[begins])
        cells = pa.StructArray.from_arrays(
            [pa.array(runs[:, i]) for i in range(3)],
            fields=[pa.field(c, pa.int64(), False) for c in RUN.names],
        )
        offsets = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(sizes))))).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), cells, type=pa.list_(pa.field("element", cells.type, False)))
        return [pa.array(sizes), listed, left.cast(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, count in _blocks(b.column(1)):
                part = b.slice(first, count)
                yield pa.RecordBatch.from_arrays([part.column(0), *block(part.column(1))], names=out.names)

    ship_package(docs.sparkSession)
    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text")).mapInArrow(run, out)
