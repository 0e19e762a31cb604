"""Benchmark decontamination by item-sized windows (native).

For every benchmark item the windows of a text that have as many words as the item are
compared with it by the exact weighted similarity of the two bags of shingles. Bags that are
similar by t have at least ``t * m`` shingles of each bag's m in common, so in any order of
the shingles the smallest common one is among the first ``m - t * m + 1`` of either bag:
windows and items meet in an equi-join of these few, and no similar pair is missed.

Only windows that can pass are taken. A bag of m shingles that is similar to an
item's by t shares at least ``t * 2m / (1 + t)`` of them, so a window needs that many places
whose shingle some item of its size has. Those places are found in two steps: a bit table of
fixed size, filled from the benchmark's shingles, drops nearly every text in the scan
without a shuffle; what is left meets the benchmark's shingles in an equi-join.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import cut, numbered, restored, settle, words

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
TABLE_BITS = 1 << 23  # of the bit table, one megabyte whatever the benchmark


def _runs(w: Column, k: int) -> Column:
    """Hash of every run of ``k`` words; none if there are fewer."""
    last = F.size(w) - k
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(w, i + 1, k))))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _split(df: DataFrame, text_col: str) -> DataFrame:
    return settle(df, w=words(F.lower(F.col(text_col))))


def shared_least(total: Column, t: Fraction = SIMILARITY) -> Column:
    """Fewest common shingles of two bags of ``total`` shingles together whose similarity is t or more."""
    # c / (total - c) >= t in whole numbers, rounded up.
    up, down = t.numerator, t.numerator + t.denominator
    return F.floor((total * up + (down - 1)) / F.lit(down)).cast("int")


def bit_table(hashes: DataFrame) -> DataFrame:
    """One row: ``bits``, an array of ``TABLE_BITS / 64`` longs with two bits set for each hash."""
    at = F.explode(F.array(*[F.pmod(F.shiftrightunsigned("h", s), F.lit(TABLE_BITS)) for s in (0, 32)]))
    spots = hashes.select(at.alias("at")).select(
        F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit")
    )
    filled = spots.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = hashes.sparkSession.range(TABLE_BITS // 64).join(filled, F.col("id") == F.col("word"), "left")
    rows = every.select("id", F.coalesce("bits", F.lit(0)).cast("long").alias("bits"))
    return rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"]).alias("bits"))


def in_table(bits: Column, h: Column) -> Column:
    def is_set(shift: int) -> Column:
        at = F.pmod(F.shiftrightunsigned(h, shift), F.lit(TABLE_BITS))
        word = F.get(bits, F.shiftright(at, 6).cast("int"))
        # A long shifted left by 63 less the place has the bit as its sign.
        return F.call_function("shiftleft", word, (F.lit(63) - at.bitwiseAND(F.lit(63))).cast("int")) < 0

    return is_set(0) & is_set(32)


def first_shingles(bag: Column, t: Fraction = SIMILARITY) -> Column:
    """The smallest shingles of a bag, of which every bag similar by t has one among its own."""
    n = F.size(bag)
    common = F.floor((n * t.numerator + (t.denominator - 1)) / F.lit(t.denominator)).cast("int")
    return F.array_distinct(F.slice(F.array_sort(bag), F.lit(1), n - common + 1))


def common_weight(a: Column, b: Column) -> Column:
    """Shingles that two bags have in common, each as often as in both."""
    times = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    both = F.array_intersect(a, b)
    return F.aggregate(both, F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))


def _items(benchmark: DataFrame, k: int) -> DataFrame:
    """(item_id, n_words, bag) of the items with that shingle length: ``k`` words, or all of a shorter item's."""
    w = _split(benchmark.select("item_id", "text"), "text")
    n = F.size("w")
    fits = n >= SHINGLE if k == SHINGLE else n == k
    return settle(w.where(fits), bag=_runs(F.col("w"), k)).select("item_id", F.size("w").alias("n_words"), "bag")


def _matches(docs: DataFrame, items: DataFrame, k: int, t: Fraction) -> DataFrame:
    """(doc_id, item_id, window_start, window_words, similarity) for items of one shingle length."""
    sized = cut(items.select("n_words", F.explode("bag").alias("h")).distinct())
    bits = cut(bit_table(sized.select("h").distinct()))
    # Texts with a place whose shingle may be in the benchmark; a text is its key and its hashes.
    hashed = settle(_split(docs, "text"), h=_runs(F.col("w"), k)).select("doc_id", F.xxhash64("text").alias("key"), "h")
    looked = hashed.select("*", bits.scalar().alias("bits"))
    maybe = F.filter(F.transform("h", lambda x, i: F.when(in_table(F.col("bits"), x), i)), lambda x: x.isNotNull())
    texts = cut(settle(looked, maybe=maybe).where(F.size("maybe") > 0).select("doc_id", "key", "h", "maybe").distinct())
    places = texts.select("doc_id", "key", F.size("h").alias("n"), "h", F.explode("maybe").alias("p"))
    places = places.select("doc_id", "key", "n", "p", F.get("h", F.col("p")).alias("h")).join(sized, "h")
    # By text and size, the places that count; each text's own list is no longer than the text.
    lists = places.groupBy("doc_id", "key", "n", "n_words").agg(F.sort_array(F.collect_set("p")).alias("ps"))
    m = F.least(F.col("n_words") - (k - 1), F.col("n"))  # a shorter text is one window itself
    lists = settle(lists, m=m, least=shared_least(m + F.col("n_words") - (k - 1), t)).where(F.size("ps") >= F.col("least"))
    # A window's first counting place is at most m - least from its start.
    valid = F.filter("ps", lambda p: p - (F.col("m") - F.col("least")) <= F.col("n") - F.col("m"))
    lists = settle(lists, ps2=valid)
    near = F.flatten(
        F.transform(
            "ps2",
            lambda p: F.sequence(
                F.greatest(F.lit(0), p - (F.col("m") - F.col("least"))), F.least(p, F.col("n") - F.col("m"))
            ),
        )
    )
    starts = lists.select("doc_id", "key", "n_words", "m", "least", "ps", F.explode(F.array_distinct(near)).alias("start"))
    inside = F.size(F.filter("ps", lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("m"))))
    starts = starts.where(inside >= F.col("least")).drop("ps")
    same = lambda c: F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    windows = starts.alias("a").join(texts.alias("b"), same("doc_id") & (F.col("a.key") == F.col("b.key"))).select(
        "a.doc_id", "a.key", "n_words", "start", "m", F.slice(F.col("h"), F.col("start") + 1, F.col("m")).alias("bag")
    )
    probe = windows.select("*", F.explode(first_shingles(F.col("bag"), t)).alias("first"))
    asked = items.withColumnRenamed("bag", "item_bag")
    table = asked.select("*", F.explode(first_shingles(F.col("item_bag"), t)).alias("first"))
    pairs = probe.join(table, ["n_words", "first"])
    pairs = pairs.select("doc_id", "key", "item_id", "start", "m", "n_words", "bag", "item_bag").distinct()
    pairs = settle(pairs, c=common_weight(F.col("bag"), F.col("item_bag")))
    total = F.size("bag") + F.size("item_bag") - F.col("c")
    good = pairs.where(F.col("c") * t.denominator >= total * t.numerator)
    return good.select(
        "doc_id", "key", "item_id", "start", (F.col("m") + (k - 1)).alias("length"), (F.col("c") / total).alias("similarity")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, t: Fraction = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, window_start, window_words, similarity): one row per document and item found in it.

    The window is the most similar one, the first of equals; places are in words, from 0.
    Words are compared in lower case, in shingles of five. An item of fewer words is
    one shingle; one without words is in no text; a text shorter than an item is one window.
    Null and empty texts hold nothing; a null doc_id is kept as it is; rows with equal doc_id
    and text give one row per item, as do repeated items; empty tables give an empty result;
    other columns are not read.
    """
    docs, benchmark = docs.select("doc_id", "text"), benchmark.select("item_id", "text").distinct()
    n = F.least(F.size(words(F.col("text"))), F.lit(SHINGLE))
    lengths = sorted(r.k for r in benchmark.select(n.alias("k")).distinct().collect() if r.k)  # five numbers at most
    found = None
    for k in lengths:
        one = _matches(docs, _items(benchmark, k), k, t)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = docs.where("false").select(
            "doc_id", F.lit(0).cast("long").alias("key"), F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
            F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(0.0).alias("similarity"),
        )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), F.col("length").alias("length"))).alias("b")
    return found.groupBy("doc_id", "key", "item_id").agg(best).groupBy("doc_id", "item_id").agg(F.max("b").alias("b")).select(
        "doc_id",
        "item_id",
        (-F.col("b.back")).cast("int").alias("window_start"),
        F.col("b.length").cast("int").alias("window_words"),
        F.round("b.similarity", 6).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, t: Fraction = SIMILARITY) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; columns and other rows stay as they are."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = cut(contaminated(texts, benchmark, t).select(F.col("doc_id").alias("__bad")).distinct())
    docs, own = numbered(docs)
    keyed = docs.withColumn("__key", F.xxhash64(own["text"]))
    clean = keyed.join(bad, F.col("__key") == F.col("__bad"), "left_anti")
    return clean.select(*restored(clean, own))
