"""Quality rules: base measures and a hashed n-gram log-likelihood ratio (native).

Words and neighbouring word pairs are hashed into ``BUCKETS`` counts, once for the trusted
texts (those labelled as good) and once for the whole raw corpus. Both multinomials are
smoothed by ``PRIOR`` raw counts a bucket (the trusted side by the same share of its size),
so rare n-grams say little. Each bucket has a log ratio, a whole number of millionths. A document's score is the sum over its n-grams; divided by their number it is
the length-normalised ratio, and a document is kept if that is at least ``THRESHOLD``.
Whole numbers make the verdict the same on every run, in any order and at any size.

Nothing but built-in expressions is used. Counts are pre-aggregated in each task, so at most
``BUCKETS`` rows leave it; the table of ratios has ``BUCKETS`` numbers whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import cut, numbered, restored, settle, words

BUCKETS = 1 << 17
MILLION = 1_000_000
PRIOR = 20.0
THRESHOLD = -0.15  # nats an n-gram
TRUSTED_DOCS = 20_000  # at most so many labelled texts make the target; their ids are broadcast
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
NOT_SYMBOLS = r"[^#*$%&|<>]+"  # fixed value: the symbols are # * $ % & | < >


def _hashes(w: Column, k: int) -> Column:
    """Hash of every run of ``k`` words; none if there are fewer."""
    last = F.size(w) - k
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<bigint>"))


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``__m`` of the base measures and an array ``__w`` of the words."""
    w = settle(docs, __w=words(F.col(text_col)))
    w = settle(w, __h=_hashes(F.col("__w"), 3))
    # Windows with their places in hash order, only where some window repeats.
    some = F.size(F.array_distinct("__h")) < F.size("__h")
    pairs = F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    w = settle(w, __p=F.when(some, pairs)).drop("__h")
    h = lambda i: F.get(F.col("__p"), i)["h"]
    twice = F.filter(
        "__p",
        lambda x, i: F.coalesce(x["h"] == h(i - 1), F.lit(False)) | F.coalesce(x["h"] == h(i + 1), F.lit(False)),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["p"]))
    # A repeat at place p covers p .. p + 2: the gaps between repeats, three at most each.
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(p - a["last"], F.lit(3))).alias("sum")),
        lambda a: a["sum"],
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w = settle(w, __lines=lines)
    m = F.struct(
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return settle(w, __m=m).drop("__p", "__lines")


def _bucket(*run: Column) -> Column:
    return F.pmod(F.xxhash64(*run), F.lit(BUCKETS)).cast("int")


def _buckets(w: Column) -> Column:
    """Buckets of the words and word pairs."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: _bucket(F.get(w, i), F.get(w, i + 1)))
    single = F.transform(w, lambda x: _bucket(x))
    return F.when(F.size(w) > 1, F.concat(single, pairs)).otherwise(single)


def _sum_of_ratios(w: Column, ratios: Column) -> Column:
    """The ratios of all words and word pairs added up, in one walk over the words."""
    worth = lambda *run: F.coalesce(F.get(ratios, _bucket(*run)), F.lit(0))
    n = F.size(w)
    both = lambda i: worth(F.get(w, i)) + F.when(i + 1 < n, worth(F.get(w, i), F.get(w, i + 1))).otherwise(F.lit(0))
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0).cast("long"), lambda a, i: a + both(i))
    return F.when(n > 0, total).otherwise(F.lit(0).cast("long"))


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_DOCS) -> DataFrame:
    """Ids of the trusted texts: those labelled 1 for quality, the ``limit`` of lowest id hash if there are more."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__good")).distinct()
    return good.orderBy(F.xxhash64("__good"), "__good").limit(limit)


def fit_ratios(docs: DataFrame, labels: DataFrame, limit: int = TRUSTED_DOCS) -> DataFrame:
    """One row: ``ratios``, the log ratio of every bucket in millionths (``BUCKETS`` numbers).

    Raw counts are over all documents, trusted ones over the labelled sample. Without
    documents or trusted texts every ratio is that of two empty multinomials, zero.
    """
    good = F.broadcast(trusted_ids(labels, limit))  # ``limit`` rows at most
    w = settle(docs.select("doc_id", "text"), __w=words(F.col("text"))).drop("text")
    w = w.join(good, w.doc_id == good["__good"], "left")
    grams = w.select(F.col("__good").isNotNull().cast("long").alias("good"), F.explode(_buckets(F.col("__w"))).alias("bucket"))
    counts = cut(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good")))
    totals = counts.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("all_raw"), F.coalesce(F.sum("good"), F.lit(0)).alias("all_good")
    )
    all_raw, all_good = totals.first()
    share = all_good / all_raw if all_good else 0.0
    got = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    # The smoothed totals are in the proportion ``share`` too, so it alone remains of them.
    ratio = F.log((got("good") + PRIOR * share) / ((got("raw") + PRIOR) * share)) if share else F.lit(0.0)
    every = docs.sparkSession.range(BUCKETS).join(counts, F.col("id") == F.col("bucket"), "left")
    rows = every.select("id", F.round(ratio * MILLION).cast("int").alias("r"))
    return rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "r"))), lambda x: x["r"]).alias("ratios"))


def score_documents(docs: DataFrame, ratios: DataFrame, threshold: float = THRESHOLD, out: str = "quality") -> DataFrame:
    """``docs`` with its columns as they are and a struct ``out``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_grams, llr (sum in millionths) and kept.

    One row per row of ``docs``. Null and empty texts have no words and fail the base rules;
    repeated rows get equal verdicts; a score equal to the threshold is kept; an empty table
    gives an empty result. A column named ``out`` is replaced, no other. Map-only.
    """
    docs, own = numbered(docs.drop(out))
    w = with_measures(docs, own["text"])
    # A constant of the plan: as a column, all ``BUCKETS`` numbers would be copied along with every row.
    numbers = F.split(F.lit(",".join(map(str, ratios.first()["ratios"]))), ",").cast("array<int>")
    w = settle(w, __llr=_sum_of_ratios(F.col("__w"), numbers)).drop("__w")
    m = F.col("__m")
    grams = F.greatest(2 * m["n_words"] - 1, F.lit(0))
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    kept = ~failed & (F.col("__llr") >= F.lit(round(threshold * MILLION)) * grams)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    q = F.struct(
        *[m[n].alias(n) for n in names],
        failed.alias("base_failed"),
        grams.alias("n_grams"),
        F.col("__llr").alias("llr"),
        kept.alias("kept"),
    )
    return w.select(*restored(w, own), q.alias(out))


def judge_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, out: str = "quality") -> DataFrame:
    """Fit on ``docs`` and ``labels``, then score every document."""
    return score_documents(docs, fit_ratios(docs, labels), threshold, out)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept; their columns, one named ``quality`` included, stay as they are."""
    docs, own = numbered(docs)
    plain = docs.withColumnsRenamed({own[c]: c for c in ("doc_id", "text")})
    judged = judge_documents(plain, labels, threshold, "__quality").where("__quality.kept")
    return judged.select(*[judged[c if c in ("doc_id", "text") else n].alias(c) for c, n in own.items()])
