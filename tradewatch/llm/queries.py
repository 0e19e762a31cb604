"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm import decontam as D
from tradewatch.llm import importance as I
from tradewatch.llm import periodic_runs as PR
from tradewatch.llm import quality as Q
from tradewatch.llm import secrets as X
from tradewatch.llm import sentencepiece_codec as SP
from tradewatch.llm import sharding as SH
from tradewatch.llm import simhash as S
from tradewatch.llm import substring_dedup as SD
from tradewatch.llm import suffix_dedup as SA
from tradewatch.llm import token_counts as TC
from tradewatch.llm import url_filter as U
from tradewatch.llm import warc as W
from tradewatch.llm.common import settle, table, words


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, shard_slot and shard of every document."""
    return SH.assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    return S.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, log-likelihood ratio and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = Q.judge_documents(docs, table(spark, sf_dir, "labels"))
    first = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_grams", "llr")
    return q.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in first])


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return U.judge_urls(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the window."""
    return D.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return TC.count_tokens(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets of every document."""
    found = X.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda i: F.size(F.filter("secrets", lambda s: s["order"] == i)).cast("long")
    base = X.spans_text(F.filter("secrets", lambda s: s["order"] < len(X.BASE_RULES)))
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        X.spans_text(F.col("secrets")).alias("spans"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids, byte spans and decoded text of every document."""
    return SP.codec_digests(table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that shares a passage with another, with its class and the passages."""
    return SD.repeated_passages(table(spark, sf_dir, "documents"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every revisit of a crawl derived from ``pages``."""
    revisits, responses = W.page_captures(table(spark, sf_dir, "pages"))
    done = W.resolve_revisits(revisits, responses)
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"])))
    return done.select(
        F.col("record_id").alias("page_id"), "url", "ts", "response_id", "response_ts", "outcome",
        F.array_join(pairs, "; ").alias("headers"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, weight, score and rank of every document; ``benchmark`` is the target."""
    ranked = I.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def _with_periods(docs: DataFrame) -> DataFrame:
    """The query's input: one text in ten, by its id's CRC-32, goes on with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = settle(docs.select("doc_id", "text", g.alias("g"), (h % 10 == 0).alias("on")), w=F.when(F.col("on"), words(F.col("text"))))
    n, a = F.size("w"), F.col("g") % F.size("w")
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    sized = settle(chosen.withColumn("on", F.col("on") & (n > 0)), a=F.when(F.col("on"), a), p=F.when(F.col("on"), p))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i)))
    return sized.select("doc_id", F.when(F.col("on"), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, best run and digests of the runs of every document."""
    found = PR.periodic_runs(_with_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    better = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", 0),
        lambda kept, r: F.when(better(r, kept) > 0, r).otherwise(kept),
    )
    return settle(found, best=best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and runs, and digest of what is left of every document."""
    left = SA.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return left.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filters": op4_url_filters,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_secret_scans": op7_secret_scans,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_suffix_dedup": op13_suffix_dedup,
}
