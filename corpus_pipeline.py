"""The training-data pipeline: every stage reads what the one before it kept.

Quality rules reject documents, SimHash keeps one document of each group of near-duplicates,
decontamination drops documents that hold a benchmark item, the secret scan masks what it
finds in the texts, and the last stage encodes and decodes what is left.

SQL has no XXH64 and no SentencePiece, so there is no oracle; ``tests/llm`` compares the
stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewatch.llm import decontam, quality, secrets, sentencepiece_codec, simhash
from tradewatch.llm.common import cut, table

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentencepiece_codec.codec_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
