"""Corpus pipeline: quality rules, near-dedup, substring dedup, secret masking, packing.

Each stage gets all that the one before kept, written as Parquet.  ``docs``
columns other than ``text`` and ``n_chars`` pass through unchanged; where a
stage changes a text, ``n_chars`` (if there is one) is counted anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.llm import catalog, minhash, pack, quality, secrets, substrings
from lingotile.llm.common import materialize, prepare, table


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their own rules, or whose host is rejected, go."""
    prepare(spark)
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    prepare(spark)
    return minhash.deduplicated(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 bytes that occur elsewhere go; documents stay."""
    prepare(spark)
    return _recounted(substrings.without_repeats(docs))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found becomes a mark; documents stay."""
    prepare(spark)
    return _recounted(docs.withColumn("text", secrets.masked(F.col("text"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece: where it lies in which sequence."""
    prepare(spark)
    return pack.pack(docs, catalog.tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_masking", secret_masking),
    ("packing", packing),
]

# Tokenizing and MinHash have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
