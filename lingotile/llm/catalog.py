"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.llm import (language, minhash, multi_index, pack, periodic, pieces, quality, repair, secrets, sentences,
                            shard, substrings, urls)
from lingotile.llm.common import table


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op2_word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = pieces.digests(F.col("text"), tokenizer_file("piece_bpe_32k.model"))
    return docs.select("doc_id", made.alias("_r")).select("doc_id", "_r.*")


def op5_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", secrets.report(F.col("text")).alias("_r")).select("doc_id", "_r.*")


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.trim(table(spark, sf_dir, "documents"))


def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(table(spark, sf_dir, "documents"), shards=8)


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_inverted_multi_index": op1_inverted_multi_index,
    "op2_word_backoff_language": op2_word_backoff_language,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_bin_completion_packing": op5_bin_completion_packing,
    "op6_secret_scan": op6_secret_scan,
    "op7_host_quality": op7_host_quality,
    "op8_sentence_spans": op8_sentence_spans,
    "op9_hash_tree_shards": op9_hash_tree_shards,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_url_filter": op13_url_filter,
}

ORACLES: dict[str, str] = {
    "op7_host_quality": quality.REPORT_SQL,
    "op13_url_filter": urls.JUDGE_SQL,
}
