"""Table loading and corpus shaping shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.sources.tables import corpus_from_table, spread

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Unit separator: joins token lists into one comparable string.
US = "\u001f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: ``doc_ord = doc_id`` (documents are read in id order)."""
    return corpus_from_table(table(spark, sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as a corpus ordered by ``(conv_id, turn)``; the
    ordinal packs both into one BIGINT (turn < 2^20)."""
    c = table(spark, sf_dir, "conversations")
    return spread(c).select(
        (F.shiftleft(F.col("conv_id"), 20) + F.col("turn")).alias("doc_id"),
        (F.shiftleft(F.col("conv_id"), 20) + F.col("turn")).alias("doc_ord"),
        "conv_id", "turn", "role", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def joined(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col, US)


def joined_ids(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(col, lambda i: i.cast("string")), ",")
