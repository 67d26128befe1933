"""Table-backed corpora (parquet and any other Spark source)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when a scan yields fewer partitions than the
    cluster has cores (a small file with one row group is one task).  Large
    inputs already have many splits and are returned unchanged, so no
    shuffle is added at scale."""
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def corpus_from_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str | None = "lang", order_col: str | None = None,
                      balance: bool = True) -> DataFrame:
    """Normalise any table into the corpus shape
    ``(doc_id, doc_ord, lang, text)``; null text is treated as ``""``.
    ``order_col`` (default: the id) defines corpus order."""
    order = F.col(order_col or id_col).cast("bigint")
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    out = df.select(F.col(id_col).cast("bigint").alias("doc_id"), order.alias("doc_ord"),
                    lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return spread(out) if balance else out
