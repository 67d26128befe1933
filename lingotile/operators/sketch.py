"""Tokenizer summaries from stored sketches, merged as data arrive.

A sketch table has one row per (language, tokenizer): the document count, the
sum, least and greatest token count, the special tokens seen (a few at most)
and an HLL sketch of the other distinct tokens.  Such tables are kept beside
the data they describe, put together with those of new data, and read as the
summary of ``compare.summarize_tokenizers`` without the texts.  Counts and
token statistics are exact, the two vocabulary sizes are estimates with a
relative standard error of about ``1.04 / sqrt(2 ** log_k)`` (``error``).

Only sketches are shuffled: a map task sends a row per language and tokenizer,
however many distinct tokens it has seen.  Null texts have no tokens; no rows
give an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lingotile.functions.text import SPECIALS_WORD, TokenizerSpec
from lingotile.operators.tokensets import token_sets

LOG_K = 14


def error(log_k: int = LOG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (log_k / 2)


def sketch_tokenizers(df: DataFrame, specs: list[TokenizerSpec], text_col: str = "text", lang_col: str = "lang",
                      group_col: str | None = None, log_k: int = LOG_K, key: str = "doc_id") -> DataFrame:
    """``(language, tokenizer, num_samples, sum_tokens, min_tokens, max_tokens,
    specials_seen, sketch)``, one row per language and tokenizer."""
    if any(s.safe for s in specs):
        raise ValueError("a tokenizer that may fail has no sketch: its summary depends on where it fails")
    for s in specs:
        if s.prepare is not None:
            df = s.prepare(df, text_col, key)
    # Header rows carry the token counts, so one pass makes both.
    rows = token_sets(df, specs, text_col, lang_col, group_col or lang_col)
    special = F.lit(False)
    for s in specs:
        special = F.when(F.col("tokenizer") == s.name, F.col("token").isin(*SPECIALS_WORD[:s.n_special])).otherwise(special)
    return rows.groupBy("language", "tokenizer").agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("num_samples"), F.sum("sum_n").alias("sum_tokens"),
        F.min("min_n").alias("min_tokens"), F.max("max_n").alias("max_tokens"),
        F.array_sort(F.collect_set(F.when(special, F.col("token")))).alias("specials_seen"),
        F.hll_sketch_agg(F.when(~special, F.col("token")), log_k).alias("sketch"))


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """One sketch table of the data of all ``tables``."""
    return reduce(DataFrame.unionByName, tables).groupBy("language", "tokenizer").agg(
        F.sum("num_samples").alias("num_samples"), F.sum("sum_tokens").alias("sum_tokens"),
        F.min("min_tokens").alias("min_tokens"), F.max("max_tokens").alias("max_tokens"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("specials_seen")))).alias("specials_seen"),
        F.hll_union_agg("sketch").alias("sketch"))


def sketched_summary(sketches: DataFrame, specs: list[TokenizerSpec],
                     vocab_sizes: dict[str, int] | None = None) -> DataFrame:
    """The columns of ``summarize_tokenizers`` but ``error``; ``avg_tokens`` is
    the exact quotient."""
    fixed = [(s.name, s.n_special, (vocab_sizes or {}).get(s.name)) for s in specs]
    sizes = sketches.sparkSession.createDataFrame(fixed, "tokenizer string, _special bigint, _fixed bigint")
    whole = Window.partitionBy("tokenizer")   # languages x tokenizers rows
    observed = F.hll_sketch_estimate("sketch") + F.size("specials_seen")
    every = F.hll_sketch_estimate(F.hll_union_agg("sketch").over(whole))
    return sketches.join(F.broadcast(sizes), "tokenizer").select(
        "language", "tokenizer", F.col("num_samples").cast("bigint").alias("num_samples"),
        (F.col("sum_tokens") / F.col("num_samples")).alias("avg_tokens"), "min_tokens", "max_tokens",
        F.when(observed > 0, observed).cast("bigint").alias("observed_vocab_size"),
        F.coalesce("_fixed", F.col("_special") + every).cast("bigint").alias("tokenizer_vocab_size"))
