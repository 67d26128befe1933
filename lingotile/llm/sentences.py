"""Substring dedup on sliding sentence spans.

From every sentence of a text starts a span and at every sentence ends one:
the shortest run of consecutive sentences with at least ``least`` sentences
and ``min_words`` words.  Together they cover every longer run, so a repeated
run of any length goes whole.  Spans are compared by a 128-bit hash of their
words over all texts.  A span that occurs twice or more keeps its first
occurrence, by id and then position; every sentence covered by any other
occurrence is removed.

A sentence ends at ``.``, ``!`` or ``?`` (and closing quotes) followed by white space, at the full
stop, question or exclamation mark of another script, or at a line end; it
carries the closing quotes and white space after it, so the sentences that
stay join to the new text.  In scripts written without spaces a character
counts as a word.  Edge cases: null texts stay null, empty and blank texts have
no sentences; a text too short for a span keeps all; of repeated rows the
first stays whole; an empty table gives an empty result.  The input is read
twice and must be a deterministic scan.
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize

LEAST, MIN_WORDS = 2, 20
# A span with over one in so many of all repeated occurrences is hot: fewer spans than this can be.
HOT_SHARE = 1000
# Full stops, question and exclamation marks that need no white space after
# them: CJK, Devanagari, Arabic, Armenian, Ethiopic, Khmer, Burmese, Tibetan, Mongolian.
MARKS = "\u3002\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u0589\u1362\u1367\u1368\u17d4\u17d5\u104a\u104b\u0f0d\u0f0e\u1803\u1809"
CLOSING = "\"')\\]\u2019\u201d\u300b\u300d\u300f\u3011\uff09"
END = re.compile(rf"[.!?]+[{CLOSING}]*\s+|[{MARKS}][{MARKS}.!?]*[{CLOSING}]*\s*|\n\s*")
# Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = ("\u0e01-\u0eff\u0f40-\u0fbc\u1000-\u1049\u1050-\u109f\u1780-\u17d3\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff"
            "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
UNIT = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")


def sentences_of(text: str | None) -> list[str]:
    """Consecutive pieces of ``text``, each with a word."""
    out: list[str] = []
    at = 0
    if not text:
        return out
    for m in END.finditer(text):
        out.append(text[at:m.end()])
        at = m.end()
    out.append(text[at:])
    joined: list[str] = []
    for s in out:
        if s.strip() and not (joined and not joined[-1].strip()):
            joined.append(s)
        elif joined:
            joined[-1] += s  # blank pieces go with what stands before (or, at the start, after)
        elif s:
            joined.append(s)
    return joined if joined and joined[0].strip() else []


def words_in(sentence: str) -> int:
    """Words between white space; where words are not spaced, characters."""
    words = sentence.split()
    if sentence.isascii() or not HAS_UNSPACED.search(sentence):
        return len(words)
    return sum(len(UNIT.findall(w)) or 1 for w in words)


def spans_of(sentences: list[str], least: int, min_words: int) -> list[tuple[int, int, bytes]]:
    """``(first, count, hash)`` of the spans that start or end at each sentence."""
    lines = [" ".join(s.split()) for s in sentences]
    length = [0, *accumulate(map(words_in, sentences))]
    runs, end = [], 0
    for i in range(len(lines)):
        end = max(end, i + least)
        while end <= len(lines) and length[end] - length[i] < min_words:
            end += 1
        if end > len(lines):
            break
        runs.append((i, end))
    start = 0
    for end in range(least, len(lines) + 1):
        while start < end - least and length[end] - length[start + 1] >= min_words:
            start += 1
        # A shortest run from ``start`` may end here too: it is there already.
        if length[end] - length[start] >= min_words and runs[start] != (start, end):
            runs.append((start, end))
    return [(i, end - i, hashlib.blake2b("\n".join(lines[i:end]).encode("utf-8", "replace"), digest_size=16).digest())
            for i, end in runs]


def spans(text: Column, least: int, min_words: int) -> Column:
    @F.pandas_udf("first array<int>, n array<int>, hash array<binary>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = spans_of(sentences_of(t), least, min_words)
            rows.append(([f[0] for f in found], [f[1] for f in found], [f[2] for f in found]))
        return pd.DataFrame(rows, columns=["first", "n", "hash"])

    return run(text)


def _trimmed(text: Column, first: Column, n: Column) -> Column:
    @F.pandas_udf("n_sentences bigint, n_removed bigint, text string")
    def run(texts: pd.Series, firsts: pd.Series, ns: pd.Series) -> pd.DataFrame:
        rows = []
        for t, f, k in zip(texts, firsts, ns):
            s = sentences_of(t)
            gone = np.zeros(len(s), bool)
            if f is not None:
                for a, b in zip(f, k):
                    gone[a:a + b] = True
            rest = t if not gone.any() else "".join(x for x, g in zip(s, gone) if not g)
            rows.append((len(s), int(gone.sum()), rest))
        return pd.DataFrame(rows, columns=["n_sentences", "n_removed", "text"])

    return run(text, first, n)


def trim(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
         min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_sentences, n_removed, text)`` per row, ``text`` without the
    removed sentences."""
    rows = docs.select(F.monotonically_increasing_id().alias("_rid"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    each = rows.select("doc_id", "_rid", spans(F.col("text"), least, min_words).alias("_s")).select(
        "doc_id", "_rid", F.explode(F.arrays_zip("_s.hash", "_s.first", "_s.n")).alias("_s")).select(
        "_s.hash", "doc_id", "_rid", "_s.first", "_s.n")
    # Copies of a span meet in a partial aggregation; only spans that repeat are joined back.
    first = materialize(each.groupBy("hash").agg(F.min(F.struct("doc_id", "_rid", "first")).alias("_at"), F.count(F.lit(1)).alias(
        "_k")).where("_k > 1").select("hash", "_k", F.col("_at._rid").alias("_rid0"), F.col("_at.first").alias("_first0")), "repeated")
    # Hot spans, fewer than HOT_SHARE whatever the corpus, are looked up in each
    # task; their rows take a key of their own that nothing else has, so the
    # join of the others has no hot key.
    hot = F.col("_k") * HOT_SHARE > (first.agg(F.sum("_k")).first()[0] or 0)
    known = each.join(F.broadcast(first.where(hot).select("hash", F.col("_rid0").alias("_rid1"), F.col("_first0").alias(
        "_first1"))), "hash", "left")
    own = F.unhex(F.md5(F.concat_ws(":", "_rid", "first").cast("binary")))
    known = known.withColumn("_key", F.when(F.col("_rid1").isNull(), F.col("hash")).otherwise(own))
    met = known.join(first.where(~hot).withColumnRenamed("hash", "_key").drop("_k"), "_key", "left").select(
        "_rid", "first", "n", F.coalesce("_rid1", "_rid0").alias("_rid0"), F.coalesce("_first1", "_first0").alias("_first0"))
    later = materialize(met.where((F.col("_rid") != F.col("_rid0")) | (F.col("first") != F.col("_first0"))).select(
        "_rid", "first", "n"), "spans")
    gone = later.groupBy("_rid").agg(F.collect_list("first").alias("_f"), F.collect_list("n").alias("_n"))
    return rows.join(gone, "_rid", "left").select(
        "doc_id", _trimmed(F.col("text"), F.col("_f"), F.col("_n")).alias("_t")).select("doc_id", "_t.*")
