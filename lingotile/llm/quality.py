"""Host-level quality rules: per-document rules, failures by host, shrunk host rates, joined verdicts.

DataFrame functions only.  A document fails its own rules when it has fewer
than ``min_words`` words or too many of its words lie in five-word windows
that occur twice or more in it.  Failures are then counted by host; a host's
rate is shrunk towards the rate of all hosts with a beta prior fitted to the
hosts themselves (method of moments), so a host with few documents is judged
by the prior and a host with many by its own record.  A host whose shrunk
rate and own rate are both over ``max_rate`` loses all its documents.

Edge cases: a null or empty text has no words and fails; a null host is a
host of its own without a verdict (its documents are judged alone); repeated
rows count once each; an empty table gives an empty result.  Windows are
compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize

# What separates words, and the symbol characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, SPACES)) > 0)
    return F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]


def _repeated_positions(hashes: Column) -> Column:
    """Ascending starts of the windows whose hash occurs at least twice."""
    def marked(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # The one-element array binds the sorted pairs once for all lookups.
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                  F.transform(F.array(pairs), marked)[0])


def _covered(starts: Column) -> Column:
    """Words covered by windows at ascending ``starts``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))
    return F.coalesce(F.aggregate(starts, zero, step)["n"], F.lit(0))


def with_rules(rows: DataFrame, text_col: str = "text", min_words: int = 10, max_repeat_pct: int = 20) -> DataFrame:
    """``rows`` plus ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    kept = rows.columns
    text = F.coalesce(F.col(text_col), F.lit(""))

    def bound(df: DataFrame, value: Column, name: str, *columns) -> DataFrame:
        # A one-row explode: filters above it cannot copy the expression into
        # themselves, so each array is computed once.
        return df.select(*kept, *columns, F.explode(F.array(value)).alias(name))

    a = bound(rows, F.filter(F.split(text, SPACE_RUN), lambda w: w != ""), "_w", text.alias("_t"))
    last = F.size("_w") - WINDOW
    hashes = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)])))
    b = bound(a, hashes, "_h", "_t", F.size("_w").cast("bigint").alias("n_words"))
    c = bound(b, _repeated_positions(F.col("_h")), "_r", "_t", "n_words")
    d = c.select(*kept, "n_words",
                 F.length(_without(F.col("_t"), SPACES)).cast("bigint").alias("word_chars"),
                 (F.length("_t") - F.length(_without(F.col("_t"), SYMBOLS))).cast("bigint").alias("n_symbols"),
                 _dup_lines(F.col("_t")).cast("bigint").alias("n_dup_lines"),
                 _covered(F.col("_r")).cast("bigint").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < min_words)
                        | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) from the materialized table ``(host, n, f)``: mean rate m
    and between-host variance by the method of moments.  One row of sums
    reaches the driver.  Hosts that differ no more than chance allows, or a
    single host, give a strong prior of 1e6 documents."""
    s = hosts.agg(F.count(F.lit(1)).alias("h"), F.sum("n").alias("n"), F.sum("f").alias("f"),
                  F.sum(F.col("f").cast("double") * F.col("f") / F.col("n")).alias("q")).first()
    if not s["n"]:
        return 1.0, 1.0
    m = s["f"] / s["n"]
    spread = s["q"] / s["n"] - m * m
    chance = m * (1 - m)
    excess = spread - chance * s["h"] / s["n"]
    k = min(max((chance - spread) / excess, 1.0), 1e6) if excess > 0 else 1e6
    return m * k, (1 - m) * k


def rejected_hosts(scored: DataFrame, max_rate: float) -> DataFrame:
    """``(_bad)``: the hosts whose shrunk rate and own rate are both over ``max_rate``."""
    hosts = materialize(scored.where(F.col("_host").isNotNull()).groupBy("_host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("f")), "hosts")
    alpha, beta = beta_prior(hosts)
    shrunk = (F.col("f") + alpha) / (F.col("n") + (alpha + beta))
    return hosts.where((shrunk > max_rate) & (F.col("f") > max_rate * F.col("n"))).select(F.col("_host").alias("_bad"))


def with_verdict(scored: DataFrame, max_rate: float) -> DataFrame:
    """``scored`` plus ``kept``.  Only rejected hosts are joined; a hot one is
    split by the adaptive skew join."""
    out = scored.join(rejected_hosts(scored, max_rate), F.col("_host") == F.col("_bad"), "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("_bad").isNull()).drop("_host", "_bad")


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_rate: float = 0.6,
          **rules) -> DataFrame:
    """``(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept)`` per document, ``row`` holding the input's columns
    untouched (so no name can clash).  The rules run twice, for the hosts and
    for the rows, as whole rows are not written in between."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(text_col).alias("_text"), F.col(host_col).alias("_host"))
    return with_verdict(with_rules(rows, "_text", **rules), max_rate).drop("_text")


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass their own rules and whose host is not rejected."""
    return judge(docs, **options).where("kept").select("row.*")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                   max_rate: float = 0.6, **rules) -> DataFrame:
    """One row per document: id, the rule counts and the verdict.  Texts are
    scored once; what is written for the verdicts are ids, hosts and counts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), F.col(host_col).alias("_host"))
    scored = materialize(with_rules(rows, "_text", **rules).drop("_text"), "scored")
    return with_verdict(scored, max_rate)


REPORT_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ln FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
c AS (SELECT doc_id, sum(least(5, i - p)) AS c FROM
      (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 5) AS p FROM r) GROUP BY 1),
m AS (SELECT w.doc_id, source, len(w)::BIGINT AS n_words,
      length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
      (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
      (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
      coalesce(c, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b WHERE source IS NOT NULL GROUP BY 1),
s AS (SELECT count(*) AS h, sum(n)::DOUBLE AS n, sum(f)::DOUBLE AS f, sum(f::DOUBLE * f / n) AS q FROM h),
p AS (SELECT f / n AS m, q / n - f / n * f / n AS v, f / n * (1 - f / n) AS ch, h / n AS hn FROM s),
k AS (SELECT m, CASE WHEN v - ch * hn > 0 THEN least(greatest((ch - v) / (v - ch * hn), 1), 1e6) ELSE 1e6 END AS k FROM p),
bad AS (SELECT source FROM h, k WHERE (f + m * k) / (n + k) > 0.6 AND f > 0.6 * n)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept FROM b
"""
