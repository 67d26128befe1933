"""URL filter: host and path rules first, then a weighted vocabulary.

An Aho-Corasick pass over the lower-cased url finds the terms of the
vocabulary; a hit counts only between boundaries (no letter or digit on
either side).  Each distinct term adds its weight once.  A strict term weighs
the limit by itself, soft ones reach it together: one strict or several
distinct soft hits reject the url.

Host and path are null-safe column expressions: a null url, or one without
``://``, has an empty host and path, fits no rule and is judged by its terms
alone (a null one has none and is allowed).  Rows are judged one by one, so
repeated rows repeat, an empty table gives an empty result, and columns other
than the id and the url are not read.  Rules and terms are parameters of a
few hundred entries: they travel with the task.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"

# The rules as (action, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
# The vocabulary.  A strict term weighs LIMIT, a soft one 1.
LIMIT = 2
STRICT = ("casino", "hentai", "malware", "phishing", "porn", "porno", "sexcam", "spam", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bets", "betting", "bonus", "cheap", "crack", "dating", "deal", "deals", "escort", "farm",
        "free", "gambling", "girls", "hot", "jackpot", "keygen", "loan", "loans", "lottery", "nude", "nulled", "pill",
        "pills", "poker", "prize", "replica", "sex", "slots", "torrent", "win", "winner")
TERMS = {**dict.fromkeys(STRICT, LIMIT), **dict.fromkeys(SOFT, 1)}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and
    path (from there up to ``? #``); both empty without ``://`` or url."""
    host = F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as (rule text, action); nulls if none does.
    A rule fits its host and every subdomain, where the path begins with the
    rule's.  Rules of equal length that fit one url are the same rule."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest becomes the outermost case
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return text, action


def terms_in(lowered: str, automaton: ahocorasick.Automaton) -> set[str]:
    """Distinct terms that stand between boundaries in an ASCII-lowered url."""
    found, last = set(), len(lowered) - 1
    for end, term in automaton.iter(lowered):
        start = end - len(term) + 1
        if not ((start and lowered[start - 1].isalnum()) or (end < last and lowered[end + 1].isalnum())):
            found.add(term)
    return found


def weigh(lowered: Column, terms: dict[str, int] | None = None, limit: int = LIMIT) -> Column:
    """Struct ``(strict_terms, soft_terms, score)`` of lower-cased urls:
    distinct terms of the limit's weight, of less, and their summed weight."""
    weights = dict(TERMS if terms is None else terms)

    @F.pandas_udf("strict_terms bigint, soft_terms bigint, score bigint")
    def run(urls: pd.Series) -> pd.DataFrame:
        automaton = ahocorasick.Automaton()
        for term in weights:
            automaton.add_word(term, term)
        automaton.make_automaton()
        rows = []
        for url in urls:
            each = [weights[t] for t in terms_in(url, automaton)] if url else []
            strict = sum(w >= limit for w in each)
            rows.append((strict, len(each) - strict, sum(each)))
        return pd.DataFrame(rows, columns=["strict_terms", "soft_terms", "score"])

    return run(lowered)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, terms: dict[str, int] | None = None,
          limit: int = LIMIT) -> DataFrame:
    """A row per page: ``page_id, host, path, rule, verdict, strict_terms,
    soft_terms, score``.  The rule that fits decides; without one a score of
    ``limit`` or more blocks.  ``terms`` are lower-case."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"),
                         weigh(F.translate("url", UPPER, LOWER), terms, limit).alias("_w"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    by_terms = F.when(F.col("_w.score") >= limit, "block").otherwise("allow")
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, by_terms).alias("verdict"),
                        "_w.*")


def _sql() -> str:
    def hits(words: tuple[str, ...]) -> str:
        edge = r"[^\p{L}\p{N}]"
        return " + ".join(f"CAST(regexp_matches(u, '(?:^|{edge}){w}(?:{edge}|$)') AS BIGINT)" for w in words)

    def case(value) -> str:
        longest_first = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
        return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
                                  f"THEN '{value(a, h, p)}'" for a, h, p in longest_first) + " END"

    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{HOST}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{PATH}', 1), '') AS path,
         translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u
  FROM pages),
hits AS (SELECT page_id, host, path, {hits(STRICT)} AS strict_terms, {hits(SOFT)} AS soft_terms FROM parts)
SELECT page_id, host, path, {case(lambda a, h, p: h + p)} AS rule,
       coalesce({case(lambda a, h, p: a)},
                CASE WHEN {LIMIT} * strict_terms + soft_terms >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_terms, soft_terms, {LIMIT} * strict_terms + soft_terms AS score
FROM hits"""


JUDGE_SQL = _sql()
