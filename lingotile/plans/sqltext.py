"""SQL fragments for the DuckDB oracle queries.

The regular expressions are the very strings the Spark expressions use
(both engines accept them), so the oracle checks the plan around them:
explode order, aggregation, first-occurrence ids, joins and windows.
"""

from __future__ import annotations

from lingotile.functions.text import EN_CLITIC_RE, RULE_PATTERNS, WORD_RE, CHAR_RE


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def words_sql(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {q(WORD_RE)})"


def lower_words_sql(text: str) -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), {q(WORD_RE)})"


def chars_sql(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {q(CHAR_RE)})"


def edgegrams_sql(text: str, n: int = 3, prefix: bool = True, suffix: bool = True) -> str:
    grams = []
    if prefix:
        grams.append(f"left(w, {n})")
    if suffix:
        grams.append(f"right(w, {n})")
    return (f"flatten(list_transform({words_sql(text)}, lambda w: "
            f"CASE WHEN length(w) < {n} THEN [w] ELSE [{', '.join(grams)}] END))")


def rule_sql(text: str, lang: str) -> str:
    t = f"coalesce({text}, '')"
    pattern = RULE_PATTERNS.get(lang, RULE_PATTERNS["es"])
    if lang == "en":
        t = f"regexp_replace({t}, {q(EN_CLITIC_RE)}, '\\1 \\2', 'g')"
    return f"regexp_extract_all({t}, {q(pattern)})"


def rule_by_lang_sql(text: str, lang_col: str) -> str:
    return (f"CASE WHEN {lang_col} = 'en' THEN {rule_sql(text, 'en')} "
            f"WHEN {lang_col} = 'fr' THEN {rule_sql(text, 'fr')} ELSE {rule_sql(text, 'es')} END")


US = "chr(31)"


def join_list(expr: str) -> str:
    """List -> unit-separator-joined string (the compared representation)."""
    return f"array_to_string({expr}, {US})"


def join_ids(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda i: CAST(i AS VARCHAR)), ',')"


def pretokenize_sql(text: str, uncased: bool = False) -> str:
    from lingotile.operators.wordpiece import CONTROL_RE, PRETOKEN_RE

    cleaned = f"regexp_replace(coalesce({text}, ''), {q(CONTROL_RE)}, '', 'g')"
    if uncased:
        cleaned = f"strip_accents(lower({cleaned}))"
    return f"regexp_extract_all({cleaned}, {q(PRETOKEN_RE)})"
