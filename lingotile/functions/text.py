"""Tokenizers as Catalyst expressions: ``Column -> Column`` (``ARRAY<STRING>``).

Everything here stays JVM-side (regex extraction, higher-order array
functions), so tokenisation runs inside whole-stage code generation,
is column-pruned, and works unchanged on streaming DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal Python's str.split()/str.strip() whitespace set):
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
WS_CLASS = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# Special tokens and their ids.
PAD, UNK, BOS, EOS = "<pad>", "<unk>", "<bos>", "<eos>"
SPECIALS_WORD = [PAD, UNK, BOS, EOS]   # word / corpus vocabularies: ids 0..3
SPECIALS_SHORT = [PAD, UNK]            # char / edgegram / rule vocabularies: ids 0..1
# The same whitespace set as characters (for trimming).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
            + "\u2028\u2029\u202f\u205f\u3000")
# ---------------------------------------------------------------------------

# Reference forms of the patterns (also used verbatim by the SQL oracles).
WORD_RE = f"[^{WS_CLASS}]+"
CHAR_RE = "(?s)."
STRIP_RE = f"^[{WS_CLASS}]+|[{WS_CLASS}]+$"

# Execution forms.  Java's regex engine is ~10x slower on the explicit
# negated class than on the Unicode ``\S`` class, which differs from
# Python's whitespace only in U+001C..U+001F (Python splits on them,
# Unicode White_Space does not), so those four are mapped to a space first.
FAST_WORD_RE = r"(?U)\S+"
PY_ONLY_WS_RE = r"[\x{1c}-\x{1f}]"

# Rule-based, language-specific tokenisation (re-aim of pretrained
# per-language rule tokenizers).  The patterns only use constructs that
# Java regex and RE2 share, so the same strings run in Spark and DuckDB.
_NUM = r"\p{N}+(?:[.,/:]\p{N}+)*"
_WORD = r"[\p{L}\p{M}\p{N}_]+"
_SYM = r"[^" + WS_CLASS + r"\p{L}\p{M}\p{N}_]"
_APOS = "['’]"
RULE_PATTERNS = {
    "en": "n" + _APOS + "t|" + _APOS + "(?:m|s|re|ve|ll|d)|" + _NUM + "|" + _WORD + "|" + _SYM,
    "es": _NUM + "|" + _WORD + "|" + _SYM,
    "fr": ("(?:[lLdDjJcCmMtTsSnN]|[qQ]u|[jJ]usqu|[lL]orsqu|[pP]uisqu)" + _APOS + "|"
           + _NUM + "|" + _WORD + "(?:['’-]" + _WORD + ")*|" + _SYM),
}
# English negation clitic is split off its host word before extraction.
EN_CLITIC_RE = r"(\p{L})(n" + _APOS + "t)"
DEFAULT_RULE_LANG = "es"


def _text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def strip(col: Column | str) -> Column:
    """Python ``str.strip()`` (cost proportional to the trimmed ends)."""
    return F.btrim(_text(col), F.lit(WS_CHARS))


def words(col: Column | str) -> Column:
    """Python ``str.split()``: Unicode whitespace split, punctuation kept."""
    t = F.regexp_replace(_text(col), PY_ONLY_WS_RE, " ")
    return F.regexp_extract_all(t, F.lit(FAST_WORD_RE), F.lit(0))


# A run of whitespace in Python's sense, and any other run, never given back.
_GAP, _RUN = r"[\s\x{1c}-\x{1f}]++", r"[^\s\x{1c}-\x{1f}]++"


def first_words(col: Column | str, k: int) -> Column:
    """The text up to the end of its ``k``-th word (all of it, if it has
    fewer): what follows is not read.  Java's matcher nests once for each
    word, so a larger ``k`` takes the whole text."""
    if k > 500:
        return _text(col)
    return F.regexp_extract(_text(col), f"(?U)^(?:{_GAP})?(?:{_RUN}(?:{_GAP})?){{0,{k}}}", 0)


def chars(col: Column | str) -> Column:
    """Python ``list(text)``: one element per code point, spaces included
    (``split`` with an empty pattern splits by code point; ``""`` -> [])."""
    t = _text(col)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ""))


def lowered_words(col: Column | str) -> Column:
    return words(F.lower(_text(col)))


def edgegrams(col: Column | str, n: int = 3, use_prefix: bool = True,
              use_suffix: bool = True) -> Column:
    """Per word: the word itself if shorter than ``n``, else its ``n``-prefix
    and/or ``n``-suffix (a word of length ``n`` yields the same gram twice
    when both are on)."""
    if not use_prefix and not use_suffix:
        raise ValueError("edgegrams without prefixes and suffixes are empty: turn one of them on")
    if n < 1:
        raise ValueError(f"edgegrams need a length of one or more, not {n}")

    def per_word(w: Column) -> Column:
        grams = []
        if use_prefix:
            grams.append(F.substring(w, 1, n))
        if use_suffix:
            grams.append(F.substring(w, -n, n))
        return F.when(F.length(w) < n, F.array(w)).otherwise(F.array(*grams))

    return F.flatten(F.transform(words(col), per_word))


def _rule_for(lang: str, text: Column) -> Column:
    pattern = RULE_PATTERNS.get(lang, RULE_PATTERNS[DEFAULT_RULE_LANG])
    if lang == "en":
        text = F.regexp_replace(text, EN_CLITIC_RE, "$1 $2")
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def rule_tokens(col: Column | str, lang: str | Column) -> Column:
    """Language-specific rule tokenizer; ``lang`` is a fixed language code or
    a column holding one per row (unknown codes use the Spanish rule)."""
    text = _text(col)
    if isinstance(lang, str):
        return _rule_for(lang, text)
    expr = _rule_for(DEFAULT_RULE_LANG, text)
    for code in ("en", "fr"):
        expr = F.when(lang == F.lit(code), _rule_for(code, text)).otherwise(expr)
    return expr


@dataclass(frozen=True)
class TokenizerSpec:
    """A named tokenizer: ``fn(text_col, row_lang_col) -> ARRAY<STRING>``.

    ``n_special`` is the number of special ids its vocabulary reserves,
    ``sep`` the separator its decoder joins with, ``growing`` whether
    encoding adds unseen tokens to the vocabulary.
    """
    name: str
    fn: Callable[[Column, Column], Column]
    n_special: int = 2
    sep: str = " "
    growing: bool = False
    requires: tuple = field(default_factory=tuple)
    # Optional DataFrame-level step for tokenizers that need a join
    # (``prepare(df, text_col, key) -> df`` adding the column ``fn`` reads).
    prepare: Callable | None = None
    # True when ``fn`` yields ``struct<tokens, error>`` (a Python tokenizer
    # that may raise): summaries then stop at the first failing text.
    safe: bool = False
    # ``head(text, k)``: a part of the text whose first ``k`` tokens are those
    # of the whole text.
    head: Callable[[Column, int], Column] | None = None
    # For tokenizers that take 1 to 2 pieces of each word: ``(n, use_prefix,
    # use_suffix)``; n None is the word itself (see ``vocab.counted``).
    edges: tuple | None = None
    # ``(kind, ...)`` of ``operators.tokensets``, where a batch of texts can
    # be tokenised by its distinct words: char, word, edges or rule.
    kind: tuple | None = None

    def tokens(self, text: Column | str, lang: Column | str | None = None) -> Column:
        t = F.col(text) if isinstance(text, str) else text
        lg = F.col(lang) if isinstance(lang, str) else (lang if lang is not None else F.lit(None))
        return self.fn(t, lg)


def python_tokenizer_spec(name: str, tokenize, n_special: int = 2, sep: str = " ") -> TokenizerSpec:
    """Escape hatch for any Python ``str -> list[str]`` tokenizer: an
    Arrow-batched pandas UDF returning ``struct<tokens, error>``; an
    exception on a text is captured as its message instead of failing the
    job."""
    from lingotile.session import ship_package

    ship_package()

    @F.pandas_udf("tokens array<string>, error string")
    def _apply(texts: pd.Series) -> pd.DataFrame:
        toks, errs = [], []
        for t in texts:
            try:
                toks.append([str(x) for x in tokenize("" if t is None else t)])
                errs.append(None)
            except Exception as e:  # captured per text, as the comparison expects
                toks.append(None)
                errs.append(str(e))
        return pd.DataFrame({"tokens": toks, "error": errs})

    return TokenizerSpec(name, lambda t, lg: _apply(t), n_special=n_special, sep=sep, safe=True)


def char_spec() -> TokenizerSpec:
    return TokenizerSpec("char", lambda t, lg: chars(t), n_special=2, sep="",
                         head=lambda t, k: F.substring(_text(t), 1, k),
                         kind=("char",))


def word_spec() -> TokenizerSpec:
    return TokenizerSpec("word", lambda t, lg: words(t), n_special=4, sep=" ", head=first_words,
                         edges=(None, True, False), kind=("word",))


def edgegram_spec(n: int = 3, use_prefix: bool = True, use_suffix: bool = True,
                  name: str = "edgegram") -> TokenizerSpec:
    return TokenizerSpec(name, lambda t, lg: edgegrams(t, n, use_prefix, use_suffix),
                         n_special=2, sep=" ", growing=True, head=first_words, edges=(n, use_prefix, use_suffix),
                         kind=("edges", n, use_prefix, use_suffix))


def rule_spec(lang: str | None = None, name: str | None = None) -> TokenizerSpec:
    """``lang=None`` picks the rule from the row's language column."""
    nm = name or (f"rule_{lang}" if lang else "rule")
    if lang is None:
        return TokenizerSpec(nm, lambda t, lg: rule_tokens(t, lg), n_special=2, growing=True)
    return TokenizerSpec(nm, lambda t, lg: rule_tokens(t, lang), n_special=2, growing=True, kind=("rule", lang))


def default_tokenizers(available: dict | None = None) -> list[TokenizerSpec]:
    """The comparison registry: char, word, one rule tokenizer per language
    and, when a WordPiece vocabulary table is supplied, WordPiece.  A
    tokenizer whose resource is missing is skipped with a warning."""
    import warnings

    specs = [char_spec(), word_spec()] + [rule_spec(code) for code in ("es", "en", "fr")]
    available = available or {}
    if "wordpiece_vocab" in available:
        from lingotile.operators.wordpiece import wordpiece_spec
        specs.append(wordpiece_spec(available["wordpiece_vocab"]))
    else:
        warnings.warn("WordPiece vocabulary not supplied; skipping the WordPiece tokenizer")
    return specs
