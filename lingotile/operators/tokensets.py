"""Token counts and distinct tokens of whole batches of texts.

``token_sets`` gives, for every tokenizer, a header row per language and batch
(documents, sum, least and greatest token count) and a row per language and
distinct token.  Words are split once for all tokenizers.  Edgegrams and rule
tokens never cross whitespace, so they are made of a batch's distinct words,
and a text's count is the sum of its words' counts.  Memory is bounded by an
Arrow batch.  Prepared tokenizers bring the list of each text's tokens, whose
distinct ones are taken by batches too; those of another kind go row by row
(``row_sets``).  Spark groups the rows of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingotile.functions.text import DEFAULT_RULE_LANG, EN_CLITIC_RE, RULE_PATTERNS, TokenizerSpec

SET_COLUMNS = "language string, tokenizer string, token string, docs bigint, sum_n bigint, min_n bigint, max_n bigint"
FLAGS = 1 << 26   # cells of a (language, token) table; beyond, pairs are sorted


def row_sets(per_doc: DataFrame) -> DataFrame:
    """``per_doc(language, tokenizer, t)``, a row per document: its header and its distinct tokens."""
    n, none = F.size("t").cast("bigint"), F.lit(None).cast("bigint")
    names = ("docs", "sum_n", "min_n", "max_n")
    header = F.array(F.struct(F.lit(None).cast("string").alias("token"), F.lit(1).cast("bigint").alias("docs"),
                              *[n.alias(c) for c in names[1:]]))
    body = F.transform(F.array_distinct("t"), lambda t: F.struct(t.alias("token"), *[none.alias(c) for c in names]))
    return per_doc.select("language", "tokenizer", F.inline(F.concat(header, body)))


def token_sets(df: DataFrame, specs: list[TokenizerSpec], text_col: str, lang_col: str, group_col: str) -> DataFrame:
    """``(language, tokenizer, token, docs, sum_n, min_n, max_n)``; a header has a null token."""
    parts = []
    batched = [(s.name, s.kind) for s in specs if s.kind is not None]
    if batched:
        from lingotile.session import ship_package

        ship_package(df.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _batch_sets(batch.column(0), batch.column(1), batched)

        texts = df.select(F.col(group_col).cast("string").alias("language"),
                          F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
        parts.append(texts.mapInArrow(run, SET_COLUMNS))
    plain = [F.struct(F.lit(s.name).alias("tokenizer"), s.tokens(text_col, lang_col).alias("t"))
             for s in specs if s.kind is None and s.prepare is None]
    if plain:
        parts.append(row_sets(df.select(F.col(group_col).cast("string").alias("language"), F.explode(F.array(*plain)).alias("x"))
                              .select("language", "x.tokenizer", "x.t")))
    prepared = [s for s in specs if s.kind is None and s.prepare is not None]
    if prepared:
        from lingotile.session import ship_package

        ship_package(df.sparkSession)
        names = [s.name for s in prepared]

        def run_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, lists, real in zip(names, batch.columns[1::2], batch.columns[2::2]):
                    yield from _list_sets(batch.column(0), name, lists, real)

        own = [s.tokens(text_col, lang_col) for s in prepared]
        # No null arrays: the Arrow writer goes over a batch's null lists again at every row.
        lists = [c for i, t in enumerate(own) for c in (F.coalesce(t, F.array().cast("array<string>")).alias(f"t{i}"), t.isNotNull().alias(f"r{i}"))]
        parts.append(df.select(F.col(group_col).cast("string").alias("language"), *lists).mapInArrow(run_lists, SET_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def _list_sets(languages: pa.Array, name: str, lists: pa.Array, real: pa.Array) -> Iterator[pa.RecordBatch]:
    """Header and distinct tokens by language of rows that bring their tokens; a
    text without a list (not ``real``) counts as a text only."""
    if not len(lists):
        return
    coded = pc.dictionary_encode(languages, null_encoding="encode")
    names, group = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = real.to_numpy(zero_copy_only=False)
    none = np.bincount(group[real], minlength=len(names)) == 0
    sums = np.zeros(len(names), np.int64)
    least, most = np.full(len(names), np.iinfo(np.int64).max), np.full(len(names), -1, np.int64)
    for f, x in ((np.add, sums), (np.minimum, least), (np.maximum, most)):
        f.at(x, group[real], size[real])
    tokens = pc.dictionary_encode(lists.flatten())
    at = tokens.indices
    row = np.repeat(np.arange(len(size)), size)[at.is_valid().to_numpy(zero_copy_only=False)]
    of, token = _met(group[row], at.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), len(names), len(tokens.dictionary))
    nothing = pa.nulls(len(of), pa.int64())
    for n, language, body, numbers in (
            (len(names), names, pa.nulls(len(names), pa.string()),
             [pa.array(np.bincount(group, minlength=len(names))), *[pa.array(x, mask=none) for x in (sums, least, most)]]),
            (len(of), names.take(pa.array(of)), tokens.dictionary.take(pa.array(token)), [nothing] * 4)):
        yield pa.RecordBatch.from_arrays([language.cast(pa.string()), pa.array([name] * n, pa.string()), body.cast(pa.string()), *numbers],
                                         names=["language", "tokenizer", "token", "docs", "sum_n", "min_n", "max_n"])


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (Python's ``str.split``) and the row of each."""
    lists = pc.utf8_split_whitespace(texts)
    words, row = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")
    return words.filter(real), row.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(words: pa.Array, kind: tuple) -> tuple[pa.Array, np.ndarray]:
    """The tokens of words, in any order, and the word of each."""
    every = np.arange(len(words))
    if kind[0] == "word":
        return words, every
    if kind[0] == "edges":
        _, n, use_prefix, use_suffix = kind
        if not (use_prefix and use_suffix):
            return (pc.utf8_slice_codeunits(words, 0, n) if use_prefix else pc.utf8_slice_codeunits(words, -n, None)), every
        two = pc.greater_equal(pc.utf8_length(words), n)
        ends = [pc.utf8_slice_codeunits(words, 0, n), pc.utf8_slice_codeunits(words.filter(two), -n, None)]
        return pa.concat_arrays(ends), np.concatenate([every, every[two.to_numpy(zero_copy_only=False)]])
    # All but whitespace is in some token, so a space after each token parts them.
    if kind[1] == "en":
        words = pc.replace_substring_regex(words, EN_CLITIC_RE, r"\1 \2")
    pattern = RULE_PATTERNS.get(kind[1], RULE_PATTERNS[DEFAULT_RULE_LANG])
    return _split(pc.replace_substring_regex(words, pattern, r"\0 "))


def _met(group: np.ndarray, code: np.ndarray, groups: int, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of group and code."""
    if groups * codes <= FLAGS:
        flags = np.zeros((groups, codes), bool)
        flags[group, code] = True
        return np.nonzero(flags)
    pairs = np.unique(group * codes + code)
    return pairs // codes, pairs % codes


def _batch_sets(languages: pa.Array, texts: pa.Array, tokenizers: list) -> Iterator[pa.RecordBatch]:
    if not len(texts):
        return
    coded = pc.dictionary_encode(languages, null_encoding="encode")
    names, group = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    texts = pc.cast(texts, pa.large_string())
    # Texts in the order of their language: a language's rows are a slice.
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(len(names)))

    def header(name: str, n: np.ndarray) -> pa.RecordBatch:
        sums, least, most = (f.reduceat(n[order], starts) for f in (np.add, np.minimum, np.maximum))
        return made(name, np.arange(len(names)), pa.nulls(len(names), pa.string()), np.bincount(group, minlength=len(names)), sums, least, most)

    def made(name: str, of: np.ndarray, tokens: pa.Array, *numbers: np.ndarray) -> pa.RecordBatch:
        counts = [pa.array(x.astype(np.int64)) for x in numbers] or [pa.nulls(len(of), pa.int64())] * 4
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(of)).cast(pa.string()), pa.array([name] * len(of), pa.string()), tokens.cast(pa.string()), *counts],
            names=["language", "tokenizer", "token", "docs", "sum_n", "min_n", "max_n"])

    if any(kind[0] != "char" for _, kind in tokenizers):
        words, row = _split(texts)
        words = pc.dictionary_encode(words)
        distinct, code = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
        met_group, met_word = _met(group[row], code, len(names), len(distinct))
    for name, kind in tokenizers:
        if kind[0] == "char":
            yield header(name, pc.utf8_length(texts).to_numpy(zero_copy_only=False))
            for g in range(len(names)):
                own = np.zeros(0x110000, bool)
                for k in range(starts[g], starts[g + 1] if g + 1 < len(names) else len(order), 256):
                    some = texts.take(pa.array(order[k:min(k + 256, starts[g + 1] if g + 1 < len(names) else len(order))]))
                    own[np.frombuffer("".join(some.to_pylist()).encode("utf-32-le"), np.uint32)] = True
                seen = [chr(c) for c in np.flatnonzero(own)]
                yield made(name, np.full(len(seen), g), pa.array(seen, pa.string()))
            continue
        tokens, word = _pieces(distinct, kind)
        each = np.bincount(word, minlength=len(distinct))
        yield header(name, np.bincount(row, weights=each[code], minlength=len(texts)).astype(np.int64))
        tokens = pc.dictionary_encode(tokens)
        at = tokens.indices.to_numpy(zero_copy_only=False)
        # Each met (language, word) stands for the tokens of the word.
        by_word = at[np.argsort(word, kind="stable")]
        begin = np.cumsum(each) - each
        size = each[met_word]
        place = np.repeat(begin[met_word] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        of, token = _met(np.repeat(met_group, size), by_word[place], len(names), len(tokens.dictionary))
        yield made(name, of, tokens.dictionary.take(pa.array(token)))
