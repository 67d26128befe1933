"""Vocabularies as tables: ``vocab(id BIGINT, token STRING, freq BIGINT, is_special BOOLEAN)``.

Ids are dense from 0: the special tokens first, then corpus tokens in
order of their first occurrence (``min(struct(doc_ord, pos))``), exactly as
an insertion-ordered dictionary filled while reading the corpus in order.
Counting is a hash aggregation with map-side partial aggregation (a token
holding a third of the corpus still sends one row per map task), and the
id assignment is the parallel two-level rank from ``ranking``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingotile.functions.text import SPECIALS_SHORT, SPECIALS_WORD, TokenizerSpec, word_spec
from lingotile.operators.ranking import global_rank
from lingotile.operators.tokensets import _pieces, _split
from lingotile.session import released, written

VOCAB_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("token", T.StringType(), True),
    T.StructField("freq", T.LongType(), True),
    T.StructField("is_special", T.BooleanType(), False),
])

# ---------------------------------------------------------------------------
# The default character alphabet of the character tokenizer,
# in order (143 characters, 139 distinct; with <pad>, <unk> the vocabulary
# has 141 entries).
DEFAULT_ALPHABET = (
    "abcdefghijklmnopqrstuvwxyz"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "0123456789"
    " .,;:!?¡¿()[]{}\"'`-_/\\@#$%^&*+=<>|~"
    "áéíóúÁÉÍÓÚñÑüÜ"
    "àâæçéèêëîïôœùûüÿ"
    "ÀÂÆÇÉÈÊËÎÏÔŒÙÛÜŸ"
)
# ---------------------------------------------------------------------------


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: written to the shared checkpoint folder and read back."""
    return written(df)


def specials_frame(spark: SparkSession, specials: list[str]) -> DataFrame:
    rows = [(i, tok, None, True) for i, tok in enumerate(specials)]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def empty_vocab(spark: SparkSession, n_special: int = 2) -> DataFrame:
    """A vocabulary reset to its special tokens only."""
    return specials_frame(spark, SPECIALS_WORD[:n_special])


def token_rows(df: DataFrame, tokens: Column, order_col: str = "doc_ord",
               keep: list[str] | None = None) -> DataFrame:
    """Explode a token array into ``(doc_ord, pos, token)`` rows."""
    keep = keep or []
    return df.select(F.col(order_col).cast("bigint").alias("doc_ord"), *keep,
                     F.posexplode(tokens).alias("pos", "token"))


def counted(df: DataFrame, spec: TokenizerSpec, text_col: Column | str = "text", lang_col: str | None = "lang",
            order_col: str = "doc_ord") -> DataFrame:
    """``token_rows`` of a tokenizer that takes words apart, counted in their
    task: ``(doc_ord, pos, token, n)``, a row for each distinct token of an
    Arrow batch, with its first place there.  Other tokenizers: a row per token."""
    rule = spec.kind if spec.kind is not None and spec.kind[0] == "rule" else None
    if spec.edges is None and rule is None:
        return token_rows(df, spec.tokens(text_col, lang_col), order_col)
    from lingotile.session import ship_package

    ship_package(df.sparkSession)
    edges = spec.edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rule is not None:
                yield _counted_by_word(batch.column(0), batch.column(1), rule)
            else:
                yield _counted_batch(batch.column(0), batch.column(1), *edges)

    rows = df.select(F.col(order_col).cast("bigint").alias("doc_ord"), F.make_valid_utf8(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_ord bigint, pos int, token string, n bigint")


_NOWHERE = np.iinfo(np.int64).max   # no place: the row's ordinal is null


def _counted_batch(ords: pa.Array, texts: pa.Array, n: int | None, use_prefix: bool, use_suffix: bool) -> pa.RecordBatch:
    """The distinct pieces of the texts' words with their counts and the least (ordinal, place) of each."""
    lists = pc.utf8_split_whitespace(pc.cast(texts, pa.large_string()))
    words, row = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")
    words, row = words.filter(real), row.filter(real).to_numpy(zero_copy_only=False)
    two = np.zeros(len(words), bool)
    parts = [words]
    if n is not None:
        if use_prefix and use_suffix:
            two = pc.greater_equal(pc.utf8_length(words), n).to_numpy(zero_copy_only=False)
        # Of a word shorter than n, both ends are the word.
        parts = [pc.utf8_slice_codeunits(words, 0, n) if use_prefix else pc.utf8_slice_codeunits(words, -n, None)]
        if use_prefix and use_suffix:
            parts.append(pc.utf8_slice_codeunits(words.filter(pa.array(two)), -n, None))
    end = np.cumsum(1 + two)
    start = end - 1 - two
    first_of_row = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    place = start - np.repeat(start[first_of_row], np.diff(np.append(first_of_row, len(row))))
    has_ord = ords.is_valid().to_numpy(zero_copy_only=False)
    values, rank = np.unique(ords.fill_null(0).to_numpy(zero_copy_only=False), return_inverse=True)
    at = np.where(has_ord[row], (rank[row].astype(np.int64) << 32) + place, _NOWHERE)
    places = [at]
    if len(parts) == 2:
        places.append(np.where(at[two] == _NOWHERE, _NOWHERE, at[two] + 1))
    coded = pc.dictionary_encode(pa.concat_arrays(parts))   # of no words at all, too
    codes, size = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    least = np.full(size, _NOWHERE)
    np.minimum.at(least, codes, np.concatenate(places))
    return _first_places(coded.dictionary, least, np.bincount(codes, minlength=size), values)


def _first_places(tokens: pa.Array, least: np.ndarray, n: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    known = least != _NOWHERE
    ordinal = np.zeros(len(tokens), np.int64)
    ordinal[known] = values[least[known] >> 32]
    # Without an ordinal there is no place (null), but the token counts.
    return pa.RecordBatch.from_arrays(
        [pa.array(ordinal, mask=~known), pa.array(np.where(known, least & 0xFFFFFFFF, 0).astype(np.int32), mask=~known),
         tokens.cast(pa.string()), pa.array(n.astype(np.int64))],
        names=["doc_ord", "pos", "token", "n"])


def _counted_by_word(ords: pa.Array, texts: pa.Array, kind: tuple) -> pa.RecordBatch:
    """The same for tokens of which a word has any number: only distinct words
    are taken apart, and a token is first where a word that has it is first."""
    words, row = _split(pc.cast(texts, pa.large_string()))
    coded = pc.dictionary_encode(words)
    code = coded.indices.to_numpy(zero_copy_only=False)
    tokens, word = _pieces(coded.dictionary, kind)   # word by word, in order
    each = np.bincount(word, minlength=len(coded.dictionary))
    end = np.cumsum(each[code])
    start = end - each[code]
    first_of_row = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    place = start - np.repeat(start[first_of_row], np.diff(np.append(first_of_row, len(row))))
    has_ord = ords.is_valid().to_numpy(zero_copy_only=False)
    values, rank = np.unique(ords.fill_null(0).to_numpy(zero_copy_only=False), return_inverse=True)
    first = np.full(len(coded.dictionary), _NOWHERE)
    np.minimum.at(first, code, np.where(has_ord[row], (rank[row].astype(np.int64) << 32) + place, _NOWHERE))
    within = np.arange(len(word)) - (np.cumsum(each) - each)[word]
    taken = pc.dictionary_encode(tokens)
    at, size = taken.indices.to_numpy(zero_copy_only=False), len(taken.dictionary)
    least = np.full(size, _NOWHERE)
    np.minimum.at(least, at, np.where(first[word] == _NOWHERE, _NOWHERE, first[word] + within))
    n = np.bincount(at, weights=np.bincount(code, minlength=len(coded.dictionary))[word], minlength=size)
    return _first_places(taken.dictionary, least, n, values)


POS_BITS = 21   # positions below 2^21 and ordinals below 2^42 pack into 63 bits
ORD_LIMIT = 1 << 42


def _wide(d: Column, p: Column) -> Column:
    """``(d, p)`` as one decimal of the same order: any long ``d``, any int ``p``."""
    place = (p + F.lit(1 << 31)).cast("decimal(11,0)")
    return (d.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + place).cast("decimal(38,0)")


def _unwide(x: Column) -> Column:
    unit = F.lit(1 << 32).cast("decimal(38,0)")
    place = F.pmod(x, unit)
    return F.struct(((x - place) / unit).cast("bigint").alias("doc_ord"), (place.cast("bigint") - F.lit(1 << 31)).alias("pos"))


def _first_occurrence(tokens_df: DataFrame) -> DataFrame:
    """Per token: frequency and first ``(doc_ord, pos)``.  The pair is packed
    into one BIGINT when it fits; rows that do not fit are packed into a
    decimal, and the two are combined lexicographically.  Minima of numbers
    aggregate by hashing; a struct minimum, left for positions that are no
    ints, would sort all token rows first."""
    d, p = F.col("doc_ord"), F.col("pos").cast("bigint")
    fits = (d >= 0) & (d < ORD_LIMIT) & (p >= 0) & (p < (1 << POS_BITS))
    ints = isinstance(tokens_df.schema["pos"].dataType, T.IntegerType)
    agg = tokens_df.groupBy("token").agg(
        (F.sum("n") if "n" in tokens_df.columns else F.count(F.lit(1))).alias("freq"),
        F.min(F.when(fits, F.shiftleft(d, POS_BITS) + p)).alias("_packed"),
        F.min(F.when(~fits, _wide(d, p) if ints else F.struct(d.alias("doc_ord"), p.alias("pos")))).alias("_other"))
    packed = F.struct(F.shiftright("_packed", POS_BITS).alias("doc_ord"),
                      (F.col("_packed") % (1 << POS_BITS)).alias("pos"))
    other = _unwide(F.col("_other")) if ints else F.col("_other")
    first = F.when(F.col("_other").isNull(), packed).when(F.col("_packed").isNull(), other) \
        .otherwise(F.least(packed, other))
    return agg.select("token", "freq", first.alias("_first")).select(
        "token", "freq", F.col("_first.doc_ord").alias("first_doc"),
        F.col("_first.pos").cast("bigint").alias("first_pos"))


def _rank_tokens(agg: DataFrame, start: int) -> DataFrame:
    # Tokens without a place (null order) tie: they come in their own order.
    ranked = global_rank(agg, ["first_doc", "first_pos", "token"], out="id", start=start)
    return ranked.select("id", "token", "freq", F.lit(False).alias("is_special"))


def build_vocab(tokens_df: DataFrame, min_freq: int = 1,
                specials: list[str] | None = None) -> DataFrame:
    """Corpus vocabulary: tokens with ``freq >= min_freq`` that are not
    special, ids in first-occurrence order after the specials.

    ``tokens_df`` has ``(doc_ord, pos, token)`` (see ``token_rows``), and ``n``
    where a row stands for so many (see ``counted``)."""
    specials = SPECIALS_WORD if specials is None else specials
    spark = tokens_df.sparkSession
    agg = _first_occurrence(tokens_df.where(~F.col("token").isin(*specials)))
    if min_freq > 1:
        agg = agg.where(F.col("freq") >= min_freq)
    agg = materialize(agg)
    body = _rank_tokens(agg, len(specials))
    # The finished table is written once: encoders check its size and
    # broadcast it, which must not re-run the ranking each time.
    made = materialize(specials_frame(spark, specials).unionByName(body))
    released(agg)
    return made


def word_vocab(df: DataFrame, text_col: str = "text", order_col: str = "doc_ord",
               lowercase: bool = True) -> DataFrame:
    """Whitespace-word vocabulary with 4 specials; lower-cased by default."""
    text = F.lower(text_col) if lowercase else F.col(text_col)
    return build_vocab(counted(df, word_spec(), text, None, order_col), specials=SPECIALS_WORD)


def vocab_from_list(df: DataFrame, token_col: str = "token", order_col: str = "ord",
                    pos_col: str | None = None, specials: list[str] | None = None) -> DataFrame:
    """Vocabulary from an ordered token list: de-duplicated by first position,
    specials in the list dropped, specials prepended.  The list order is
    ``(order_col, pos_col)``."""
    pos = F.col(pos_col) if pos_col else F.lit(0)
    rows = df.select(F.col(order_col).cast("bigint").alias("doc_ord"),
                     pos.alias("pos"), F.col(token_col).alias("token"))
    return build_vocab(rows, specials=SPECIALS_WORD if specials is None else specials)


def extend_vocab(vocab: DataFrame, tokens_df: DataFrame) -> DataFrame:
    """Growing vocabulary: unseen tokens of ``tokens_df`` appended after the
    current maximum id, in first-occurrence order.  Distinct tokens are
    aggregated before the anti join, so only vocabulary-sized data shuffles."""
    seen = _first_occurrence(tokens_df)
    new = seen.join(vocab.select("token"), on="token", how="left_anti")
    next_id = vocab.agg(F.max("id")).first()[0]
    next_id = 0 if next_id is None else int(next_id) + 1
    new = materialize(new)
    made = materialize(vocab.unionByName(_rank_tokens(new, next_id)))
    released(new)
    return made


def char_vocab(spark: SparkSession, alphabet: str | None = None) -> DataFrame:
    """Fixed-alphabet vocabulary: ``<pad>``, ``<unk>``, then the alphabet's
    characters de-duplicated in order.  Encoders take its entries as a literal
    (alphabets beyond the basic plane: by a join, like any table)."""
    alphabet = DEFAULT_ALPHABET if alphabet is None else alphabet
    seen: dict[str, None] = dict.fromkeys(alphabet)
    rows = [(i, t, None, True) for i, t in enumerate(SPECIALS_SHORT)]
    rows += [(i + len(SPECIALS_SHORT), c, None, False) for i, c in enumerate(seen)]
    made = spark.createDataFrame(rows, VOCAB_SCHEMA)
    if all(ord(c) <= 0xFFFF for c in seen):
        made._alphabet_entries = [(i, t) for i, t, _, _ in rows]
    return made


def vocab_size(vocab: DataFrame) -> int:
    return vocab.count()


def vocab_preview(vocab: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` entries (ids are dense, so this is a filter)."""
    return vocab.where(F.col("id") < k)
