"""WordPiece: greedy longest-match-first subwords with ``##`` continuations.

The vocabulary is an input table (no pretrained files are fetched).  The
match is one relational plan for vocabularies of any size and runs on
*distinct* pre-tokens only:

1. every place ``(word, start)`` meets the vocabulary's pieces that begin with
   the same characters, in a block of its own pieces;
2. the longest piece at each place is kept, and where it ends is the word's
   next place (``ROUNDS`` times; then all places of words that go on);
3. each word follows its longest hits from position 0; one that cannot be
   covered, or is longer than ``max_chars``, becomes ``[UNK]``;
4. texts are written as codes of their runs between whitespace, and the pieces
   of the distinct runs are looked up for them (``encode.lookup_coded``).

Texts are cut at ASCII whitespace by Arrow, which no pre-token crosses; the
pre-tokeniser sees distinct runs only.

A vocabulary learned from a corpus has pieces of any length.  Its candidates
grow by doubling: a piece of ``n + 1`` to ``2 n`` characters is counted only
where the ``n`` characters at its start and those at its end are frequent
pieces, which a frequent piece's always are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.functions import accents
from lingotile.functions.text import TokenizerSpec
from lingotile.operators.encode import (BLOCKS_PER_PARTITION, _attach, _carried, _shuffle_partitions, _side, coded_entries,
                                        coded_lists, lookup, lookup_coded)
from lingotile.operators.ranking import global_rank, md5_bucket
from lingotile.operators.vocab import materialize, specials_frame
from lingotile.session import released, ship_package

# ---------------------------------------------------------------------------
# Fixed values (BERT-style basic tokenisation, cased; public algorithm).
WP_SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
WP_UNK = "[UNK]"
MAX_CHARS_PER_WORD = 100
ROUNDS = 3   # pieces of a word that are looked up one after another
# Control characters removed before splitting (Cc except tab/newline/CR, Cf, U+FFFD).
CONTROL_RE = r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}-\x{9f}\p{Cf}\x{fffd}]"
# Whitespace: tab, newline, carriage return and the Zs category.
BERT_WS = r"\t\n\r\p{Zs}"
# Punctuation: ASCII 33-47, 58-64, 91-96, 123-126 and the P categories.
PUNCT_BODY = r"\x{21}-\x{2f}\x{3a}-\x{40}\x{5b}-\x{60}\x{7b}-\x{7e}\p{P}"
# CJK ideograph blocks, each character its own token.
CJK_BODY = (r"\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}"
            r"\x{2b740}-\x{2b81f}\x{2b820}-\x{2ceaf}\x{f900}-\x{faff}\x{2f800}-\x{2fa1f}")
PRETOKEN_RE = f"[{CJK_BODY}]|[{PUNCT_BODY}]|[^{BERT_WS}{PUNCT_BODY}{CJK_BODY}]+"
# Decoder clean-up of spaces before punctuation and English clitics, in order.
CLEANUP_REPLACEMENTS = [(" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"),
                        (" n't", "n't"), (" 'm", "'m"), (" 's", "'s"), (" 've", "'ve"),
                        (" 're", "'re")]
# ---------------------------------------------------------------------------


def pretokenize(text: Column | str, uncased: bool = False) -> Column:
    """Cleaned text split on whitespace, punctuation and CJK characters;
    ``uncased`` lower-cases it and takes accents off before the split."""
    t = F.col(text) if isinstance(text, str) else text
    cleaned = F.regexp_replace(F.coalesce(t, F.lit("")), CONTROL_RE, "")
    if uncased:
        cleaned = accents.uncased(cleaned)
    return F.regexp_extract_all(cleaned, F.lit(PRETOKEN_RE), F.lit(0))


def _runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs of texts between ASCII whitespace, and each text's number of
    them.  Vertical tab and form feed are control characters, which go."""
    for c in "\x0b\x0c":
        if pc.any(pc.match_substring(texts, c)).as_py():
            texts = pc.replace_substring(texts, c, "")
    lists = pc.ascii_split_whitespace(texts)
    runs = lists.flatten()
    real = pc.not_equal(runs, "")
    row = pc.list_parent_indices(lists).filter(real).to_numpy(zero_copy_only=False)
    return runs.filter(real), np.bincount(row, minlength=len(texts))


def _clean_text(text: Column | str) -> Column:
    # What is no UTF-8 becomes U+FFFD, which the pre-tokeniser removes.
    return F.make_valid_utf8(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _counted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        coded = pc.dictionary_encode(_runs(batch.column(0))[0])
        n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
        yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n.astype(np.int64))], names=["run", "n"])


def counted_words(df: DataFrame, text_col: str = "text", uncased: bool = False) -> DataFrame:
    """``(word, wf)``: the distinct pre-tokens of all texts and how often each
    occurs.  Runs are counted in their task; the distinct ones are split."""
    ship_package(df.sparkSession)
    runs = df.select(_clean_text(text_col).alias("text")).mapInArrow(_counted_runs, "run string, n bigint")
    runs = runs.groupBy("run").agg(F.sum("n").alias("n"))
    return runs.select("n", F.explode(pretokenize("run", uncased)).alias("word")).groupBy("word").agg(F.sum("n").alias("wf"))


def _piece(word: Column, s: Column, length: Column) -> Column:
    sub = F.substring(word, s + 1, length)
    return F.when(s == 0, sub).otherwise(F.concat(F.lit("##"), sub))


def _block(piece: Column, blocks: int) -> Column:
    """Where a piece and all texts that begin with it are: by its first two
    characters (four with the ``##``), -1 for a piece that is shorter."""
    first = F.when(F.startswith(piece, F.lit("##")), F.substring(piece, 1, 4)).otherwise(F.substring(piece, 1, 2))
    short = F.length(piece) < F.when(F.startswith(piece, F.lit("##")), 4).otherwise(2)
    return F.when(short, -1).otherwise(F.pmod(F.xxhash64(first), F.lit(blocks))).cast("int")


def _longest_hits(longest: int):
    """mapInArrow function over rows sorted by (block, s): a block's pieces
    (no s), then the places of its words; gives the longest piece at each.
    Held are one block's pieces and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known = None, set()
        for batch in batches:
            words, starts, lengths = [], [], []
            for b, w, s in zip(*(batch.column(c).to_pylist() for c in ("_block", "word", "s"))):
                if b != block:
                    block, known = b, set()
                if s is None:
                    known.add(w)
                    continue
                text, extra = ("##" + w[s:], 2) if s else (w, 0)
                for n in range(min(longest, len(w) - s), 0, -1):
                    if text[:n + extra] in known:
                        words.append(w)
                        starts.append(s)
                        lengths.append(n)
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(starts, pa.int32()), pa.array(lengths, pa.int32())], ["word", "s", "l"])

    return run


def _all_places(words: DataFrame) -> DataFrame:
    return words.where(F.length("word") > 0).select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("s"))


def _hits(words: DataFrame, vocab: DataFrame, longest: int, places: DataFrame | None = None) -> DataFrame:
    """``(word, s, l)``: the longest piece of the vocabulary at every place of
    every word that has one (or at ``places(word, s)``).  Pieces and places meet
    in blocks by their first characters, so a place is one row, not one for each
    length; the few pieces shorter than that are in all blocks."""
    ship_package(words.sparkSession)
    side, _ = _side(vocab, "token", "id", "_id")
    parts = _shuffle_partitions(words)
    blocks = BLOCKS_PER_PARTITION * parts
    pieces = side.where(F.col("_id").isNotNull() & F.col("_k").isNotNull()).withColumn("_block", _block(F.col("_k"), blocks))
    everywhere = F.when(F.col("_block") < 0, F.sequence(F.lit(0), F.lit(blocks - 1))).otherwise(F.array("_block"))
    pieces = pieces.select(F.explode(everywhere).alias("_block"), F.col("_k").alias("word"), F.lit(None).cast("int").alias("s"))
    places = _all_places(words) if places is None else places
    # A place shorter than its block's characters has short pieces only, which are in every block.
    at = _block(_piece(F.col("word"), F.col("s"), F.lit(longest + 4)), blocks)
    places = places.select(F.greatest(at, F.lit(0)).alias("_block"), "word", "s")
    dealt = pieces.unionByName(places).repartition(parts, "_block").sortWithinPartitions("_block", F.col("s").asc_nulls_first())
    return dealt.mapInArrow(_longest_hits(longest), "word string, s int, l int")


def _path_hits(words: DataFrame, vocab: DataFrame, longest: int) -> DataFrame:
    """Of ``_hits`` those that a word can come to from its first place: most
    words end after a few pieces, so their other places are not looked up.
    What goes on after ``ROUNDS`` pieces is looked up at all its later places."""
    places, found = words.where(F.length("word") > 0).select("word", F.lit(0).alias("s")), None
    for k in range(ROUNDS + 1):
        hits = materialize(_hits(words, vocab, longest, places))
        found = hits if found is None else found.unionByName(hits)
        on = hits.where(F.col("s") + F.col("l") < F.length("word")).select("word", (F.col("s") + F.col("l")).alias("s"))
        if k == ROUNDS or on.isEmpty():
            return found
        places = on if k + 1 < ROUNDS else on.select("word", F.explode(F.sequence("s", F.length("word") - 1)).alias("s"))


def wordpiece_table(words: DataFrame, vocab: DataFrame, max_chars: int = MAX_CHARS_PER_WORD,
                    unk: str = WP_UNK) -> DataFrame:
    """``words(word, ...)`` (distinct) -> adds ``pieces ARRAY<STRING>``."""
    longest = vocab.select(F.max(F.length(F.regexp_replace("token", "^##", "")))).first()[0] or 1
    best = _path_hits(words.where(F.length("word") <= max_chars).select("word"), vocab, int(longest))
    ends = best.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("s", "l"))).alias("_h"))
    init = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("cuts"))

    def step(acc, hit):
        end = hit["s"] + hit["l"]
        return F.when(hit["s"] == acc["pos"], F.struct(end.alias("pos"), F.concat(acc["cuts"], F.array(end)).alias("cuts"))).otherwise(acc)

    walked = words.join(ends, "word", "left").withColumn("_walk", F.aggregate(
        F.coalesce("_h", F.array().cast("array<struct<s:int,l:int>>")), init, step))
    cuts = F.col("_walk.cuts")
    begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at(cuts, k))
    pieces = F.transform(cuts, lambda e, k: _piece(F.col("word"), begin(k), e - begin(k)))
    covered = (F.col("_walk.pos") == F.length("word")) & (F.length("word") <= max_chars)
    return walked.withColumn("pieces", F.when(covered, pieces).otherwise(F.array(F.lit(unk)))).drop("_h", "_walk")


def wordpiece_tokenize(df: DataFrame, vocab: DataFrame, text_col: str = "text", key: str = "doc_id",
                       out: str = "tokens", max_chars: int = MAX_CHARS_PER_WORD,
                       keep: list[str] | None = None, uncased: bool = False) -> DataFrame:
    """Adds ``out ARRAY<STRING>``: the WordPiece tokens of ``text_col``
    (result columns: ``key``, ``keep``, ``out``; ``keep=None`` = all)."""
    carry = _carried(df, key, keep)
    # Split once: the distinct runs and the lookup both read the written codes.
    coded = coded_lists(df, _clean_text(text_col), key, carry, _runs)
    runs = coded_entries(coded).select(F.col("_probe").alias("run")).distinct()
    runs = materialize(runs.select("run", pretokenize("run", uncased).alias("_words")))
    words = materialize(runs.select(F.explode("_words").alias("word")).distinct())
    table = materialize(wordpiece_table(words, vocab, max_chars).select("word", "pieces"))
    spots = runs.select("run", F.posexplode("_words").alias("pos", "word")).join(table, "word")
    side = spots.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("pos", "pieces"))).alias("_s"))
    side = materialize(side.select(F.col("run").alias("_k"), F.transform("_s", lambda x: x["pieces"]).alias(out)))
    released(runs, words, table)
    grouped = lookup_coded(coded, side, key, carry, out, {f.name: f for f in df.schema.fields}, flat=True)
    return _attach(df, grouped, key, keep)


def wordpiece_spec(vocab: DataFrame, name: str = "wordpiece", uncased: bool = False) -> TokenizerSpec:
    """A comparison spec; its tokens are prepared by a join (not a pure
    column expression), see ``TokenizerSpec.prepare``."""
    col = f"_{name}_tokens"
    return TokenizerSpec(name, lambda t, lg: F.col(col), n_special=0, sep=" ",
                         prepare=lambda df, text_col, key: wordpiece_tokenize(df, vocab, text_col, key, col,
                                                                               uncased=uncased))


def decode_wordpiece(tokens: Column | str, cleanup: bool = True) -> Column:
    """Tokens (specials already removed) -> text: joined with spaces, ``##``
    continuations glued, optional clean-up of spaces before punctuation."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    s = F.replace(F.array_join(t, " "), F.lit(" ##"), F.lit(""))
    if cleanup:
        for a, b in CLEANUP_REPLACEMENTS:
            s = F.replace(s, F.lit(a), F.lit(b))
    return F.trim(s)


def frequent_pieces(words: DataFrame, min_freq: int, max_chars: int = MAX_CHARS_PER_WORD) -> DataFrame:
    """``(piece, freq)`` of all pieces of ``words(word, wf)`` that occur
    ``min_freq`` times and more; longer words than ``max_chars`` have none."""
    own = words.where((F.length("word") <= max_chars) & (F.length("word") > 0)).select(
        "word", "wf", F.length("word").alias("len"))
    spot = own.select("*", F.explode(F.sequence(F.lit(0), F.col("len") - 1)).alias("s")).withColumn("l", F.lit(1))
    n, found, before = 0, [], []
    while True:
        spot = spot.withColumn("piece", _piece(F.col("word"), F.col("s"), F.col("l")))
        kept = materialize(spot.groupBy("piece").agg(F.sum("wf").alias("freq")).where(F.col("freq") >= min_freq))
        found.append(kept)
        n = max(1, 2 * n)
        # Where a frequent piece of n characters begins, by word.
        at = lookup(spot.where(F.col("l") == n), "piece", kept, "piece", "freq", "_f", "word").where(F.col("_f").isNotNull())
        starts = materialize(at.groupBy("word").agg(F.first("wf").alias("wf"), F.first("len").alias("len"),
                                                    F.collect_list("s").alias("_at")))
        released(*before)   # the places of shorter pieces, which these were made of
        before = [starts]
        if n >= max_chars or starts.isEmpty():
            made = materialize(reduce(DataFrame.unionByName, found))
            released(*before, *found)
            return made
        more = starts.select("word", "wf", "len", "_at", F.explode("_at").alias("s"))
        more = more.where(F.col("s") + n < F.col("len")).select(
            "*", F.explode(F.sequence(F.lit(n + 1), F.least(F.lit(2 * n), F.col("len") - F.col("s")))).alias("l"))
        spot = more.where(F.array_contains("_at", F.col("s") + F.col("l") - n)).drop("_at")


def wordpiece_vocab_from_corpus(df: DataFrame, text_col: str = "text", min_freq: int = 2,
                                uncased: bool = False) -> DataFrame:
    """A WordPiece vocabulary derived from a corpus: word-initial pieces and
    ``##`` continuations of any length that occur at least ``min_freq``
    times.  Ids: the 5 specials, then pieces in ``md5(piece)`` order
    (deterministic, parallel rank)."""
    words = materialize(counted_words(df, text_col, uncased))
    frequent = frequent_pieces(words, min_freq)
    pieces = materialize(frequent.where(~F.col("piece").isin(*WP_SPECIALS)).withColumn("_key", F.md5("piece")))
    released(words, frequent)
    ranked = global_rank(pieces, ["_key", "piece"], out="id", start=len(WP_SPECIALS),
                         bucket=md5_bucket(F.col("_key")))
    body = ranked.select("id", F.col("piece").alias("token"), F.col("freq").cast("bigint").alias("freq"),
                         F.lit(False).alias("is_special"))
    made = materialize(specials_frame(df.sparkSession, WP_SPECIALS).unionByName(body))
    released(pieces)
    return made
