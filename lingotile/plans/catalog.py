"""Registered queries: each reads the driver tables at ``sf_dir`` and returns a
DataFrame; most have a DuckDB oracle with identical column names.

Compared outputs use scalar columns: token lists are joined with U+001F,
id lists with ",".
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingotile.functions import text as tx
from lingotile.operators import vocab as vb
from lingotile.operators.compare import summarize_tokenizers
from lingotile.plans import sqltext as S
from lingotile.plans.common import conversations, documents, joined, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from lingotile.session import ship_package

            ship_package(spark)   # workers import lingotile for the pandas UDFs
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


SUMMARY_SPECS = [tx.char_spec(), tx.word_spec(), tx.edgegram_spec(3),
                 tx.rule_spec("es"), tx.rule_spec("en"), tx.rule_spec("fr")]
CHAR_VOCAB_SIZE = 141


def _specials_values(specials: list[str]) -> str:
    rows = ", ".join(f"({i}::BIGINT, {S.q(t)}, NULL::BIGINT, true)" for i, t in enumerate(specials))
    return f"SELECT * FROM (VALUES {rows}) v(id, token, freq, is_special)"


def _specials_in(specials: list[str]) -> str:
    return "(" + ", ".join(S.q(t) for t in specials) + ")"


# ---------------------------------------------------------------------------
# C1 flagship: tokenizer summary per language x tokenizer
# ---------------------------------------------------------------------------

def _summary_oracle(source: str, group: str, specs_sql: list[tuple[str, str, int]],
                    fixed: dict[str, int]) -> str:
    tk = "\n  UNION ALL ".join(
        f"SELECT {group} AS language, {S.q(name)} AS tokenizer, {expr} AS t FROM src"
        for name, expr, _ in specs_sql)
    size_cases = " ".join(
        f"WHEN {S.q(name)} THEN " + (str(fixed[name]) if name in fixed else
                                      f"{n_sp} + coalesce(a.n, 0)")
        for name, _, n_sp in specs_sql)
    special_cases = " ".join(
        f"WHEN {S.q(name)} THEN tok IN {_specials_in(tx.SPECIALS_WORD[:n_sp])}"
        for name, _, n_sp in specs_sql)
    return f"""
WITH src AS ({source}),
tk AS (
  {tk}
),
stats AS (
  SELECT language, tokenizer, count(*) AS num_samples,
         CAST(sum(len(t)) AS DOUBLE) / count(*) AS avg_tokens,
         min(len(t)) AS min_tokens, max(len(t)) AS max_tokens
  FROM tk GROUP BY 1, 2),
ex AS (SELECT language, tokenizer, unnest(t) AS tok FROM tk),
obs AS (SELECT language, tokenizer, count(DISTINCT tok) AS observed FROM ex GROUP BY 1, 2),
allv AS (SELECT tokenizer, count(DISTINCT tok) AS n FROM ex
         WHERE NOT (CASE tokenizer {special_cases} ELSE false END) GROUP BY 1)
SELECT s.language, s.tokenizer, s.num_samples, s.avg_tokens, s.min_tokens, s.max_tokens,
       CAST(nullif(o.observed, 0) AS BIGINT) AS observed_vocab_size,
       CAST(CASE s.tokenizer {size_cases} END AS BIGINT) AS tokenizer_vocab_size,
       CAST(NULL AS VARCHAR) AS error
FROM stats s
LEFT JOIN obs o ON o.language = s.language AND o.tokenizer = s.tokenizer
LEFT JOIN allv a ON a.tokenizer = s.tokenizer
"""


def _summary_specs_sql(text: str = "text") -> list[tuple[str, str, int]]:
    return [("char", S.chars_sql(text), 2), ("word", S.words_sql(text), 4),
            ("edgegram", S.edgegrams_sql(text, 3), 2),
            ("rule_es", S.rule_sql(text, "es"), 2), ("rule_en", S.rule_sql(text, "en"), 2),
            ("rule_fr", S.rule_sql(text, "fr"), 2)]


@register("tokenizer_summary", _summary_oracle(
    "SELECT lang, text FROM documents", "lang", _summary_specs_sql(), {"char": CHAR_VOCAB_SIZE}))
def q_tokenizer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return summarize_tokenizers(docs, SUMMARY_SPECS, vocab_sizes={"char": CHAR_VOCAB_SIZE},
                                round_digits=None)


@register("tokenizer_summary_roles", _summary_oracle(
    "SELECT role, text, 'en' AS lang FROM conversations", "role", _summary_specs_sql(),
    {"char": CHAR_VOCAB_SIZE}))
def q_tokenizer_summary_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = conversations(spark, sf_dir)
    return summarize_tokenizers(conv, SUMMARY_SPECS, group_col="role",
                                vocab_sizes={"char": CHAR_VOCAB_SIZE}, round_digits=None)


from lingotile.operators import sketch  # noqa: E402


@register("tokenizer_summary_merged", f"""
SELECT language, tokenizer, num_samples, avg_tokens, min_tokens, max_tokens, observed_vocab_size, tokenizer_vocab_size,
       true AS observed_close, true AS size_close
FROM ({_summary_oracle("SELECT lang, text FROM documents", "lang", _summary_specs_sql(), {"char": CHAR_VOCAB_SIZE})})
""")
def q_tokenizer_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of short and of long documents, stored apart and merged, beside
    the exact summary: are both sizes within five standard errors?"""
    docs = documents(spark, sf_dir)
    short = F.length(F.coalesce("text", F.lit(""))) < 1000
    stored = []
    for part in (docs.where(short), docs.where(~short)):
        path = scratch_path(spark, "sketches")
        sketch.sketch_tokenizers(part, SUMMARY_SPECS).write.parquet(path)
        stored.append(spark.read.parquet(path))
    sizes = {"char": CHAR_VOCAB_SIZE}
    near = sketch.sketched_summary(sketch.merge_sketches(*stored), SUMMARY_SPECS, sizes)
    exact = summarize_tokenizers(docs, SUMMARY_SPECS, vocab_sizes=sizes, round_digits=None)
    names = ["observed_vocab_size", "tokenizer_vocab_size"]
    exact = exact.select(F.col("language").alias("_l"), F.col("tokenizer").alias("_t"), *names)
    same = F.col("language").eqNullSafe(F.col("_l")) & (F.col("tokenizer") == F.col("_t"))

    def close(name: str):
        gap = F.abs(F.coalesce(near[name], F.lit(0)) - F.coalesce(exact[name], F.lit(0)))
        return gap <= 5 * sketch.error() * F.coalesce(exact[name], F.lit(0)) + 1

    return near.join(exact, same, "left").select(
        *[near[c] for c in near.columns if c not in names], *[exact[n] for n in names],
        close(names[0]).alias("observed_close"), close(names[1]).alias("size_close"))


# ---------------------------------------------------------------------------
# T1-T4 tokenizers (per document, tokens joined with U+001F)
# ---------------------------------------------------------------------------

def _tokens_oracle(expr: str) -> str:
    return (f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, {S.join_list('t')} AS tokens "
            f"FROM (SELECT doc_id, {expr} AS t FROM documents)")


def _tokens_query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = documents(spark, sf_dir)
        t = fn(docs)
        return docs.select("doc_id", F.size(t).cast("bigint").alias("n_tokens"),
                           joined(t).alias("tokens"))
    return run


for _name, _fn, _sql in [
    ("char_tokens", lambda d: tx.chars("text"), S.chars_sql("text")),
    ("word_tokens", lambda d: tx.words("text"), S.words_sql("text")),
    ("edgegram_tokens", lambda d: tx.edgegrams("text", 3), S.edgegrams_sql("text", 3)),
    ("edgegram_prefix_only", lambda d: tx.edgegrams("text", 3, True, False),
     S.edgegrams_sql("text", 3, True, False)),
    ("edgegram_suffix_only", lambda d: tx.edgegrams("text", 3, False, True),
     S.edgegrams_sql("text", 3, False, True)),
    ("edgegram_n4", lambda d: tx.edgegrams("text", 4), S.edgegrams_sql("text", 4)),
    ("rule_tokens", lambda d: tx.rule_tokens("text", F.col("lang")),
     S.rule_by_lang_sql("text", "lang")),
]:
    register(_name, _tokens_oracle(_sql))(_tokens_query(_fn))


# ---------------------------------------------------------------------------
# V1-V10 vocabularies
# ---------------------------------------------------------------------------

def _vocab_oracle(token_source: str, specials: list[str], min_freq: int = 1,
                  extra_where: str = "") -> str:
    """``token_source`` yields ``(doc_ord, pos, token)``."""
    return f"""
WITH t AS ({token_source}),
g AS (SELECT token, count(*) AS freq, min(CAST(doc_ord AS HUGEINT) * 4294967296 + pos) AS f FROM t
      WHERE token NOT IN {_specials_in(specials)} {extra_where}
      GROUP BY token HAVING count(*) >= {min_freq})
SELECT CAST(row_number() OVER (ORDER BY f) + {len(specials) - 1} AS BIGINT) AS id, token,
       CAST(freq AS BIGINT) AS freq, false AS is_special FROM g
UNION ALL {_specials_values(specials)}
"""


def _exploded_sql(list_expr: str, table: str = "documents", ord_expr: str = "doc_id") -> str:
    return (f"SELECT doc_ord, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos "
            f"FROM (SELECT {ord_expr} AS doc_ord, {list_expr} AS w FROM {table})")


CONV_ORD_SQL = "(conv_id * 1048576 + turn)"


@register("vocab_words", _vocab_oracle(_exploded_sql(S.words_sql("text")), tx.SPECIALS_WORD))
def q_vocab_words(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return vb.build_vocab(vb.token_rows(docs, tx.words("text")), specials=tx.SPECIALS_WORD)


@register("vocab_min_freq", _vocab_oracle(_exploded_sql(S.words_sql("text")), tx.SPECIALS_WORD, 2))
def q_vocab_min_freq(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return vb.build_vocab(vb.token_rows(docs, tx.words("text")), min_freq=2,
                          specials=tx.SPECIALS_WORD)


@register("word_vocab_lower", _vocab_oracle(_exploded_sql(S.lower_words_sql("text")),
                                            tx.SPECIALS_WORD))
def q_word_vocab_lower(spark, sf_dir):
    return vb.word_vocab(documents(spark, sf_dir), lowercase=True)


@register("vocab_edgegram", _vocab_oracle(_exploded_sql(S.edgegrams_sql("text", 3)),
                                          tx.SPECIALS_SHORT))
def q_vocab_edgegram(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)),
                          specials=tx.SPECIALS_SHORT)


@register("vocab_from_list", _vocab_oracle(
    _exploded_sql(S.words_sql("text"), "conversations", CONV_ORD_SQL), tx.SPECIALS_WORD))
def q_vocab_from_list(spark, sf_dir):
    conv = conversations(spark, sf_dir)
    listing = conv.select("doc_ord", F.posexplode(tx.words("text")).alias("pos", "token"))
    return vb.vocab_from_list(listing, "token", "doc_ord", "pos")


# ---------------------------------------------------------------------------
# Shared corpus shapes for the pipeline queries
# ---------------------------------------------------------------------------

from lingotile.operators import encode as en  # noqa: E402
from lingotile.operators import split as sp  # noqa: E402
from lingotile.plans.common import joined_ids  # noqa: E402

# A four-language map (the default three plus German, which
# the test corpus also contains), in corpus order.
LANG4 = {"es": 0, "en": 1, "fr": 2, "de": 3}
LABEL_SQL = "(CASE lang WHEN 'es' THEN 0 WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 END)"
LABEL3_SQL = "(CASE lang WHEN 'es' THEN 0 WHEN 'en' THEN 1 WHEN 'fr' THEN 2 END)"   # default 3-language map
# Corpus order of the labelled corpus: languages in map order, then doc_id.
LORD_SQL = f"({LABEL_SQL} * 1099511627776 + doc_id)"


def labelled_docs(spark, sf_dir):
    """Documents with ``label`` from LANG4 and ``doc_ord`` = language order,
    then id (label << 40 | doc_id)."""
    d = sp.encode_label(documents(spark, sf_dir), LANG4)
    return d.withColumn("doc_ord", F.shiftleft(F.col("label").cast("bigint"), 40) + F.col("doc_id"))


def _vocab_cte(token_source: str, specials: list[str], min_freq: int = 1) -> str:
    return "(" + _vocab_oracle(token_source, specials, min_freq) + ")"


def _encode_oracle(list_expr: str, vocab_sql: str, table: str = "documents",
                   id_expr: str = "doc_id", unk: int = 1) -> str:
    return f"""
WITH v AS {vocab_sql},
src AS (SELECT {id_expr} AS doc_id, {list_expr} AS w FROM {table}),
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM src),
e AS (SELECT t.doc_id, t.pos, coalesce(v.id, {unk}) AS id FROM t LEFT JOIN v ON v.token = t.token)
SELECT s.doc_id, CAST(count(e.id) AS BIGINT) AS n_tokens,
       coalesce(string_agg(CAST(e.id AS VARCHAR), ',' ORDER BY e.pos), '') AS ids
FROM src s LEFT JOIN e ON e.doc_id = s.doc_id GROUP BY s.doc_id
"""


def _ids_out(df, ids="ids"):
    return df.select("doc_id", F.size(ids).cast("bigint").alias("n_tokens"), joined_ids(ids).alias("ids"))


WORDS_DOC = _exploded_sql(S.words_sql("text"))
EDGE_CONV = _exploded_sql(S.edgegrams_sql("text", 3), "conversations", CONV_ORD_SQL)
EDGE_LORD = _exploded_sql(S.edgegrams_sql("text", 3), "documents", LORD_SQL)

# Default alphabet as SQL: characters de-duplicated by first position.
CHAR_VOCAB_SQL = (
    "(SELECT CAST(row_number() OVER (ORDER BY p) + 1 AS BIGINT) AS id, c AS token FROM ("
    "SELECT c, min(p) AS p FROM (SELECT unnest(l) AS c, generate_subscripts(l, 1) AS p FROM "
    f"(SELECT regexp_extract_all({S.q(vb.DEFAULT_ALPHABET)}, '(?s).') AS l)) GROUP BY c) "
    "UNION ALL SELECT 0, '<pad>' UNION ALL SELECT 1, '<unk>')")


# ---------------------------------------------------------------------------
# V1, V5, V6, V8, V10
# ---------------------------------------------------------------------------

@register("char_vocab", f"""
WITH v AS {CHAR_VOCAB_SQL},
c AS (SELECT unnest({S.chars_sql('text')}) AS token FROM documents),
f AS (SELECT token, count(*) AS n FROM c GROUP BY token)
SELECT v.id, v.token, CAST(coalesce(f.n, 0) AS BIGINT) AS corpus_freq
FROM v LEFT JOIN f ON f.token = v.token
""")
def q_char_vocab(spark, sf_dir):
    """Default alphabet vocabulary with each entry's frequency in the corpus."""
    docs = documents(spark, sf_dir)
    freq = (docs.select(F.explode(tx.chars("text")).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("corpus_freq")))
    v = vb.char_vocab(spark)
    return v.join(freq, "token", "left").select(
        "id", "token", F.coalesce("corpus_freq", F.lit(0)).cast("bigint").alias("corpus_freq"))


@register("classifier_vocab", _vocab_oracle(EDGE_LORD, tx.SPECIALS_SHORT))
def q_classifier_vocab(spark, sf_dir):
    """Growing edgegram vocabulary built over all labelled texts (es, en, fr,
    de order), before any split."""
    docs = labelled_docs(spark, sf_dir)
    return vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)


def _extend_oracle() -> str:
    return f"""
WITH base AS {_vocab_cte(EDGE_CONV, tx.SPECIALS_SHORT)},
t AS ({_exploded_sql(S.edgegrams_sql("text", 3))}),
g AS (SELECT token, count(*) AS freq, min(CAST(doc_ord AS HUGEINT) * 4294967296 + pos) AS f FROM t
      WHERE token NOT IN (SELECT token FROM base) GROUP BY token)
SELECT * FROM base
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY f) + (SELECT max(id) FROM base) AS BIGINT), token,
       CAST(freq AS BIGINT), false FROM g
"""


@register("vocab_extend", _extend_oracle())
def q_vocab_extend(spark, sf_dir):
    """Edgegram vocabulary of the conversations, grown with the documents."""
    conv = conversations(spark, sf_dir)
    base = vb.build_vocab(vb.token_rows(conv, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)
    docs = documents(spark, sf_dir)
    return vb.extend_vocab(base, vb.token_rows(docs, tx.edgegrams("text", 3)))


@register("vocab_sizes", f"""
SELECT 'word_lower' AS vocab, CAST(count(*) AS BIGINT) AS size FROM {_vocab_cte(_exploded_sql(S.lower_words_sql("text")), tx.SPECIALS_WORD)}
UNION ALL SELECT 'word', CAST(count(*) AS BIGINT) FROM {_vocab_cte(WORDS_DOC, tx.SPECIALS_WORD)}
UNION ALL SELECT 'word_min2', CAST(count(*) AS BIGINT) FROM {_vocab_cte(WORDS_DOC, tx.SPECIALS_WORD, 2)}
UNION ALL SELECT 'edgegram', CAST(count(*) AS BIGINT) FROM {_vocab_cte(_exploded_sql(S.edgegrams_sql("text", 3)), tx.SPECIALS_SHORT)}
UNION ALL SELECT 'char', CAST(count(*) AS BIGINT) FROM {CHAR_VOCAB_SQL}
""")
def q_vocab_sizes(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vocabs = {
        "word_lower": vb.word_vocab(docs, lowercase=True),
        "word": vb.build_vocab(vb.token_rows(docs, tx.words("text"))),
        "word_min2": vb.build_vocab(vb.token_rows(docs, tx.words("text")), min_freq=2),
        "edgegram": vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)),
                                   specials=tx.SPECIALS_SHORT),
        "char": vb.char_vocab(spark),
    }
    out = None
    for name, v in vocabs.items():
        part = v.agg(F.count(F.lit(1)).cast("bigint").alias("size")).select(
            F.lit(name).alias("vocab"), "size")
        out = part if out is None else out.unionByName(part)
    return out


@register("vocab_preview", f"SELECT * FROM {_vocab_cte(WORDS_DOC, tx.SPECIALS_WORD)} WHERE id < 12")
def q_vocab_preview(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return vb.vocab_preview(vb.build_vocab(vb.token_rows(docs, tx.words("text"))), 12)


# ---------------------------------------------------------------------------
# E1-E7 encode
# ---------------------------------------------------------------------------

@register("encode_chars", _encode_oracle(S.chars_sql("text"), CHAR_VOCAB_SQL))
def q_encode_chars(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return _ids_out(en.encode(docs, tx.chars("text"), vb.char_vocab(spark), keep=[]))


@register("encode_words", _encode_oracle(S.words_sql("text"), _vocab_cte(WORDS_DOC, tx.SPECIALS_WORD, 2)))
def q_encode_words(spark, sf_dir):
    """Words against the min_freq=2 vocabulary: singletons become <unk>."""
    docs = documents(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(docs, tx.words("text")), min_freq=2)
    return _ids_out(en.encode(docs, tx.words("text"), v, keep=[]))


@register("encode_words_lower_vocab", _encode_oracle(
    S.words_sql("text"), _vocab_cte(_exploded_sql(S.lower_words_sql("text")), tx.SPECIALS_WORD)))
def q_encode_words_lower_vocab(spark, sf_dir):
    """Words as written against the lower-cased corpus vocabulary."""
    docs = documents(spark, sf_dir)
    return _ids_out(en.encode(docs, tx.words("text"), vb.word_vocab(docs, lowercase=True), keep=[]))


RULE_CONV = _exploded_sql(S.rule_sql("text", "es"), "conversations", CONV_ORD_SQL)


@register("numericalize", _encode_oracle(S.rule_by_lang_sql("text", "lang"),
                                         _vocab_cte(RULE_CONV, tx.SPECIALS_WORD)))
def q_numericalize(spark, sf_dir):
    """Rule tokens of each document (its own language's rule) numericalised
    with a vocabulary built from the conversations."""
    conv = conversations(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(conv, tx.rule_tokens("text", "es")))
    docs = documents(spark, sf_dir)
    return _ids_out(en.encode(docs, tx.rule_tokens("text", F.col("lang")), v, keep=[]))


@register("encode_edgegram", _encode_oracle(S.edgegrams_sql("text", 3),
                                            _vocab_cte(EDGE_CONV, tx.SPECIALS_SHORT)))
def q_encode_edgegram(spark, sf_dir):
    """Frozen edgegram vocabulary (from conversations): unseen grams -> <unk>."""
    conv = conversations(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(conv, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)
    docs = documents(spark, sf_dir)
    return _ids_out(en.encode(docs, tx.edgegrams("text", 3), v, keep=[]))


@register("encode_growing", _encode_oracle(S.edgegrams_sql("text", 3), "(" + _extend_oracle() + ")"))
def q_encode_growing(spark, sf_dir):
    """Encode with growth: the vocabulary is extended with the documents'
    unseen grams first, then every gram has an id."""
    conv = conversations(spark, sf_dir)
    base = vb.build_vocab(vb.token_rows(conv, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)
    docs = documents(spark, sf_dir)
    grams = tx.edgegrams("text", 3)
    grown = vb.extend_vocab(base, vb.token_rows(docs, grams))
    return _ids_out(en.encode(docs, grams, grown, keep=[]))


@register("unk_rate", f"""
WITH e AS ({_encode_oracle(S.words_sql("text"), _vocab_cte(WORDS_DOC, tx.SPECIALS_WORD, 2))})
SELECT d.lang, CAST(sum(e.n_tokens) AS BIGINT) AS n_tokens,
       CAST(sum(len(list_filter(string_split(e.ids, ','), lambda x: x = '1'))) AS BIGINT) AS n_unk,
       CAST(sum(len(list_filter(string_split(e.ids, ','), lambda x: x = '1'))) AS DOUBLE) / sum(e.n_tokens) AS unk_rate
FROM e JOIN documents d ON d.doc_id = e.doc_id GROUP BY d.lang
""")
def q_unk_rate(spark, sf_dir):
    docs = documents(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(docs, tx.words("text")), min_freq=2)
    return en.unk_rate(en.encode(docs, tx.words("text"), v, keep=["lang"]), "ids", "lang")


# ---------------------------------------------------------------------------
# E8-E12 collate / fixed length / batches, D1-D7 decode
# ---------------------------------------------------------------------------

MD5_SQL = "md5(concat_ws('|', '{seed}', CAST(doc_id AS VARCHAR)))"
VOCAB_WORDS_SQL = _vocab_cte(WORDS_DOC, tx.SPECIALS_WORD)
CLS_VOCAB_SQL = _vocab_cte(EDGE_LORD, tx.SPECIALS_SHORT)


def _id_list_cte(list_expr: str, vocab_sql: str, src: str) -> str:
    """-> (doc_id, ids BIGINT[]) for every row of ``src`` (doc_id, text)."""
    return f"""(
  WITH v AS {vocab_sql},
  t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
        FROM (SELECT doc_id, {list_expr} AS w FROM {src})),
  e AS (SELECT t.doc_id, list(coalesce(v.id, 1) ORDER BY t.pos) AS ids
        FROM t LEFT JOIN v ON v.token = t.token GROUP BY t.doc_id)
  SELECT s.doc_id, coalesce(e.ids, CAST([] AS BIGINT[])) AS ids FROM {src} s LEFT JOIN e ON e.doc_id = s.doc_id)"""


COLLATE_SQL = f"""
WITH b AS (SELECT doc_id, {LABEL_SQL} AS label, text,
                  CAST(floor((row_number() OVER (ORDER BY {MD5_SQL.format(seed=42)}, doc_id) - 1) / 16) AS BIGINT) AS batch_id
           FROM documents),
i AS {_id_list_cte(S.words_sql("text"), VOCAB_WORDS_SQL, "b")},
x AS (SELECT b.doc_id, b.label, b.batch_id, list_concat([CAST(2 AS BIGINT)], i.ids, [CAST(3 AS BIGINT)]) AS ids
      FROM b JOIN i ON i.doc_id = b.doc_id),
p AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS m FROM x)
SELECT batch_id, doc_id, label,
       list_concat(ids, list_transform(range(m - len(ids)), lambda k: CAST(0 AS BIGINT))) AS ids FROM p
"""


def _collate(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir)
    v = vb.build_vocab(vb.counted(documents(spark, sf_dir), tx.word_spec()))
    b = sp.assign_batches(docs.select("doc_id"), 16, shuffle_seed=42)   # ranks ids, not texts
    e = en.encode(docs, tx.words("text"), v, keep=["label"]).join(b, "doc_id")
    e = e.withColumn("ids", en.add_bos_eos("ids"))
    return sp.pad_batches(e, "ids", "batch_id"), v


@register("collate", f"SELECT batch_id, doc_id, label, array_to_string(ids, ',') AS ids FROM ({COLLATE_SQL})")
def q_collate(spark, sf_dir):
    """Shuffled batches of 16: <bos> ids <eos>, padded to the batch maximum."""
    e, _ = _collate(spark, sf_dir)
    return e.select("batch_id", "doc_id", "label", joined_ids("ids").alias("ids"))


@register("decode_words", f"""
WITH c AS ({COLLATE_SQL}),
v AS {VOCAB_WORDS_SQL},
t AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM c),
d AS (SELECT t.doc_id, t.pos, coalesce(v.token, '<unk>') AS token FROM t LEFT JOIN v ON v.id = t.id)
SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS decoded FROM d WHERE token <> '<pad>' GROUP BY doc_id
""")
def q_decode_words(spark, sf_dir):
    """Decode the collated batches: padding dropped, <bos>/<eos> kept."""
    e, v = _collate(spark, sf_dir)
    return en.decode(e, "ids", v, out="decoded", sep=" ", keep=[]).select("doc_id", "decoded")


FIXED_SQL = f"""
WITH d AS (SELECT doc_id, {LABEL_SQL} AS label, text FROM documents),
i AS {_id_list_cte(S.edgegrams_sql("text", 3), CLS_VOCAB_SQL, "d")}
SELECT d.doc_id, d.label,
       list_concat(i.ids, list_transform(range(100), lambda k: CAST(0 AS BIGINT)))[1:100] AS ids
FROM d JOIN i ON i.doc_id = d.doc_id
"""


def _fixed(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)
    e = en.encode(docs, tx.edgegrams("text", 3), v, keep=["label"])
    return e.withColumn("ids", en.pad_or_truncate("ids", 100)), v


@register("fixed_length", f"SELECT doc_id, label, array_to_string(ids, ',') AS ids FROM ({FIXED_SQL})")
def q_fixed_length(spark, sf_dir):
    """Classifier input: edgegram ids truncated or 0-padded to 100."""
    e, _ = _fixed(spark, sf_dir)
    return e.select("doc_id", "label", joined_ids("ids").alias("ids"))


# Whole id lists, padded to at least 100 and never cut.
PADDED_SQL = f"""
WITH d AS (SELECT doc_id, text FROM documents),
i AS {_id_list_cte(S.edgegrams_sql("text", 3), CLS_VOCAB_SQL, "d")}
SELECT doc_id, list_concat(ids, list_transform(range(100 - len(ids)), lambda k: CAST(0 AS BIGINT))) AS ids FROM i
"""


def _padded(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)
    e = en.encode(docs, tx.edgegrams("text", 3), v, keep=[])
    return e.withColumn("ids", en.pad_to("ids", 100)), v


@register("decode_edgegram", f"""
WITH f AS ({PADDED_SQL}), v AS {CLS_VOCAB_SQL},
t AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM f),
d AS (SELECT t.doc_id, t.pos, coalesce(v.token, '<unk>') AS token FROM t LEFT JOIN v ON v.id = t.id)
SELECT f.doc_id, coalesce(x.decoded, '') AS decoded FROM f LEFT JOIN
  (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS decoded FROM d WHERE token <> '<pad>' GROUP BY doc_id) x
  ON x.doc_id = f.doc_id
""")
def q_decode_edgegram(spark, sf_dir):
    """Every gram of the whole texts; padding dropped."""
    e, v = _padded(spark, sf_dir)
    return en.decode(e, "ids", v, out="decoded", sep=" ", keep=[]).select("doc_id", "decoded")


@register("decode_tokens", f"""
WITH f AS ({PADDED_SQL}), v AS {CLS_VOCAB_SQL},
t AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM f),
d AS (SELECT t.doc_id, t.pos, coalesce(v.token, '<unk>') AS token FROM t LEFT JOIN v ON v.id = t.id)
SELECT doc_id, string_agg(token, chr(31) ORDER BY pos) AS tokens FROM d GROUP BY doc_id
""")
def q_decode_tokens(spark, sf_dir):
    """id -> token for every position, padding shown."""
    e, v = _padded(spark, sf_dir)
    t = en.decode_tokens(e, "ids", v, out="tokens", keep=[])
    return t.select("doc_id", joined("tokens").alias("tokens"))


@register("decode_chars", f"""
WITH v AS {CHAR_VOCAB_SQL},
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, {S.chars_sql('text')} AS w FROM documents)),
d AS (SELECT t.doc_id, t.pos, coalesce(v.token, '<unk>') AS token FROM t LEFT JOIN v ON v.token = t.token)
SELECT s.doc_id, coalesce(x.decoded, '') AS decoded FROM documents s LEFT JOIN
  (SELECT doc_id, string_agg(token, '' ORDER BY pos) AS decoded FROM d GROUP BY doc_id) x ON x.doc_id = s.doc_id
""")
def q_decode_chars(spark, sf_dir):
    docs = documents(spark, sf_dir)
    v = vb.char_vocab(spark)
    e = en.encode(docs, tx.chars("text"), v, keep=[])
    return en.decode(e, "ids", v, out="decoded", sep="", keep=[]).select("doc_id", "decoded")


@register("decode_rule_tokens", f"""
WITH v AS {_vocab_cte(RULE_CONV, tx.SPECIALS_WORD)},
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, {S.rule_by_lang_sql('text', 'lang')} AS w FROM documents)),
d AS (SELECT t.doc_id, t.pos, coalesce(v.token, '<unk>') AS token FROM t LEFT JOIN v ON v.token = t.token)
SELECT s.doc_id, coalesce(x.decoded, '') AS decoded FROM documents s LEFT JOIN
  (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS decoded FROM d GROUP BY doc_id) x ON x.doc_id = s.doc_id
""")
def q_decode_rule_tokens(spark, sf_dir):
    """Rule tokens through a conversations vocabulary and back: unseen
    tokens come back as <unk>."""
    conv = conversations(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(conv, tx.rule_tokens("text", "es")))
    docs = documents(spark, sf_dir)
    e = en.encode(docs, tx.rule_tokens("text", F.col("lang")), v, keep=[])
    return en.decode(e, "ids", v, out="decoded", sep=" ", keep=[]).select("doc_id", "decoded")


@register("roundtrip_char", f"""
WITH v AS {CHAR_VOCAB_SQL},
t AS (SELECT doc_id, unnest({S.chars_sql('text')}) AS token FROM documents),
u AS (SELECT t.doc_id, count(*) FILTER (WHERE v.id IS NULL) AS n_unk FROM t LEFT JOIN v ON v.token = t.token
      GROUP BY t.doc_id)
SELECT d.lang, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(count(*) FILTER (WHERE coalesce(u.n_unk, 0) = 0) AS BIGINT) AS n_roundtrip
FROM documents d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY d.lang
""")
def q_roundtrip_char(spark, sf_dir):
    """decode(encode(text)) == text, counted per language."""
    docs = documents(spark, sf_dir)
    v = vb.char_vocab(spark)
    e = en.decode(en.encode(docs, tx.chars("text"), v, keep=["lang", "text"]), "ids", v, out="decoded", sep="",
                  keep=["lang", "text"])
    return e.groupBy("lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.count(F.when(F.col("decoded") == F.col("text"), 1)).cast("bigint").alias("n_roundtrip"))


@register("prepare_for_scoring", f"""
WITH c AS (SELECT {CONV_ORD_SQL} AS doc_id, text FROM conversations),
i AS {_id_list_cte(S.edgegrams_sql("text", 3), CLS_VOCAB_SQL, "c")}
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(100), lambda k: CAST(0 AS BIGINT)))[1:100], ',') AS ids
FROM i
""")
def q_prepare_for_scoring(spark, sf_dir):
    """New texts (conversation turns) encoded with the frozen classifier
    vocabulary and fixed to length 100."""
    docs = labelled_docs(spark, sf_dir)
    v = vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)), specials=tx.SPECIALS_SHORT)
    conv = conversations(spark, sf_dir)
    e = en.encode(conv, tx.edgegrams("text", 3), v, keep=[])
    return e.select("doc_id", joined_ids(en.pad_or_truncate("ids", 100)).alias("ids"))


@register("batches", """
SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 32) AS BIGINT) AS batch_id FROM documents
""")
def q_batches(spark, sf_dir):
    """Unshuffled mini-batches of 32 in corpus order."""
    return sp.assign_batches(documents(spark, sf_dir), 32).select("doc_id", "batch_id")


# ---------------------------------------------------------------------------
# P1-P8 splits and labels, S10 default labels
# ---------------------------------------------------------------------------

STRAT_SQL = f"""
WITH d AS (SELECT doc_id, {LABEL_SQL} AS label FROM documents),
c AS (SELECT label, count(*) AS n FROM d GROUP BY label),
q1 AS (SELECT label, n, floor(CAST(n AS DECIMAL(30,10)) * 0.8) AS base,
              CAST(n AS DECIMAL(30,10)) * 0.8 - floor(CAST(n AS DECIMAL(30,10)) * 0.8) AS frac,
              (SELECT floor(CAST(sum(n) AS DECIMAL(30,10)) * 0.8) FROM c) AS n_train FROM c),
q2 AS (SELECT label, CAST(base + CASE WHEN row_number() OVER (ORDER BY frac DESC, label)
                                          <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q1),
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {MD5_SQL.format(seed=42)}, doc_id) - 1 AS rk FROM d)
SELECT r.doc_id, r.label, CASE WHEN rk < quota THEN 'train' ELSE 'val' END AS split FROM r JOIN q2 ON q2.label = r.label
"""


def _strat(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label")
    return sp.stratified_split(docs, 0.8, 42)


@register("stratified_split", STRAT_SQL)
def q_stratified_split(spark, sf_dir):
    """Stratified 80/20 split by language label, seed 42."""
    return _strat(spark, sf_dir).select("doc_id", "label", "split")


def _random_split_sql(ratio: str, clamp: bool) -> str:
    cut = f"floor(count(*) OVER () * {ratio})"
    if clamp:
        cut = f"CASE WHEN count(*) OVER () > 1 THEN greatest(1, least({cut}, count(*) OVER () - 1)) ELSE 1 END"
    return f"""
SELECT doc_id, CASE WHEN rk < cut THEN 'train' ELSE 'val' END AS split FROM (
  SELECT doc_id, row_number() OVER (ORDER BY {MD5_SQL.format(seed=42)}, doc_id) - 1 AS rk, {cut} AS cut FROM documents)
"""


@register("random_split", _random_split_sql("0.8", False))
def q_random_split(spark, sf_dir):
    return sp.random_split(documents(spark, sf_dir), 0.8, 42).select("doc_id", "split")


@register("random_split_clamped", _random_split_sql("0.0005", True))
def q_random_split_clamped(spark, sf_dir):
    """Fallback split with a ratio whose cut rounds to 0: clamped to 1 row."""
    return sp.random_split(documents(spark, sf_dir), 0.0005, 42, clamp=True).select("doc_id", "split")


@register("can_stratify", f"""
WITH c AS (SELECT {LABEL_SQL} AS label, count(*) AS n FROM documents GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS n_labels, CAST(min(n) AS BIGINT) AS min_count,
       CAST(sum(n) AS BIGINT) AS n_rows, count(*) > 1 AND min(n) >= 2 AND sum(n) > 1 AS can_stratify FROM c
""")
def q_can_stratify(spark, sf_dir):
    return sp.can_stratify(labelled_docs(spark, sf_dir))


LANG4_NAME_SQL = "(CASE label WHEN 0 THEN 'es' WHEN 1 THEN 'en' WHEN 2 THEN 'fr' WHEN 3 THEN 'de' ELSE CAST(label AS VARCHAR) END)"


@register("split_distribution", f"""
SELECT split, {LANG4_NAME_SQL} AS language, label, CAST(count(*) AS BIGINT) AS n FROM ({STRAT_SQL}) GROUP BY split, label
""")
def q_split_distribution(spark, sf_dir):
    return sp.split_distribution(_strat(spark, sf_dir), LANG4)


@register("batch_counts", f"""
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(least(16, count(*)) AS BIGINT) AS batch_size,
       CAST(ceil(count(*) / least(16, count(*))) AS BIGINT) AS n_batches FROM ({STRAT_SQL}) GROUP BY split
""")
def q_batch_counts(spark, sf_dir):
    return sp.batch_counts(_strat(spark, sf_dir), 16)


@register("label_map", f"SELECT doc_id, {LABEL_SQL} AS label, lang AS language FROM documents")
def q_label_map(spark, sf_dir):
    """language -> label -> language through the map and its inverse."""
    d = sp.encode_label(documents(spark, sf_dir), LANG4)
    return sp.decode_label(d, LANG4, "label", "language").select("doc_id", "label", "language")


@register("default_labels", """
SELECT doc_id, 0 AS default_label,
       CASE WHEN (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 2 = 0 THEN 1 ELSE 0 END AS alt_label
FROM documents
""")
def q_default_labels(spark, sf_dir):
    """No labels -> 0; demo labels alternate 1, 0 within each language."""
    d = sp.with_default_label(documents(spark, sf_dir), "default_label")
    return sp.alternate_label(d, "doc_ord", "lang", "alt_label").select("doc_id", "default_label", "alt_label")


# ---------------------------------------------------------------------------
# C2, C5-C7 comparison extras
# ---------------------------------------------------------------------------

from lingotile.operators import compare as cmp  # noqa: E402
from lingotile.operators import nn  # noqa: E402

VOCAB_EDGE_SQL = _vocab_cte(_exploded_sql(S.edgegrams_sql("text", 3)), tx.SPECIALS_SHORT)


@register("tokenizer_examples", f"""
WITH s AS (SELECT doc_id, lang, text FROM (
             SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 2),
tk AS (SELECT lang, doc_id, text, 'char' AS tokenizer, {S.chars_sql('text')} AS t FROM s
       UNION ALL SELECT lang, doc_id, text, 'word', {S.words_sql('text')} FROM s
       UNION ALL SELECT lang, doc_id, text, 'edgegram', {S.edgegrams_sql('text', 3)} FROM s),
ex AS (SELECT doc_id, tokenizer, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM tk),
vc AS {CHAR_VOCAB_SQL}, vw AS {VOCAB_WORDS_SQL}, ve AS {VOCAB_EDGE_SQL},
ids AS (SELECT ex.doc_id, ex.tokenizer, list(coalesce(vc.id, vw.id, ve.id, 1) ORDER BY ex.pos) AS ids
        FROM ex
        LEFT JOIN vc ON ex.tokenizer = 'char' AND vc.token = ex.token
        LEFT JOIN vw ON ex.tokenizer = 'word' AND vw.token = ex.token
        LEFT JOIN ve ON ex.tokenizer = 'edgegram' AND ve.token = ex.token
        GROUP BY ex.doc_id, ex.tokenizer)
SELECT tk.lang AS language, tk.tokenizer, tk.text, {S.join_list('tk.t')} AS tokens,
       CAST(len(tk.t) AS BIGINT) AS n_tokens,
       coalesce(array_to_string(ids.ids[1:12], ','), '') AS ids_preview, CAST(NULL AS VARCHAR) AS error
FROM tk LEFT JOIN ids ON ids.doc_id = tk.doc_id AND ids.tokenizer = tk.tokenizer
""")
def q_tokenizer_examples(spark, sf_dir):
    """First two texts per language through char, word and edgegram."""
    docs = documents(spark, sf_dir)
    specs = [tx.char_spec(), tx.word_spec(), tx.edgegram_spec(3)]
    vocabs = {"char": vb.char_vocab(spark),
              "word": vb.build_vocab(vb.token_rows(docs, tx.words("text"))),
              "edgegram": vb.build_vocab(vb.token_rows(docs, tx.edgegrams("text", 3)),
                                         specials=tx.SPECIALS_SHORT)}
    ex = cmp.collect_examples(docs, specs, vocabs, max_samples=2)
    return ex.select("language", "tokenizer", "text", joined("tokens").alias("tokens"), "n_tokens",
                     joined_ids("ids_preview").alias("ids_preview"), "error")


LANGS_SORTED = ["de", "en", "es", "fr"]


@register("summary_pivot", "SELECT tokenizer, " + ", ".join(
    f"max(avg_tokens) FILTER (WHERE language = '{lg}') AS {lg}" for lg in LANGS_SORTED)
    + " FROM (" + _summary_oracle("SELECT lang, text FROM documents", "lang", _summary_specs_sql(),
                                  {"char": CHAR_VOCAB_SIZE}) + ") GROUP BY tokenizer")
def q_summary_pivot(spark, sf_dir):
    """Average tokens per text: tokenizers x languages."""
    summary = q_tokenizer_summary(spark, sf_dir)
    return cmp.pivot_avg_tokens(summary, LANGS_SORTED)


@register("corpus_profile", """
SELECT lang AS language, CAST(count(*) AS BIGINT) AS n_lines, arg_min(text, doc_id) AS sample
FROM documents GROUP BY lang
""")
def q_corpus_profile(spark, sf_dir):
    return cmp.corpus_profile(documents(spark, sf_dir))


@register("word_vs_edgegram", _summary_oracle(
    "SELECT lang, text FROM documents", "lang",
    [("word", S.words_sql("text"), 4), ("edgegram", S.edgegrams_sql("text", 3), 2)], {}))
def q_word_vs_edgegram(spark, sf_dir):
    """Word against edgegram: corpus vocabulary size and tokens per text."""
    return cmp.summarize_tokenizers(documents(spark, sf_dir), [tx.word_spec(), tx.edgegram_spec(3)],
                                    round_digits=None)


# ---------------------------------------------------------------------------
# M1-M8, M13: embedding features and scoring
# ---------------------------------------------------------------------------

EMB_DIM = 64
HIDDEN_IDS = list(range(0, 8))
OUTPUT_IDS = list(range(8, 12))

POOLED_SQL = f"""
WITH v AS {CHAR_VOCAB_SQL},
d AS (SELECT doc_id, {LABEL_SQL} AS label, text FROM documents),
t AS (SELECT doc_id, unnest({S.chars_sql('text')}) AS token FROM d),
c AS (SELECT t.doc_id, coalesce(v.id, 1) AS id, count(*) AS w FROM t LEFT JOIN v ON v.token = t.token
      GROUP BY 1, 2 HAVING coalesce(v.id, 1) <> 0),
ed AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
p AS (SELECT c.doc_id, ed.dim, sum(c.w * ed.x) / sum(c.w) AS val FROM c JOIN ed ON ed.vec_id = c.id GROUP BY 1, 2),
g AS (SELECT d.doc_id, d.label, r.dim FROM d CROSS JOIN (SELECT range AS dim FROM range({EMB_DIM})) r),
pooled_rows AS (SELECT g.doc_id, g.label, g.dim, coalesce(p.val, 0.0) AS val FROM g
                LEFT JOIN p ON p.doc_id = g.doc_id AND p.dim = g.dim)
"""

LOGITS_SQL = POOLED_SQL + f""",
pooled AS (SELECT doc_id, label, list(val ORDER BY dim) AS vec FROM pooled_rows GROUP BY 1, 2),
w1 AS (SELECT vec_id AS j, CAST(embedding AS DOUBLE[]) AS w FROM embeddings WHERE vec_id BETWEEN {HIDDEN_IDS[0]} AND {HIDDEN_IDS[-1]}),
w2 AS (SELECT vec_id - {OUTPUT_IDS[0]} AS k, CAST(embedding[1:{len(HIDDEN_IDS)}] AS DOUBLE[]) AS w FROM embeddings
       WHERE vec_id BETWEEN {OUTPUT_IDS[0]} AND {OUTPUT_IDS[-1]}),
h AS (SELECT pooled.doc_id, pooled.label, list(greatest(list_dot_product(w1.w, pooled.vec), 0.0) ORDER BY w1.j) AS h
      FROM pooled CROSS JOIN w1 GROUP BY 1, 2),
lg AS (SELECT h.doc_id, h.label, list(list_dot_product(w2.w, h.h) ORDER BY w2.k) AS logits
       FROM h CROSS JOIN w2 GROUP BY 1, 2),
sc AS (SELECT doc_id, label, logits, list_position(logits, list_max(logits)) - 1 AS pred,
              list_max(logits) + ln(list_sum(list_transform(logits, lambda z: exp(z - list_max(logits))))) AS lse
       FROM lg)
"""


def _pooled(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir)
    e = en.encode(docs, tx.chars("text"), vb.char_vocab(spark), keep=["label", "doc_ord"])
    emb = table(spark, sf_dir, "embeddings")
    return nn.mean_pool(e, "ids", emb, EMB_DIM), emb


def _scored(spark, sf_dir):
    p, emb = _pooled(spark, sf_dir)
    w1 = nn.weights_from_table(emb, HIDDEN_IDS)
    w2 = nn.weights_from_table(emb, OUTPUT_IDS, width=len(HIDDEN_IDS))
    s = p.withColumn("logits", nn.mlp_logits("pooled", [(w1, None), (w2, None)]))
    return (s.withColumn("pred", nn.argmax("logits"))
            .withColumn("loss", nn.cross_entropy("logits", "label")))


@register("mean_pool", POOLED_SQL + "SELECT doc_id, CAST(dim AS BIGINT) AS dim, round(val, 4) AS value FROM pooled_rows")
def q_mean_pool(spark, sf_dir):
    """Padding-aware mean of the character embeddings of each document."""
    p, _ = _pooled(spark, sf_dir)
    return p.select("doc_id", F.posexplode("pooled").alias("dim", "value")).select(
        "doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("value", 4).alias("value"))


@register("lookup_embeddings", f"""
WITH v AS {CHAR_VOCAB_SQL},
t AS (SELECT doc_id, unnest({S.chars_sql('text')}) AS token FROM documents),
i AS (SELECT t.doc_id, coalesce(v.id, 1) AS id FROM t LEFT JOIN v ON v.token = t.token)
SELECT i.doc_id, CAST(count(e.vec_id) AS BIGINT) AS n_found, round(sum(CAST(e.embedding[1] AS DOUBLE)), 4) AS sum_dim0
FROM i LEFT JOIN embeddings e ON e.vec_id = i.id GROUP BY i.doc_id
""")
def q_lookup_embeddings(spark, sf_dir):
    """Every character id of every document looked up in the embedding table."""
    docs = documents(spark, sf_dir)
    e = en.encode(docs, tx.chars("text"), vb.char_vocab(spark), keep=[])
    rows = nn.lookup_embeddings(e, "ids", table(spark, sf_dir, "embeddings"))
    return rows.groupBy("doc_id").agg(
        F.count("vec").cast("bigint").alias("n_found"),
        F.round(F.sum(F.element_at("vec", 1)), 4).alias("sum_dim0"))


FLAT_T = 16


@register("flatten_embeddings", f"""
WITH v AS {CHAR_VOCAB_SQL},
t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos
      FROM (SELECT doc_id, {S.chars_sql('text')} AS w FROM documents)),
i AS (SELECT t.doc_id, t.pos, coalesce(v.id, 1) AS id FROM t LEFT JOIN v ON v.token = t.token),
e AS (SELECT vec_id, list_sum(CAST(embedding AS DOUBLE[])) AS s FROM embeddings)
SELECT i.doc_id, CAST(i.pos // {FLAT_T} AS BIGINT) AS chunk, CAST({FLAT_T} * {EMB_DIM} AS INTEGER) AS n_values,
       round(sum(CASE WHEN i.id = 0 THEN 0.0 ELSE coalesce(e.s, 0.0) END), 3) AS total
FROM i LEFT JOIN e ON e.vec_id = i.id GROUP BY 1, 2
""")
def q_flatten_embeddings(spark, sf_dir):
    """Every document's character ids, cut into consecutive windows of 16,
    each flattened to a 16 x 64 vector (summarised per window)."""
    docs = documents(spark, sf_dir)
    e = en.encode(docs, tx.chars("text"), vb.char_vocab(spark), keep=[])
    f = nn.flatten_chunks(e, "ids", table(spark, sf_dir, "embeddings"), FLAT_T, EMB_DIM, summary={
        "n_values": (T.IntegerType(), lambda m: np.full(len(m), m.shape[1], np.int32), F.size),
        "total": (T.DoubleType(), lambda m: m.sum(axis=1), lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x))})
    return f.select("doc_id", "chunk", "n_values", F.round("total", 3).alias("total"))


@register("mlp_logits", LOGITS_SQL + """
SELECT doc_id, CAST(k - 1 AS BIGINT) AS class, round(z, 4) AS logit
FROM (SELECT doc_id, unnest(logits) AS z, generate_subscripts(logits, 1) AS k FROM sc)
""")
def q_mlp_logits(spark, sf_dir):
    """Mean-pooled features through an 8-unit ReLU layer and a 4-class output."""
    s = _scored(spark, sf_dir)
    return s.select("doc_id", F.posexplode("logits").alias("class", "z")).select(
        "doc_id", F.col("class").cast("bigint").alias("class"), F.round("z", 4).alias("logit"))


@register("predict", LOGITS_SQL + "SELECT doc_id, CAST(pred AS INTEGER) AS pred FROM sc")
def q_predict(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "pred")


@register("predict_proba", LOGITS_SQL + """
SELECT doc_id, CAST(k - 1 AS BIGINT) AS class, round(p, 6) AS prob FROM (
  SELECT doc_id, unnest(list_transform(logits, lambda z: exp(z - lse))) AS p, generate_subscripts(logits, 1) AS k FROM sc)
""")
def q_predict_proba(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("proba", nn.softmax("logits"))
    return s.select("doc_id", F.posexplode("proba").alias("class", "p")).select(
        "doc_id", F.col("class").cast("bigint").alias("class"), F.round("p", 6).alias("prob"))


@register("cross_entropy", LOGITS_SQL + "SELECT doc_id, label, round(lse - logits[label + 1], 6) AS loss FROM sc")
def q_cross_entropy(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "label", F.round("loss", 6).alias("loss"))


@register("epoch_metrics", LOGITS_SQL + """,
b AS (SELECT *, floor((row_number() OVER (ORDER BY label, doc_id) - 1) / 16) AS batch_id, lse - logits[label + 1] AS loss FROM sc),
pb AS (SELECT batch_id, avg(loss) AS bl, count(*) AS n, sum(CASE WHEN pred = label THEN 1 ELSE 0 END) AS c FROM b GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS n_batches, round(avg(bl), 6) AS loss, CAST(sum(c) AS DOUBLE) / sum(n) AS accuracy FROM pb
""")
def q_epoch_metrics(spark, sf_dir):
    """Loss as the mean of per-batch means (batches of 16, corpus order) and accuracy."""
    s = sp.assign_batches(_scored(spark, sf_dir), 16)
    m = nn.batch_mean_loss(s, "loss", "batch_id", "pred", "label")
    return m.select("n_batches", F.round("loss", 6).alias("loss"), "accuracy")


@register("per_class_accuracy", LOGITS_SQL + f""",
m AS (SELECT * FROM (VALUES ('es', 0), ('en', 1), ('fr', 2), ('de', 3)) m(language, label)),
per AS (SELECT label, count(*) AS n, sum(CASE WHEN pred = label THEN 1 ELSE 0 END) AS c FROM sc GROUP BY 1)
SELECT m.language, m.label, CAST(coalesce(per.n, 0) AS BIGINT) AS total, CAST(coalesce(per.c, 0) AS BIGINT) AS correct,
       CASE WHEN per.n > 0 THEN CAST(per.c AS DOUBLE) / per.n END AS accuracy
FROM m LEFT JOIN per ON per.label = m.label
""")
def q_per_class_accuracy(spark, sf_dir):
    return nn.evaluate_predictions(_scored(spark, sf_dir), LANG4)


# ---------------------------------------------------------------------------
# T5 / E6 / D5 WordPiece over a vocabulary derived from the corpus
# ---------------------------------------------------------------------------

from lingotile.operators import wordpiece as wpc  # noqa: E402

WP_MIN_FREQ = 20
WP_VOCAB_SQL = f"""(
  WITH w AS (SELECT word, count(*) AS wf FROM (SELECT unnest({S.pretokenize_sql('text')}) AS word FROM documents) GROUP BY word),
  c1 AS (SELECT word, wf, unnest(range(0, length(word))) AS s FROM w WHERE length(word) <= {wpc.MAX_CHARS_PER_WORD}),
  c2 AS (SELECT word, wf, s, unnest(range(1, length(word) - s + 1)) AS l FROM c1),
  p AS (SELECT CASE WHEN s = 0 THEN substr(word, 1, l) ELSE '##' || substr(word, s + 1, l) END AS piece,
               sum(wf) AS freq FROM c2 GROUP BY 1),
  k AS (SELECT piece, freq FROM p WHERE freq >= {WP_MIN_FREQ} AND piece NOT IN {_specials_in(wpc.WP_SPECIALS)})
  SELECT CAST(row_number() OVER (ORDER BY md5(piece), piece) + {len(wpc.WP_SPECIALS) - 1} AS BIGINT) AS id,
         piece AS token, CAST(freq AS BIGINT) AS freq, false AS is_special FROM k
  UNION ALL {_specials_values(wpc.WP_SPECIALS)})"""

WP_TOKENS_SQL = f"""
WITH RECURSIVE v AS {WP_VOCAB_SQL},
pre AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT doc_id, {S.pretokenize_sql('text')} AS w FROM documents)),
dw AS (SELECT DISTINCT word FROM pre),
mx AS (SELECT max(length(regexp_replace(token, '^##', ''))) AS m FROM v),
c1 AS (SELECT word, unnest(range(0, length(word))) AS s FROM dw WHERE length(word) <= {wpc.MAX_CHARS_PER_WORD}),
c2 AS (SELECT word, s, unnest(range(1, least((SELECT m FROM mx), length(word) - s) + 1)) AS l FROM c1),
best AS (SELECT c2.word, c2.s, max(c2.s + c2.l) AS e FROM c2 JOIN v
           ON v.token = CASE WHEN c2.s = 0 THEN substr(c2.word, 1, c2.l) ELSE '##' || substr(c2.word, c2.s + 1, c2.l) END
         GROUP BY 1, 2),
walk AS (
  SELECT word, 0 AS pos, CAST([] AS VARCHAR[]) AS pieces FROM dw WHERE length(word) <= {wpc.MAX_CHARS_PER_WORD}
  UNION ALL
  SELECT w.word, b.e, list_append(w.pieces, CASE WHEN w.pos = 0 THEN substr(w.word, 1, b.e)
                                                 ELSE '##' || substr(w.word, w.pos + 1, b.e - w.pos) END)
  FROM walk w JOIN best b ON b.word = w.word AND b.s = w.pos),
done AS (SELECT word, pieces FROM walk WHERE pos = length(word)),
wp AS (SELECT dw.word, coalesce(done.pieces, ['[UNK]']) AS pieces FROM dw LEFT JOIN done ON done.word = dw.word),
toks AS (SELECT pre.doc_id, flatten(list(wp.pieces ORDER BY pre.pos)) AS t FROM pre JOIN wp ON wp.word = pre.word
         GROUP BY pre.doc_id),
dt AS (SELECT d.doc_id, coalesce(toks.t, CAST([] AS VARCHAR[])) AS t FROM documents d LEFT JOIN toks ON toks.doc_id = d.doc_id)
"""


def _wp(spark, sf_dir, uncased: bool = False):
    docs = documents(spark, sf_dir)
    v = wpc.wordpiece_vocab_from_corpus(docs, min_freq=WP_MIN_FREQ, uncased=uncased)
    return wpc.wordpiece_tokenize(docs, v, keep=[], uncased=uncased), v


@register("wordpiece_vocab", f"SELECT * FROM {WP_VOCAB_SQL}")
def q_wordpiece_vocab(spark, sf_dir):
    """A WordPiece vocabulary derived from the corpus (pieces of any length)."""
    return wpc.wordpiece_vocab_from_corpus(documents(spark, sf_dir), min_freq=WP_MIN_FREQ)


@register("wordpiece_tokens", WP_TOKENS_SQL + f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, {S.join_list('t')} AS tokens FROM dt
""")
def q_wordpiece_tokens(spark, sf_dir):
    t, _ = _wp(spark, sf_dir)
    return t.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), joined("tokens").alias("tokens"))


@register("wordpiece_uncased", WP_TOKENS_SQL.replace(S.pretokenize_sql("text"), S.pretokenize_sql("text", True)) + f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, {S.join_list('t')} AS tokens FROM dt
""")
def q_wordpiece_uncased(spark, sf_dir):
    """WordPiece on lower-cased text without accents, with a vocabulary of the same."""
    t, _ = _wp(spark, sf_dir, uncased=True)
    return t.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), joined("tokens").alias("tokens"))


@register("encode_wordpiece", WP_TOKENS_SQL + """,
x AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM dt),
e AS (SELECT x.doc_id, string_agg(CAST(coalesce(v.id, 1) AS VARCHAR), ',' ORDER BY x.pos) AS ids, count(*) AS n
      FROM x LEFT JOIN v ON v.token = x.token GROUP BY x.doc_id)
SELECT dt.doc_id, CAST(coalesce(e.n, 0) AS BIGINT) AS n_tokens, coalesce(e.ids, '') AS ids
FROM dt LEFT JOIN e ON e.doc_id = dt.doc_id
""")
def q_encode_wordpiece(spark, sf_dir):
    """WordPiece ids without [CLS]/[SEP]."""
    t, v = _wp(spark, sf_dir)
    return _ids_out(en.encode(t, "tokens", v, out="ids", keep=[]))


def _cleanup_sql(expr: str) -> str:
    for a, b in wpc.CLEANUP_REPLACEMENTS:
        expr = f"replace({expr}, {S.q(a)}, {S.q(b)})"
    return expr


@register("decode_wordpiece", WP_TOKENS_SQL + f""",
x AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM dt),
j AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS s FROM x
      WHERE token NOT IN {_specials_in(wpc.WP_SPECIALS)} GROUP BY doc_id)
SELECT dt.doc_id, trim({_cleanup_sql("replace(coalesce(j.s, ''), ' ##', '')")}) AS decoded
FROM dt LEFT JOIN j ON j.doc_id = dt.doc_id
""")
def q_decode_wordpiece(spark, sf_dir):
    """ids -> text: specials skipped, ## pieces glued, spaces cleaned up."""
    t, v = _wp(spark, sf_dir)
    e = en.encode(t, "tokens", v, out="ids", keep=[])
    d = en.decode_tokens(e, "ids", v, out="pieces", skip=wpc.WP_SPECIALS, unknown_dropped=True, keep=[])
    return d.select("doc_id", wpc.decode_wordpiece("pieces").alias("decoded"))


# ---------------------------------------------------------------------------
# S1-S8 sources, K3/K4 sinks: write the documents out, read them back
# ---------------------------------------------------------------------------

from lingotile.session import scratch_path  # noqa: E402
from lingotile.sources import readers as rd  # noqa: E402
from lingotile.sources import sinks as sk  # noqa: E402

LINES_SQL = f"""
SELECT line AS text FROM (
  SELECT regexp_replace(unnest(string_split(coalesce(text, ''), chr(10))), {S.q(tx.STRIP_RE)}, '', 'g') AS line,
         lang FROM documents) WHERE line <> ''
"""
LINES_BY_LANG_SQL = f"""
SELECT lang, line AS text FROM (
  SELECT regexp_replace(unnest(string_split(coalesce(text, ''), chr(10))), {S.q(tx.STRIP_RE)}, '', 'g') AS line,
         lang FROM documents) WHERE line <> ''
"""


def _write_lines(spark, sf_dir, by_lang: bool = False) -> str:
    path = scratch_path(spark, "lines")
    docs = table(spark, sf_dir, "documents").select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"), "lang")
    if by_lang:
        docs.write.partitionBy("lang").text(path)
    else:
        docs.select("text").write.text(path)
    return path


@register("src_lines", LINES_SQL)
def q_src_lines(spark, sf_dir):
    """Documents written as text files and read back as stripped non-blank lines."""
    return rd.read_lines(spark, _write_lines(spark, sf_dir)).select("text")


@register("src_lines_lenient", LINES_SQL)
def q_src_lines_lenient(spark, sf_dir):
    """Lenient reader: a missing file contributes no rows."""
    path = _write_lines(spark, sf_dir)
    got = rd.read_lines(spark, path, missing="empty")
    none = rd.read_lines(spark, path + "-missing", missing="empty")
    return got.unionByName(none).select("text")


def _lang_paths(path: str, langs) -> dict[str, str]:
    return {lg: f"{path}/lang={lg}" for lg in langs}


@register("read_corpus", LINES_BY_LANG_SQL)
def q_read_corpus(spark, sf_dir):
    """One text file set per language, read in language order."""
    path = _write_lines(spark, sf_dir, by_lang=True)
    return rd.read_corpus(spark, _lang_paths(path, LANG4)).select("lang", "text")


@register("read_labelled_txt", f"""
SELECT lang, {LABEL_SQL} AS label, text FROM ({LINES_BY_LANG_SQL})
""")
def q_read_labelled_txt(spark, sf_dir):
    """Labelled TXT loader: the files of all languages."""
    path = _write_lines(spark, sf_dir, by_lang=True)
    return rd.read_labelled_txt(spark, files=_lang_paths(path, LANG4), language_map=LANG4).select("lang", "label", "text")


@register("load_auto", f"""
SELECT lang, {LABEL_SQL} AS label, text FROM ({LINES_BY_LANG_SQL})
""")
def q_load_auto(spark, sf_dir):
    """Source fallback chain: the CSV path does not exist, so TXT files are used."""
    path = _write_lines(spark, sf_dir, by_lang=True)
    df, _ = rd.load_auto(spark, csv_path=path + "-no-such.csv", txt_files=_lang_paths(path, LANG4),
                         language_map=LANG4)
    return df.select("lang", "label", "text")


def _write_csv(spark, sf_dir, label_col: bool) -> str:
    path = scratch_path(spark, "csv")
    docs = table(spark, sf_dir, "documents")
    if label_col:
        out = sp.encode_label(docs, LANG4, out="lang_id").select("text", "lang_id")
    else:
        out = docs.select("text", F.initcap("lang").alias("language"))
    (out.write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@register("src_csv_language", f"SELECT coalesce(text, '') AS text, {LABEL_SQL} AS label FROM documents")
def q_src_csv_language(spark, sf_dir):
    """CSV with a mixed-case language column (quoted newlines and quotes)."""
    path = _write_csv(spark, sf_dir, label_col=False)
    return rd.read_labelled_csv(spark, path, language_map=LANG4).select("text", "label")


@register("src_csv_label", f"SELECT coalesce(text, '') AS text, {LABEL_SQL} AS label FROM documents")
def q_src_csv_label(spark, sf_dir):
    """CSV with a numeric label column (language column ignored)."""
    path = _write_csv(spark, sf_dir, label_col=True)
    return rd.read_labelled_csv(spark, path, label_col="lang_id").select("text", "label")


@register("vocab_written", _vocab_oracle(_exploded_sql(S.words_sql("text")), tx.SPECIALS_WORD))
def q_vocab_written(spark, sf_dir):
    """Vocabulary written as parquet and read back."""
    docs = documents(spark, sf_dir)
    path = scratch_path(spark, "vocab")
    sk.write_vocab(vb.build_vocab(vb.token_rows(docs, tx.words("text"))), path)
    return sk.read_vocab(spark, path)


# ---------------------------------------------------------------------------
# M9-M16: classifier training, evaluation, jobs (rows-only checks)
# ---------------------------------------------------------------------------

from lingotile.operators import classifier as clf  # noqa: E402
from lingotile.plans import jobs  # noqa: E402

# The registered queries train the reference's network (64-wide embeddings, two
# hidden layers of 128) with a larger step and fewer rounds.
QUERY_TRAIN_CFG = dict(epochs=4, lr=5e-3, language_map=LANG4)


def _train_cfg(**over) -> clf.TrainConfig:
    return clf.TrainConfig(**{**QUERY_TRAIN_CFG, **over})


def _train_corpus(spark, sf_dir) -> DataFrame:
    return labelled_docs(spark, sf_dir).select("doc_id", "doc_ord", "lang", "label", "text")


def _train(spark, sf_dir, wordpiece_vocab=None, **over):
    cfg = _train_cfg(**over)
    return jobs.run_training(spark, cfg, corpus=_train_corpus(spark, sf_dir), wordpiece_vocab=wordpiece_vocab), cfg


@register("language_classifier")
def q_language_classifier(spark, sf_dir):
    """Fit on the stratified training part; predictions for the validation part."""
    res, cfg = _train(spark, sf_dir)
    val = res["split"].where(F.col("split") == "val")
    return clf.predict_language(res["model"], val, cfg.language_map).select(
        "doc_id", "label", "pred", "predicted_language")


@register("language_classifier_rows", f"""
SELECT doc_id, label, true AS scored, true AS proba_sums_to_one FROM ({STRAT_SQL}) WHERE split = 'val'
""")
def q_language_classifier_rows(spark, sf_dir):
    """Which rows the classifier scores: those of the validation part, each
    with a label of the map and probabilities that sum to one."""
    res, cfg = _train(spark, sf_dir, epochs=1)
    val = res["split"].where(F.col("split") == "val")
    out = clf.predict_language(res["model"], val, cfg.language_map)
    total = F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", "label", F.col("predicted_language").isin(*cfg.language_map).alias("scored"),
                      (F.abs(total - 1) < 1e-9).alias("proba_sums_to_one"))


@register("language_classifier_flatten")
def q_language_classifier_flatten(spark, sf_dir):
    """The same job on flattened (position-aware) embeddings."""
    res, cfg = _train(spark, sf_dir, mode="flatten", embedding_dim=16)
    val = res["split"].where(F.col("split") == "val")
    return clf.predict_language(res["model"], val, cfg.language_map).select(
        "doc_id", "label", "pred", "predicted_language")


@register("language_classifier_chars")
def q_language_classifier_chars(spark, sf_dir):
    """The same job on characters."""
    res, cfg = _train(spark, sf_dir, tokenizer="char", max_length=300)
    val = res["split"].where(F.col("split") == "val")
    return clf.predict_language(res["model"], val, cfg.language_map).select(
        "doc_id", "label", "pred", "predicted_language")


@register("classifier_features", f"""
SELECT doc_id, CAST(label AS INTEGER) AS label, CAST(least(len(t), 100) AS BIGINT) AS n_tokens,
       CAST(least(len(t), 100) AS BIGINT) AS n_features
FROM (SELECT doc_id, {LABEL_SQL} AS label, {S.edgegrams_sql('text', 3)} AS t FROM documents)
""")
def q_classifier_features(spark, sf_dir):
    """Features of every document: as many slots as tokens, none left out."""
    cfg = _train_cfg()
    docs, stage = _train_corpus(spark, sf_dir), clf.tokens_stage(cfg)
    tokens = stage.transform(docs).select("doc_id", F.size(F.slice("_tokens", 1, cfg.max_length)).cast("bigint").alias("n_tokens"))
    made = clf.features(docs, stage, cfg)
    real = F.size(F.filter("ids", lambda i: (i >= 1) & (i <= cfg.slots))).cast("bigint")
    return made.join(tokens, "doc_id").select("doc_id", "label", "n_tokens", real.alias("n_features"))


@register("training_history")
def q_training_history(spark, sf_dir):
    """Per-round train/validation loss and accuracy."""
    res, _ = _train(spark, sf_dir)
    return res["history"]


@register("training_resumed", "SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS epoch, true AS same_history")
def q_training_resumed(spark, sf_dir):
    """A run stopped after two rounds and taken up again against one that was
    not: the same history."""
    root = scratch_path(spark, "resumed")
    _train_rounds(spark, sf_dir, f"{root}/a", 2)
    again = _train_rounds(spark, sf_dir, f"{root}/a", 3)
    whole = _train_rounds(spark, sf_dir, f"{root}/b", 3).select("epoch", *[F.col(c).alias(f"_{c}") for c in HISTORY])
    near = [F.abs(F.col(c) - F.col(f"_{c}")) < 1e-6 for c in HISTORY]
    return again.join(whole, "epoch", "full").select("epoch", F.coalesce(near[0] & near[1] & near[2] & near[3], F.lit(False)).alias("same_history"))


HISTORY = ("train_loss", "val_loss", "train_accuracy", "val_accuracy")


def _train_rounds(spark, sf_dir, rounds_dir: str, epochs: int) -> DataFrame:
    cfg = _train_cfg(epochs=epochs)
    return jobs.run_training(spark, cfg, corpus=_train_corpus(spark, sf_dir), rounds_dir=rounds_dir)["history"]


@register("model_restored", f"""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_same FROM ({STRAT_SQL}) WHERE split = 'val'
""")
def q_model_restored(spark, sf_dir):
    """A saved model, loaded again, scores every validation row as before."""
    res, cfg = _train(spark, sf_dir, epochs=1)
    path = scratch_path(spark, "model")
    clf.save_model(res["model"], path)
    val = res["split"].where(F.col("split") == "val").select("doc_id", "text", "lang")
    score = lambda m, name: clf.predict_language(m, val, cfg.language_map).select("doc_id", F.col("proba").alias(name))
    both = score(res["model"], "a").join(score(clf.load_model(path), "b"), "doc_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("a") == F.col("b")).cast("bigint")), F.lit(0)).alias("n_same"))


INFO_SQL = f"""
WITH v AS ({_vocab_oracle(_exploded_sql(S.edgegrams_sql("text", 3)), tx.SPECIALS_SHORT)}),
s AS (SELECT split, count(*) AS n FROM ({STRAT_SQL}) GROUP BY 1)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM v) AS vocab_size, 100::BIGINT AS max_length, 16::BIGINT AS batch_size,
       0.8::DOUBLE AS train_ratio, true AS shuffle, true AS stratify_split,
       '{{"es": 0, "en": 1, "fr": 2, "de": 3}}' AS language_map,
       (SELECT CAST(n AS BIGINT) FROM s WHERE split = 'train') AS train_samples,
       (SELECT CAST(n AS BIGINT) FROM s WHERE split = 'val') AS val_samples, true AS vocab_built, 42::BIGINT AS seed
"""


@register("pipeline_info", INFO_SQL)
def q_pipeline_info(spark, sf_dir):
    """What the training job knows before it trains."""
    ready = jobs.prepare_training(_train_corpus(spark, sf_dir), _train_cfg())
    return jobs.info_frame(spark, ready["pipeline_info"])


@register("pipeline_info_unshuffled", f"""
WITH d AS (SELECT doc_id, {LORD_SQL} AS doc_ord, text FROM documents),
r AS (SELECT *, row_number() OVER (ORDER BY doc_ord) - 1 AS rk, floor(count(*) OVER () * 0.8) AS cut FROM d),
t AS (SELECT unnest({S.edgegrams_sql("text", 3)}) AS g FROM r WHERE rk < cut)
SELECT (SELECT CAST(2 + count(DISTINCT g) AS BIGINT) FROM t WHERE g NOT IN {_specials_in(tx.SPECIALS_SHORT)}) AS vocab_size, false AS shuffle,
       (SELECT CAST(count(*) AS BIGINT) FROM r WHERE rk < cut) AS train_samples,
       (SELECT CAST(count(*) AS BIGINT) FROM r WHERE rk >= cut) AS val_samples
""")
def q_pipeline_info_unshuffled(spark, sf_dir):
    """A cut in corpus order, and the vocabulary of the training part alone."""
    ready = jobs.prepare_training(_train_corpus(spark, sf_dir), _train_cfg(shuffle=False, vocab_scope="train"))
    return jobs.info_frame(spark, ready["pipeline_info"]).select("vocab_size", "shuffle", "train_samples", "val_samples")


@register("run_summary_written", f"""
SELECT CAST(n.vocab_size AS BIGINT) AS vocab_size, n.train_samples, n.val_samples, 2::BIGINT AS rounds, n.val_samples AS total_samples,
       4::BIGINT AS languages FROM ({INFO_SQL}) n
""")
def q_run_summary_written(spark, sf_dir):
    """The training job's JSON summary, written and read back."""
    root = scratch_path(spark, "artifacts")
    jobs.run_training(spark, _train_cfg(epochs=2), corpus=_train_corpus(spark, sf_dir), artifacts_dir=root)
    j = spark.read.json(f"{root}/training_summary")
    info = lambda c: F.col(f"pipeline_info.{c}").cast("bigint").alias(c)
    return j.select(info("vocab_size"), info("train_samples"), info("val_samples"),
                    F.size("training_history.val_losses").cast("bigint").alias("rounds"),
                    F.col("evaluation.total_samples").alias("total_samples"),
                    F.size(F.from_json(F.to_json("evaluation.per_class_accuracy"), "map<string,double>")).cast("bigint").alias("languages"))


@register("summary_written", _summary_oracle(
    "SELECT lang, text FROM documents", "lang", _summary_specs_sql(), {"char": CHAR_VOCAB_SIZE}))
def q_summary_written(spark, sf_dir):
    """The tokenizer summary as a table, written (by language) and read back."""
    path = scratch_path(spark, "summary")
    made = summarize_tokenizers(documents(spark, sf_dir), SUMMARY_SPECS, vocab_sizes={"char": CHAR_VOCAB_SIZE}, round_digits=None)
    sk.write_table(made, path, partition_by=["language"])
    return spark.read.schema(made.schema).parquet(path).select(*made.columns)


@register("evaluation_summary")
def q_evaluation_summary(spark, sf_dir):
    """Overall accuracy, per-language accuracy map, total validation samples."""
    res, _ = _train(spark, sf_dir)
    return res["evaluation"]


@register("run_comparison")
def q_run_comparison(spark, sf_dir):
    """The comparison job over the whole documents table (summary output)."""
    docs = documents(spark, sf_dir)
    out = jobs.run_comparison(spark, docs, languages=LANGS_SORTED,
                              wordpiece_vocab=wpc.wordpiece_vocab_from_corpus(docs, min_freq=WP_MIN_FREQ))
    return out["summary"]


# ---------------------------------------------------------------------------
# Streaming: documents read as a file stream
# ---------------------------------------------------------------------------

from lingotile.streaming import stream as st  # noqa: E402


@register("stream_encode_chars", _encode_oracle(S.chars_sql("text"), CHAR_VOCAB_SQL))
def q_stream_encode_chars(spark, sf_dir):
    """Character encoding of a documents stream, per micro-batch."""
    stream = st.read_table_stream(spark, sf_dir, "documents.parquet").select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = scratch_path(spark, "stream-enc")
    q = st.encode_batches(stream, lambda b: tx.chars("text"), vb.char_vocab(spark), out,
                          scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return _ids_out(spark.read.parquet(out))


@register("stream_vocab_growth", _vocab_oracle(_exploded_sql(S.edgegrams_sql("text", 3)), tx.SPECIALS_SHORT))
def q_stream_vocab_growth(spark, sf_dir):
    """Growing edgegram vocabulary maintained over a documents stream."""
    stream = st.read_table_stream(spark, sf_dir, "documents.parquet").select(
        F.col("doc_id").alias("doc_ord"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    root = scratch_path(spark, "stream-vocab")
    q = st.grow_vocab_batches(stream, lambda b: tx.edgegrams("text", 3), root,
                              scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return st.vocab_from_versions(spark, root)


@register("stream_vocab_arrivals", _vocab_oracle(_exploded_sql(S.words_sql("text")), tx.SPECIALS_SHORT))
def q_stream_vocab_arrivals(spark, sf_dir):
    """Word vocabulary of a folder that files arrive in: the documents come
    in ten ranges of their id, the stream is stopped and taken up again after
    each, and the log of its batches is merged on the way."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cuts = docs.approxQuantile("doc_id", [k / 10 for k in range(1, 10)], 0.01)
    part = sum((F.when(F.col("doc_id") > c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    folder, root, ckpt = (scratch_path(spark, f"arrivals-{n}") for n in ("in", "vocab", "ckpt"))
    for k in range(len(set(cuts)) + 1):
        docs.where(part == k).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(docs.schema).parquet(folder).select(
            F.col("doc_id").alias("doc_ord"), F.coalesce("text", F.lit("")).alias("text"))
        st.grow_vocab_batches(stream, lambda b: tx.words("text"), root, ckpt).awaitTermination()
    return st.vocab_from_versions(spark, root)


@register("stream_predict")
def q_stream_predict(spark, sf_dir):
    """A fitted classifier scoring a documents stream (parquet sink)."""
    res, cfg = _train(spark, sf_dir)
    stream = st.read_table_stream(spark, sf_dir, "documents.parquet", max_files_per_trigger=None)   # scored row by row
    out = scratch_path(spark, "stream-pred")
    pred = st.predict_stream(res["model"], stream, cfg.language_map).select("doc_id", "lang", "pred")
    q = (pred.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(pred.schema).parquet(out)


# ---------------------------------------------------------------------------
# T6 / C3: a Python tokenizer that can fail, error capture in the summary
# ---------------------------------------------------------------------------


def ascii_words(text: str) -> list[str]:
    """Whitespace words of ASCII-only text; raises on any other text."""
    text.encode("ascii")
    return text.split()


@register("safe_tokenizer_summary", f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text,
                  regexp_matches(coalesce(text, ''), '[^\\x{{0}}-\\x{{7f}}]') AS bad FROM documents),
cut AS (SELECT lang, count(*) AS n_all, min(CASE WHEN bad THEN doc_id END) AS c FROM d GROUP BY lang),
k AS (SELECT d.lang, {S.words_sql('d.text')} AS t FROM d JOIN cut ON cut.lang = d.lang
      WHERE cut.c IS NULL OR d.doc_id < cut.c),
st AS (SELECT lang, count(*) AS n, sum(len(t)) AS s, min(len(t)) AS mn, max(len(t)) AS mx FROM k GROUP BY lang),
ob AS (SELECT lang, count(DISTINCT tok) AS o FROM (SELECT lang, unnest(t) AS tok FROM k) GROUP BY lang),
al AS (SELECT count(DISTINCT tok) AS n FROM (SELECT unnest(t) AS tok FROM k) WHERE tok NOT IN ('<pad>', '<unk>'))
SELECT cut.lang AS language, 'ascii_words' AS tokenizer, CAST(cut.n_all AS BIGINT) AS num_samples,
       CAST(st.s AS DOUBLE) / st.n AS avg_tokens, CAST(st.mn AS BIGINT) AS min_tokens,
       CAST(st.mx AS BIGINT) AS max_tokens, CAST(nullif(ob.o, 0) AS BIGINT) AS observed_vocab_size,
       CAST(2 + (SELECT n FROM al) AS BIGINT) AS tokenizer_vocab_size, cut.c IS NOT NULL AS has_error
FROM cut LEFT JOIN st ON st.lang = cut.lang LEFT JOIN ob ON ob.lang = cut.lang
""")
def q_safe_tokenizer_summary(spark, sf_dir):
    """A Python tokenizer that raises on non-ASCII text: per language, texts
    before the first failure are summarised and the failure is reported."""
    spec = tx.python_tokenizer_spec("ascii_words", ascii_words)
    s = summarize_tokenizers(documents(spark, sf_dir), [spec], round_digits=None)
    return s.withColumn("has_error", F.col("error").isNotNull()).drop("error")
