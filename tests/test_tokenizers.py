from pyspark.sql import functions as F

from fixtures import HOSTILE, texts_df
from lingotile.functions import text as tx


def _collect(spark, texts, expr):
    df = texts_df(spark, texts).select("doc_id", expr.alias("t")).orderBy("doc_id")
    return [list(r.t) for r in df.collect()]


def test_words_chars_lower_match_python(spark):
    texts = HOSTILE + ["hello   world", "hello\nworld\t!", "hello, world!"]
    assert _collect(spark, texts, tx.words("text")) == [t.split() for t in texts]
    assert _collect(spark, texts, tx.chars("text")) == [list(t) for t in texts]
    assert _collect(spark, texts, tx.lowered_words("text")) == [t.lower().split() for t in texts]
    got = texts_df(spark, texts).select(tx.strip("text").alias("s")).orderBy("doc_id")
    assert [r.s for r in got.collect()] == [t.strip() for t in texts]


def test_words_match_python_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    rows = docs.select("text", tx.words("text").alias("w"), tx.chars("text").alias("c")).collect()
    for r in rows:
        assert list(r.w) == (r.text or "").split()
        assert list(r.c) == list(r.text or "")


def _edge(text, n=3, p=True, s=True):
    out = []
    for w in text.split():
        if len(w) < n:
            out.append(w)
            continue
        if p:
            out.append(w[:n])
        if s:
            out.append(w[-n:])
    return out


def test_edgegrams(spark):
    texts = ["hello", "the", "a b c", "¿Cómo", "", "   ", "hello world"] + HOSTILE
    assert _collect(spark, texts, tx.edgegrams("text", 3)) == [_edge(t) for t in texts]
    assert _collect(spark, texts, tx.edgegrams("text", 4, True, False)) == [_edge(t, 4, True, False) for t in texts]
    assert _collect(spark, texts, tx.edgegrams("text", 2, False, True)) == [_edge(t, 2, False, True) for t in texts]
    assert _collect(spark, ["hello world"], tx.edgegrams("text"))[0] == ["hel", "llo", "wor", "rld"]
    assert _collect(spark, ["the"], tx.edgegrams("text"))[0] == ["the", "the"]


def test_edgegram_flags_validated():
    import pytest

    with pytest.raises(ValueError):
        tx.edgegrams("text", 3, False, False)


def test_rule_tokenizer_assertions(spark):
    cases = [
        ("en", "Hello, world! How are you?", "Hello|,|world|!|How|are|you|?"),
        ("en", "I'm going to the store. She's happy.", "I|'m|going|to|the|store|.|She|'s|happy|."),
        ("en", "I was born on 05/15/1990 and I have $100.50.",
         "I|was|born|on|05/15/1990|and|I|have|$|100.50|."),
        ("en", "don't stop", "do|n't|stop"),
        ("es", "¡Hola, mundo! ¿Cómo estás?", "¡|Hola|,|mundo|!|¿|Cómo|estás|?"),
        ("fr", "J'aime apprendre l'intelligence", "J'|aime|apprendre|l'|intelligence"),
        ("fr", "allez-vous? Aujourd'hui", "allez-vous|?|Aujourd'hui"),
        ("es", "?!.,;:", "?|!|.|,|;|:"),
    ]
    df = spark.createDataFrame([(i, lg, t) for i, (lg, t, _) in enumerate(cases)], "i int, lang string, text string")
    got = df.select("i", tx.rule_tokens("text", F.col("lang")).alias("t")).orderBy("i").collect()
    for (lg, t, want), r in zip(cases, got):
        assert "|".join(r.t) == want, (lg, t, list(r.t))


def test_rule_tokenizers_match_python_regex_engine(spark):
    """The same patterns in an independent engine (Python `regex`) agree
    with Spark on every document."""
    import re

    import regex

    def conv(p):
        return regex.compile(re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: "\\U%08x" % int(m.group(1), 16), p))

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = d.select("text", *[tx.rule_tokens("text", lg).alias(lg) for lg in ("es", "en", "fr")]).collect()
    pats = {lg: conv(tx.RULE_PATTERNS[lg]) for lg in ("es", "en", "fr")}
    clitic = conv(tx.EN_CLITIC_RE)
    for r in rows:
        t = r.text or ""
        assert list(r.es) == pats["es"].findall(t)
        assert list(r.fr) == pats["fr"].findall(t)
        assert list(r.en) == pats["en"].findall(clitic.sub(r"\1 \2", t))
