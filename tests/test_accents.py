import random
import sys
import unicodedata


from lingotile.functions import accents as ac
from lingotile.operators import vocab as vb
from lingotile.operators import wordpiece as wp
from fixtures import HOSTILE, texts_df

SYLLABLES = "가각힣한글"


def stripped(s):
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def held(spark, texts, make):
    return [r.x for r in texts_df(spark, texts).orderBy("doc_id").select(make("text").alias("x")).collect()]


def test_every_character(spark):
    """Each alone (blocks of one line), and between letters."""
    points = [chr(p) for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    texts = ["\n".join(points[k:k + 4096]) for k in range(0, len(points), 4096)]
    for text, got in zip(texts, held(spark, texts, ac.unaccented), strict=True):
        assert got == stripped(text)


def test_hostile_strings(spark):
    rng = random.Random(11)
    moved = [chr(p) for p in range(0x80, sys.maxunicode) if unicodedata.combining(chr(p))
             and unicodedata.category(chr(p)) != "Mn"]
    marks = ["́", "̣", "͏", "ͅ", "ཱ", "゙", "̈́", "ᴖ5", "\U0001d15e", "\U0001d1c0"]
    pool = [*moved, *marks, *SYLLABLES, "e", "é", "ẛ", "Å", "क़", "ো", "豈", "\n", " "]
    texts = [*HOSTILE, None, "", *("".join(rng.choice(pool) for _ in range(rng.randrange(1, 24))) for _ in range(3000))]
    for text, got in zip(texts, held(spark, texts, ac.unaccented), strict=True):
        assert got == (None if text is None else stripped(text)), ascii(text)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in docs.select("text", ac.unaccented("text").alias("u"), ac.uncased("text").alias("x")).collect():
        assert r.u == (None if r.text is None else stripped(r.text))
        assert r.x == (None if r.text is None else stripped(r.text.lower()))


def test_uncased_words(spark):
    v = spark.createDataFrame([(i, t, None, False) for i, t in enumerate(["[UNK]", "uber", "##all", "strasse", "i", "##stanbul", ";"])],
                              vb.VOCAB_SCHEMA)
    d = texts_df(spark, ["Überäll ÜBER", "İSTANBUL;", "Strasse", "", None])
    got = [list(r.tokens) for r in wp.wordpiece_tokenize(d, v, uncased=True).orderBy("doc_id").collect()]
    assert got == [["uber", "##all", "uber"], ["i", "##stanbul", ";"], ["strasse"], [], []]
    cased = [list(r.tokens) for r in wp.wordpiece_tokenize(d, v).orderBy("doc_id").collect()]
    assert cased[0] == ["[UNK]", "[UNK]"]
