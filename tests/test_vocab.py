from pyspark.sql import functions as F

from fixtures import SAMPLE_LINES, SUMMARY_GOLDEN, sample_corpus_df
from lingotile.functions import text as tx
from lingotile.operators import compare as cmp
from lingotile.operators import ranking
from lingotile.operators import vocab as vb
from lingotile.sources.readers import sample_corpus


def _tokens(v):
    return [r.token for r in v.orderBy("id").collect()]


def test_vocab_sizes_golden(spark):
    c = sample_corpus_df(spark)
    assert vb.word_vocab(c, lowercase=True).count() == 112
    assert vb.word_vocab(c, lowercase=False).count() == 113
    assert vb.build_vocab(vb.token_rows(c, tx.words("text")), min_freq=2).count() == 17
    assert vb.build_vocab(vb.token_rows(c, tx.edgegrams("text")), specials=tx.SPECIALS_SHORT).count() == 152
    s = sample_corpus(spark, 10)
    assert vb.build_vocab(vb.token_rows(s, tx.edgegrams("text")), specials=tx.SPECIALS_SHORT).count() == 173
    assert vb.char_vocab(spark).count() == 141


def test_first_occurrence_ids_match_python(spark):
    c = sample_corpus_df(spark)
    v = vb.build_vocab(vb.token_rows(c, tx.words("text")))
    seen = list(tx.SPECIALS_WORD)
    for lang in SAMPLE_LINES:
        for line in SAMPLE_LINES[lang]:
            for w in line.split():
                if w not in seen:
                    seen.append(w)
    assert _tokens(v) == seen
    ids = [r.id for r in v.orderBy("id").collect()]
    assert ids == list(range(len(seen)))


def test_specials_and_empty_corpus(spark):
    from fixtures import texts_df

    v = vb.word_vocab(texts_df(spark, ["<pad> hello <unk> world hello"]), lowercase=False)
    assert _tokens(v) == ["<pad>", "<unk>", "<bos>", "<eos>", "hello", "world"]
    e = vb.word_vocab(texts_df(spark, ["", "  "]))
    assert _tokens(e) == tx.SPECIALS_WORD
    assert _tokens(vb.empty_vocab(spark, 2)) == ["<pad>", "<unk>"]


def test_vocab_from_list_dedup(spark):
    words = ["hello", "world", "hola", "mundo", "hello", "<pad>", "world"]
    df = spark.createDataFrame(list(enumerate(words)), "ord bigint, token string")
    assert _tokens(vb.vocab_from_list(df)) == tx.SPECIALS_WORD + ["hello", "world", "hola", "mundo"]


def test_extend_vocab_appends_in_order(spark):
    from fixtures import texts_df

    base = vb.build_vocab(vb.token_rows(texts_df(spark, ["hello world"]), tx.edgegrams("text")),
                          specials=tx.SPECIALS_SHORT)
    grown = vb.extend_vocab(base, vb.token_rows(texts_df(spark, ["hello there", "world peace"]),
                                                tx.edgegrams("text")))
    assert _tokens(grown) == ["<pad>", "<unk>", "hel", "llo", "wor", "rld", "the", "ere", "pea", "ace"]


def test_parallel_rank_path_equals_single_task(spark, monkeypatch):
    from lingotile.plans.common import documents

    docs = documents(spark, "/root/testdata/sf0.01")
    plain = vb.build_vocab(vb.token_rows(docs, tx.words("text")))
    want = [tuple(r) for r in plain.orderBy("id").collect()]
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 5000)
    par = vb.build_vocab(vb.token_rows(docs, tx.words("text")))
    assert [tuple(r) for r in par.orderBy("id").collect()] == want


def test_summary_golden(spark):
    c = sample_corpus_df(spark)
    specs = [tx.char_spec(), tx.word_spec(), tx.edgegram_spec(3)]
    s = cmp.summarize_tokenizers(c, specs, languages=["es", "en", "fr", "de"])
    rows = {(r.language, r.tokenizer): r for r in s.collect()}
    for k, (n, avg, mn, mx, obs) in SUMMARY_GOLDEN.items():
        r = rows[k]
        assert (r.num_samples, r.avg_tokens, r.min_tokens, r.max_tokens, r.observed_vocab_size) == (n, avg, mn, mx, obs)
    de = rows[("de", "char")]
    assert de.num_samples == 0 and de.avg_tokens is None and de.observed_vocab_size is None
    assert rows[("es", "edgegram")].tokenizer_vocab_size == 152
    assert [r.language for r in s.collect()][:3] == ["es", "es", "es"]


def test_python_round(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,)], "x double")
    got = [r.y for r in df.select(cmp.python_round(F.col("x"), 2).alias("y")).collect()]
    assert got == [round(0.125, 2), round(2.675, 2), round(1.005, 2)]


def test_python_tokenizer_error_capture(spark):
    from fixtures import texts_df

    def strict(t):
        if "!" in t:
            raise ValueError("bang")
        return t.split()

    rows = [(0, 0, "es", "a b c"), (1, 1, "es", "d e"), (2, 2, "es", "boom !"), (3, 3, "es", "f g h i"),
            (4, 4, "en", "! first"), (5, 5, "fr", "x y")]
    df = spark.createDataFrame(rows, "doc_id bigint, doc_ord bigint, lang string, text string")
    spec = tx.python_tokenizer_spec("strict", strict)
    s = {r.language: r for r in cmp.summarize_tokenizers(df, [spec, tx.word_spec()]).collect()
         if r.tokenizer == "strict"}
    assert (s["es"].num_samples, s["es"].avg_tokens, s["es"].min_tokens, s["es"].max_tokens) == (4, 2.5, 2, 3)
    assert s["es"].observed_vocab_size == 5 and s["es"].error == "bang"
    assert s["en"].num_samples == 1 and s["en"].avg_tokens is None and s["en"].error == "bang"
    assert s["fr"].error is None and s["fr"].avg_tokens == 2.0
    v = vb.build_vocab(vb.token_rows(df, tx.words("text")), specials=tx.SPECIALS_SHORT)
    ex = cmp.collect_examples(df, [spec], {"strict": v}, max_samples=1).collect()
    en_row = [r for r in ex if r.language == "en"][0]
    assert en_row.error == "ERROR: bang" and en_row.tokens is None
    assert texts_df is not None


def test_first_occurrence_packed_and_unpacked_agree(spark):
    rows = [(5, 3, "a"), (5, 1, "b"), (2, 9, "a"), ((1 << 43) + 1, 0, "c"), ((1 << 43), 4, "c"),
            (7, (1 << 22) + 5, "d"), (7, 2, "d"), (1 << 43, 0, "e"), (3, 0, "e")]
    df = spark.createDataFrame(rows, "doc_ord bigint, pos int, token string")
    got = {r.token: (r.first_doc, r.first_pos, r.freq) for r in vb._first_occurrence(df).collect()}
    assert got == {"a": (2, 9, 2), "b": (5, 1, 1), "c": ((1 << 43), 4, 2), "d": (7, 2, 2), "e": (3, 0, 2)}


def test_first_occurrence_hashes_and_keeps_the_order(spark):
    import random

    rng = random.Random(5)
    docs = [-(1 << 63), -7, 0, 5, 1 << 41, (1 << 42) + 1, (1 << 63) - 1]
    rows = [(rng.choice(docs), rng.choice([0, 1, 9, 1 << 21, (1 << 31) - 1]), rng.choice("abcdefgh")) for _ in range(200)]
    rows += [((1 << 63) - 1, (1 << 31) - 1, "last"), (-(1 << 63), 1 << 21, "low")]
    got = vb._first_occurrence(spark.createDataFrame(rows, "doc_ord bigint, pos int, token string"))
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.token: (r.first_doc, r.first_pos) for r in got.collect()} == {
        t: min((d, p) for d, p, x in rows if x == t) for t in {r[2] for r in rows}}


def test_tokens_without_a_place_come_in_their_own_order(spark):
    rows = [(None, k, t) for k, t in enumerate(["pear", "fig", "apple", "zest", "Bean"])] + [(3, 0, "corn")]
    d = spark.createDataFrame(rows, "doc_ord bigint, pos int, token string").repartition(5)
    got = [r.token for r in vb.build_vocab(d, specials=[]).orderBy("id").collect()]
    assert [t for t in got if t != "corn"] == ["Bean", "apple", "fig", "pear", "zest"]


def test_counted_tokens_give_the_vocabulary_of_token_rows(spark):
    """Tokens of words are counted in their task; ties, nulls and odd spaces as with a row per token."""
    rows = [(3, " El perro\u00a0come \x1cun hueso "), (1, "a ab abc\u2003\u00e1rbol 😀😀😀😀 a"), (3, "hueso El"), (None, "nuevo a"), (2, ""), (5, "  "), (1, "abc <unk> zz")]
    docs = spark.createDataFrame(rows, "doc_ord bigint, text string").coalesce(2)
    for spec in (tx.word_spec(), tx.edgegram_spec(3), tx.edgegram_spec(1), tx.edgegram_spec(4, True, False), tx.edgegram_spec(2, False, True), tx.char_spec(), tx.rule_spec("en")):
        made = vb.build_vocab(vb.counted(docs, spec, lang_col=None), specials=tx.SPECIALS_SHORT)
        want = vb.build_vocab(vb.token_rows(docs, spec.tokens("text")), specials=tx.SPECIALS_SHORT)
        assert sorted(made.collect()) == sorted(want.collect()), spec.name
    some = vb.counted(docs.where("doc_ord = 1").coalesce(1), tx.word_spec(), lang_col=None)
    assert {r.token: (r.n, r.pos) for r in some.collect()}["a"] == (2, 0)


def test_first_words_hold_the_first_tokens(spark):
    texts = ["", "   ", "\x1c a\u00a0b\x85 c", "one two three four five", " x", "a" * 3000, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for k in (1, 2, 3, 100, 501):
        for r in df.select(tx.words(tx.first_words("text", k)).alias("some"), tx.words("text").alias("whole")).collect():
            assert r.some[:k] == r.whole[:k]
    assert df.select(tx.first_words("text", 2)).collect()[3][0] == "one two "


def test_rule_tokens_are_counted_by_distinct_words(spark):
    """A row for each distinct token of a batch, with the counts and first places of a row per token."""
    texts = ["don't l'eau qu'il a-b 3,5%", "l'eau l'eau don't", None, "", "  ¡a! a a", "x\x1cy ...", "aujourd'hui qu'il"]
    rows = [(i, o, t) for i, (o, t) in enumerate(zip([5, 3, 2, 1, None, 4, 3], texts))]
    d = spark.createDataFrame(rows, "doc_id bigint, doc_ord bigint, text string").withColumn("lang", F.lit("en"))
    for spec in (tx.rule_spec("en"), tx.rule_spec("fr"), tx.rule_spec("es"), tx.word_spec()):
        made = vb.counted(d.coalesce(1), spec)
        assert made.count() == made.select("token").distinct().count()
        want = vb._first_occurrence(vb.token_rows(d, spec.tokens("text", "lang")))
        assert sorted(map(str, vb._first_occurrence(made).collect())) == sorted(map(str, want.collect()))
