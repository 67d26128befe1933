from fixtures import texts_df
from lingotile.operators import vocab as vb
from lingotile.operators import wordpiece as wp


def test_wordpiece_golden(spark):
    toks = ["[UNK]", "un", "##aff", "##able", "##a", "a", "b", "##b", "token", "##ization", "##iz"]
    v = spark.createDataFrame([(i, t, None, False) for i, t in enumerate(toks)], vb.VOCAB_SCHEMA)
    d = texts_df(spark, ["unaffable", "tokenization", "ab", "xyz", "unx", "", "ab, a"])
    got = [list(r.tokens) for r in wp.wordpiece_tokenize(d, v).orderBy("doc_id").collect()]
    assert got == [["un", "##aff", "##able"], ["token", "##ization"], ["a", "##b"], ["[UNK]"], ["[UNK]"],
                   [], ["a", "##b", "[UNK]", "a"]]


def test_pretokenize_punct_and_cjk(spark):
    d = texts_df(spark, ["你好，世界！", "Hola, ¿cómo estás?", "x​y"])
    got = [list(r.p) for r in d.select("doc_id", wp.pretokenize("text").alias("p")).orderBy("doc_id").collect()]
    assert got == [["你", "好", "，", "世", "界", "！"], ["Hola", ",", "¿", "cómo", "estás", "?"], ["xy"]]


def test_decode_wordpiece(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(["un", "##aff", "##able", "!"],), (["I", "do", "n't", "."],)], "t array<string>")
    got = [r.s for r in df.select(wp.decode_wordpiece("t").alias("s")).collect()]
    assert got == ["unaffable!", "I don't."]
    assert F is not None


def greedy(word, vocab):
    out, start = [], 0
    while start < len(word):
        end = next((e for e in range(len(word), start, -1) if ("##" if start else "") + word[start:e] in vocab), None)
        if end is None:
            return ["[UNK]"]
        out.append(("##" if start else "") + word[start:end])
        start = end
    return out if len(word) <= wp.MAX_CHARS_PER_WORD else ["[UNK]"]


def test_match_is_the_greedy_one(spark, monkeypatch):
    from lingotile.plans.common import documents
    from pyspark.sql import functions as F

    docs = documents(spark, "/root/testdata/sf0.001")
    full = vb.materialize(wp.wordpiece_vocab_from_corpus(docs))
    words = docs.select(F.explode(wp.pretokenize("text")).alias("word")).distinct().unionByName(
        spark.createDataFrame([("x" * 101,), ("e" * 100,)], "word string"))
    assert full.where(F.length(F.regexp_replace("token", "^##", "")) >= 5).count() > 100
    for v in (full, full.where(F.col("is_special") | (F.col("freq") >= 200))):
        tokens = {r.token for r in v.collect()}
        for limit in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = {r.word: list(r.pieces) for r in wp.wordpiece_table(words, v).collect()}
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            assert got == {w: greedy(w, tokens) for w in got} and len(got) > 1000
    assert any(p == ["[UNK]"] for p in got.values())


def test_frequent_pieces_are_all_found(spark):
    import random
    from collections import Counter

    rng = random.Random(3)
    rows = [("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))), rng.randrange(1, 4)) for _ in range(150)]
    rows = [(w, f) for w, f in {w: f for w, f in rows}.items()] + [("abcabcabcabcabcabcabc", 5), ("", 3), ("q" * 101, 9)]
    want = Counter()
    for w, f in rows:
        if len(w) <= 100:
            for s in range(len(w)):
                for e in range(s + 1, len(w) + 1):
                    want[("##" if s else "") + w[s:e]] += f
    for floor in (2, 5, 20):
        got = {r.piece: r.freq for r in wp.frequent_pieces(spark.createDataFrame(rows, "word string, wf bigint"), floor).collect()}
        assert got == {p: n for p, n in want.items() if n >= floor}


def test_a_place_is_one_row_and_all_pieces_are_found(spark):
    """Marks, short pieces, characters beyond the basic plane; few blocks and many."""
    tokens = ["a", "ab", "abc", "##b", "##bc", "##bcd", "#", "##", "###", "##a", "##abcd", "##d", "\U0001f600", "##\U0001f600x", "##x"]
    words = ["a", "ab", "abcd", "abcbcd", "##abcd", "###", "#a", "aab", "\U0001f600\U0001f600x", "xa", "dabcdd", "ad"]
    v = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)] + [(None, "xa"), (99, None)], "id bigint, token string")
    w = spark.createDataFrame([(x,) for x in words], "word string")
    longest = max(len(t.removeprefix("##")) for t in tokens)

    def piece(x, s, n):
        return x[s:s + n] if s == 0 else "##" + x[s:s + n]

    want = {}
    for x in words:
        for s in range(len(x)):
            fits = [n for n in range(1, min(longest, len(x) - s) + 1) if piece(x, s, n) in tokens]
            if fits:
                want[x, s] = max(fits)
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = wp._hits(w, v, longest).collect()
        finally:
            spark.conf.unset("spark.sql.shuffle.partitions")
        assert len(got) == len(want) and {(r.word, r.s): r.l for r in got} == want


def test_texts_are_split_once(spark):
    """The distinct words and the lookups read the split lists, not the texts."""
    from lingotile.plans.common import documents

    docs = documents(spark, "/root/testdata/sf0.001").where("doc_id < 20")
    v = vb.materialize(wp.wordpiece_vocab_from_corpus(docs))
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            made = wp.wordpiece_tokenize(docs, v, keep=[])
            assert "text:string" not in made._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_runs_between_ascii_whitespace_give_the_same_tokens(spark):
    """Words are cut inside distinct runs; rows of one key are still put together word by word."""
    from collections import Counter

    from pyspark.sql import functions as F

    texts = ["un\x0bable, a\x0cb", "a b　un able", None, "", " \t\r\n", "x​y\x85z unable", "unable unable,unable",
             "你好 a�b ÉTUDE", "a b " * 50]
    toks = ["[UNK]", "un", "##able", "a", "##b", "b", ",", "x", "##y", "##z", "e", "##tude"]
    v = spark.createDataFrame([(i, t, None, False) for i, t in enumerate(toks)], vb.VOCAB_SCHEMA)
    d = texts_df(spark, texts)
    for uncased in (False, True):
        words = {r.doc_id: list(r.w) for r in d.select("doc_id", wp.pretokenize("text", uncased).alias("w")).collect()}
        made = wp.wordpiece_tokenize(d, v, keep=[], uncased=uncased)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "_codes" in plan and "_words" not in plan
        assert {r.doc_id: list(r.tokens) for r in made.collect()} == {
            k: [p for w in ws for p in greedy(w, toks)] for k, ws in words.items()}
        counts = Counter(w for ws in words.values() for w in ws)
        assert {r.word: r.wf for r in wp.counted_words(d, uncased=uncased).collect()} == counts
    again = d.where("doc_id = 6").unionByName(d.where("doc_id = 6"))
    assert [list(r.tokens) for r in wp.wordpiece_tokenize(again, v, keep=[]).collect()] == [
        ["un", "##able", "un", "##able", "un", "##able", "un", "##able", ",", ",", "un", "##able", "un", "##able"]]


def test_words_of_many_pieces_are_followed_to_their_end(spark):
    words = ["ab" * n for n in range(1, 12)] + ["a", "abz", "ababababz", "zab"]
    toks = ["a", "ab", "##a", "##ab", "##b"]
    v = spark.createDataFrame([(i, t, None, False) for i, t in enumerate(toks)], vb.VOCAB_SCHEMA)
    w = spark.createDataFrame([(x,) for x in words], "word string")
    assert {r.word: list(r.pieces) for r in wp.wordpiece_table(w, v).collect()} == {x: greedy(x, toks) for x in words}
    # Places that no walk comes to are not looked up.
    assert wp._path_hits(w.where("length(word) <= 2"), v, 2).count() == 2
