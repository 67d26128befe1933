import pytest
from pyspark.sql import functions as F

from fixtures import SPANISH_BATCH, sample_corpus_df, texts_df
from lingotile.functions import text as tx
from lingotile.operators import encode as en
from lingotile.operators import split as sp
from lingotile.operators import vocab as vb


def _ids(df, col="ids"):
    return [list(r[col]) for r in df.orderBy("doc_id").collect()]


def test_char_encode_custom_alphabet(spark):
    d = texts_df(spark, ["abc", "abcd", "abc123", ""])
    v = vb.char_vocab(spark, "abc")
    assert _ids(en.encode(d, tx.chars("text"), v)) == [[2, 3, 4], [2, 3, 4, 1], [2, 3, 4, 1, 1, 1], []]


def test_char_roundtrip_and_unknown(spark):
    d = texts_df(spark, ["Hola, ¿qué tal?", "你好"])
    v = vb.char_vocab(spark)
    out = en.decode(en.encode(d, tx.chars("text"), v), "ids", v, sep="")
    assert [r.decoded for r in out.orderBy("doc_id").collect()] == ["Hola, ¿qué tal?", "<unk><unk>"]


def test_decode_padding_bad_ids_and_specials(spark):
    v = vb.word_vocab(texts_df(spark, ["hello world"]), lowercase=False)
    df = spark.createDataFrame([(0, [2, 4, 5, 3, 0, 0, 0]), (1, [4, 9999]), (2, [])],
                               "doc_id bigint, ids array<bigint>")
    got = [r.decoded for r in en.decode(df, "ids", v, sep=" ").orderBy("doc_id").collect()]
    assert got == ["<bos> hello world <eos>", "hello <unk>", ""]
    toks = en.decode_tokens(df, "ids", v).orderBy("doc_id").collect()
    assert list(toks[0].tokens) == ["<bos>", "hello", "world", "<eos>", "<pad>", "<pad>", "<pad>"]


def test_word_encode_lower_vocab_asymmetry(spark):
    c = sample_corpus_df(spark)
    lower = vb.word_vocab(c, lowercase=True)
    es1 = c.where(F.col("doc_id") == 0)
    assert _ids(en.encode(es1, tx.words("text"), lower)) == [[1, 5, 6, 7, 8, 9, 4, 10, 11, 12, 13, 14]]


def test_spanish_batch_golden(spark):
    c = sample_corpus_df(spark)
    v = vb.build_vocab(vb.token_rows(c, tx.words("text")))
    es = c.where(F.col("lang") == "es")
    b = sp.assign_batches(es, 4)
    e = en.encode(b, tx.words("text"), v).withColumn("ids", en.add_bos_eos("ids"))
    p = sp.pad_batches(e, "ids")
    assert _ids(p) == SPANISH_BATCH


def test_fixed_length_and_pad(spark):
    df = spark.createDataFrame([(0, [5, 6, 7]), (1, list(range(10, 20)))], "doc_id bigint, ids array<bigint>")
    got = _ids(df.withColumn("f", en.pad_or_truncate("ids", 5)), "f")
    assert got == [[5, 6, 7, 0, 0], [10, 11, 12, 13, 14]]
    got = _ids(df.withColumn("f", en.pad_to("ids", 4)), "f")
    assert got == [[5, 6, 7, 0], list(range(10, 20))]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_equals_broadcast(spark, no_broadcast):
    from lingotile.plans.common import documents

    docs = documents(spark, "/root/testdata/sf0.01")
    v = vb.build_vocab(vb.token_rows(docs, tx.words("text")), min_freq=2)
    salted = _ids(en.encode(docs, tx.words("text"), v))
    back = en.decode(en.encode(docs, tx.words("text"), v, keep=[]), "ids", v, keep=[])
    decoded = [r.decoded for r in back.orderBy("doc_id").collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    assert salted == _ids(en.encode(docs, tx.words("text"), v))
    again = en.decode(en.encode(docs, tx.words("text"), v, keep=[]), "ids", v, keep=[])
    assert decoded == [r.decoded for r in again.orderBy("doc_id").collect()]


def test_one_token_in_half_of_all_rows_is_spread(spark, no_broadcast):
    """The token is not in the vocabulary, so no count there tells that it is hot."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.explode(F.concat(
            F.array_repeat(F.lit("hot"), 5), F.transform(F.sequence(F.lit(1), F.lit(5)), lambda k: F.concat(F.lit("w"), (F.col("id") * 7 + k) % 5000)))).alias("token"))
        v = spark.range(5000).select(F.concat(F.lit("w"), "id").alias("token"), F.col("id"))
        looked = en.lookup(rows, "token", v, "token", "id", "_id", "doc_id")
        assert looked.where(F.col("_id").isNull()).count() == 200_000
        sizes = sorted(r["count"] for r in looked.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 400_000 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_repeated_vocabulary_keys_raise_and_nulls_are_empty(spark):
    v = spark.createDataFrame([(1, "<unk>", None, True), (2, "a", 1, False), (3, "a", 1, False)], vb.VOCAB_SCHEMA)
    df = spark.createDataFrame([(0, ["a"], [2]), (1, None, None)], "doc_id bigint, t array<string>, ids array<bigint>")
    with pytest.raises(ValueError, match="token 2 times"):  # a hidden choice otherwise
        en.encode(df, "t", v)
    chars = vb.char_vocab(spark, "ab")
    table = vb.materialize(chars)   # the same entries as a plain table: the join path
    for c in (chars, table):
        assert _ids(en.encode(df.drop("ids"), "t", c)) == [[2], []]
        assert [r.tokens for r in en.decode_tokens(df, "ids", c).orderBy("doc_id").collect()] == [["a"], []]
    far = vb.char_vocab(spark, "a\U0001F600")
    assert _ids(en.encode(spark.createDataFrame([(0, ["\U0001F600", "b"])], "doc_id bigint, t array<string>"), "t", far)) == [[3, 1]]


def test_encode_plan_single_exchange_with_broadcast(spark):
    from lingotile.plans.common import documents

    docs = documents(spark, "/root/testdata/sf0.001")
    e = en.encode(docs, tx.chars("text"), vb.char_vocab(spark))
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange hashpartitioning" not in plan   # pure projection
    v = vb.materialize(vb.build_vocab(vb.token_rows(docs, tx.words("text"))))
    w = en.encode(docs, tx.words("text"), v)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1     # docs by key only; regroup is local


def test_char_literal_path_with_multichar_tokens(spark):
    v = vb.char_vocab(spark, "abc")
    toks = spark.createDataFrame([(0, ["a", "<pad>", "zz", "c", "<unk>", "é"])], "doc_id bigint, t array<string>")
    e = en.encode(toks, "t", v)
    assert _ids(e) == [[2, 0, 1, 4, 1, 1]]
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lists_are_looked_up_in_blocks_without_token_rows(spark):
    texts = ["a b a c", "", None, "c c zz <pad>", "b", "zz", "a b c d e f g h"]
    rows = [(i, f"l{i % 2}", t) for i, t in enumerate(texts)] + [(6, "again", "h a x"), (None, "n", "a b"), (None, "m", "c")]
    d = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    v = vb.word_vocab(texts_df(spark, ["a b c d e f g h"]), lowercase=False)
    want = {r.token: r.id for r in v.collect()}
    out = {}
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            e = en.encode(d, tx.words("text"), v, keep=["lang"])
            back = en.decode_tokens(e, "ids", v, skip=["c"], unknown_dropped=True, keep=["lang"])
            assert ("MapInArrow" in _plan(e)) == (limit == "-1")
            out[limit] = [sorted((str(r.doc_id), list(r[c])) for r in x.collect()) for x, c in ((e, "ids"), (back, "tokens"))]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out["10m"] == out["-1"]
    got = dict(out["-1"][0])
    assert got["0"] == [want["a"], want["b"], want["a"], want["c"]] and got["1"] == got["2"] == [] and got["5"] == [1]
    assert len(got["6"]) == 11 and got["None"] == sorted([want["a"], want["c"]]) + [want["b"]]


def test_block_lookup_keeps_a_key_whole_across_batches(spark):
    rows = [(k // 3, [k % 5, 7]) for k in range(300)]
    d = spark.createDataFrame(rows, "doc_id bigint, ids array<bigint>")
    v = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "id bigint, token string")
    got = []
    for limit, size in (("10m", "10000"), ("-1", "7")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got.append(sorted((r.doc_id, list(r.tokens)) for r in en.decode_tokens(d, "ids", v, keep=[]).collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[0] == got[1] and len(got[0]) == 100


def test_lists_are_looked_up_without_a_row_a_token(spark):
    """A list stays one row; rows of one key, null ones too, are put together."""
    v = spark.createDataFrame([(0, "<pad>"), (1, "<unk>"), (2, "a"), (3, "b"), (None, "n")], "id bigint, token string")
    rows = [(1, ["a", "b", "z"]), (2, []), (3, None), (4, ["n", None, "b"]), (5, ["b"]), (5, ["a", "a"]), (None, ["a"]), (None, ["b", "b"])]
    df = spark.createDataFrame(rows, "doc_id bigint, t array<string>")
    e = en.encode(df, "t", v, keep=[])
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = {r.doc_id: list(r.ids) for r in e.collect()}
    assert got == {1: [2, 3, 1], 2: [], 3: [], 4: [1, 1, 3], 5: [2, 3, 2], None: [2, 3, 3]}
    back = {r.doc_id: list(r.tokens) for r in en.decode_tokens(e, "ids", v, keep=[]).collect()}
    assert back[4] == ["<unk>", "<unk>", "b"] and back[None] == ["a", "b", "b"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.doc_id: list(r.ids) for r in en.encode(df, "t", v, keep=[]).collect()} == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lists_cross_once_as_numbers_into_their_chunk(spark, monkeypatch):
    """Beyond the broadcast limit the rows are shuffled once, as codes, in chunks of any size."""
    texts = ["a b a c", "", None, "c c zz", "b", "zz", "a b c d e f g h"] * 3
    d = spark.createDataFrame([(i, f"l{i}", t, [f"x{i}"] if i % 2 else None) for i, t in enumerate(texts)],
                              "doc_id bigint, lang string, text string, tags array<string>")
    v = vb.word_vocab(texts_df(spark, ["a b c d e f g h"]), lowercase=False)
    ids = {r.token: r.id for r in v.collect()}
    want = {i: ([ids.get(w, 1) for w in (t or "").split()], f"l{i}", [f"x{i}"] if i % 2 else None) for i, t in enumerate(texts)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (1, 5):
            monkeypatch.setattr(en, "CHUNK_ELEMENTS", most)
            e = en.encode(d, tx.words("text"), v, keep=["lang", "tags"])
            plan = _plan(e)
            assert plan.count("Exchange hashpartitioning(_chunk") == 1 and "_list" not in plan
            assert {r.doc_id: (list(r.ids), r.lang, r.tags) for r in e.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
