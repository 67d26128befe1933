import pytest
from pyspark.sql import functions as F

from lingotile.functions import text as tx
from lingotile.operators import sketch as sk
from lingotile.operators.compare import summarize_tokenizers
from lingotile.plans.common import documents

SPECS = [tx.char_spec(), tx.word_spec(), tx.edgegram_spec(3)]
EXACT = ["num_samples", "avg_tokens", "min_tokens", "max_tokens"]


def by_key(df):
    return {(r.language, r.tokenizer): r.asDict() for r in df.collect()}


def test_merged_sketches_against_the_exact_summary(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    extra = spark.createDataFrame([(-1, -1, "en", "<pad> <unk> x"), (-2, -2, "xx", ""), (-3, -3, "xx", None), (-4, -4, None, "a b")],
                                  "doc_id bigint, doc_ord bigint, lang string, text string")
    cols = ["doc_id", "doc_ord", "lang", "text"]
    docs = docs.select(*cols)
    got = by_key(sk.sketched_summary(sk.merge_sketches(
        sk.sketch_tokenizers(docs, SPECS), sk.sketch_tokenizers(extra, SPECS),
        sk.sketch_tokenizers(docs.where("false"), SPECS)), SPECS, {"char": 141}))
    want = by_key(summarize_tokenizers(docs.unionByName(extra), SPECS, vocab_sizes={"char": 141}, round_digits=None))
    assert set(got) == set(want)
    for k, w in want.items():
        assert [got[k][c] for c in EXACT] == [w[c] for c in EXACT], k
        for c in ("observed_vocab_size", "tokenizer_vocab_size"):
            assert abs((got[k][c] or 0) - (w[c] or 0)) <= 5 * sk.error() * (w[c] or 0) + 1, (k, c)
    assert got["xx", "word"]["observed_vocab_size"] is None


def test_merging_again_changes_nothing(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    one = sk.sketch_tokenizers(docs, SPECS, log_k=10)
    a = by_key(sk.sketched_summary(sk.merge_sketches(one), SPECS))
    twice = by_key(sk.sketched_summary(sk.merge_sketches(one, one), SPECS))
    for k in a:
        assert twice[k]["num_samples"] == 2 * a[k]["num_samples"]
        assert twice[k]["observed_vocab_size"] == a[k]["observed_vocab_size"]


def test_failing_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        sk.sketch_tokenizers(documents(spark, "/root/testdata/sf0.001"), [tx.python_tokenizer_spec("p", str.split)])


def test_sets_of_batches_are_those_of_rows(spark):
    """Words are split once a batch and tokenised once each; what is counted and seen is as row by row."""
    from dataclasses import replace

    from lingotile.operators import tokensets as ts

    texts = ["Don't! L'été 3.14 qu'il ain't\x1cx", "  ", None, "a ab abc <unk> <pad> a b", "Don't can't 1,000 x-y d'où 😀n't", "múy n’t ’s", "a\x01b\x00c", "DIDN'T in't"]
    df = spark.createDataFrame([(k, ("en", "fr", None)[k % 3], t) for k, t in enumerate(texts * 3)], "doc_id bigint, lang string, text string").coalesce(2)
    specs = [tx.char_spec(), tx.word_spec(), tx.edgegram_spec(3), tx.edgegram_spec(2, True, False, "p"), tx.edgegram_spec(2, False, True, "s"),
             tx.rule_spec("es"), tx.rule_spec("en"), tx.rule_spec("fr"), tx.rule_spec(None)]

    def read(rows):
        got = rows.groupBy("language", "tokenizer").agg(F.sum("docs"), F.sum("sum_n"), F.min("min_n"), F.max("max_n"), F.array_sort(F.collect_set("token")))
        return {(r[0], r[1]): tuple(r)[2:] for r in got.collect()}

    made = ts.token_sets(df, specs, "text", "lang", "lang")
    plain = ts.token_sets(df, [replace(s, kind=None) for s in specs], "text", "lang", "lang")
    want = read(plain)
    assert read(made) == want and len(want) == 27
    assert made.count() < plain.count()
    flags, ts.FLAGS = ts.FLAGS, 0   # many languages: pairs by sorting
    try:
        import pyarrow as pa
        rows = [b for b in ts._batch_sets(pa.array(["a", "b", "a"]), pa.array(["x y", "y", "z x"]), [("word", ("word",))])]
        assert sorted((r["language"], r["token"]) for r in rows[1].to_pylist()) == [("a", "x"), ("a", "y"), ("a", "z"), ("b", "y")]
    finally:
        ts.FLAGS = flags
