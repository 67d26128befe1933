"""Physical-plan properties the design relies on."""

from pyspark.sql import functions as F

from lingotile.functions import text as tx
from lingotile.operators import compare as cmp
from lingotile.operators import ranking
from lingotile.operators import split as sp
from lingotile.plans import catalog as C
from lingotile.plans.common import documents


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_scans_corpus_once(spark):
    plan = _plan(C.QUERIES["tokenizer_summary"](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan parquet") == 1
    assert "Expand" in plan            # grouping sets: per language and all languages in one pass


def test_parallel_rank_has_no_global_window(spark, monkeypatch):
    docs = documents(spark, "/root/testdata/sf0.001")
    b = sp.assign_batches(docs, 8, shuffle_seed=42)
    plan = _plan(b)
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]   # the per-bucket offsets are the only global step
    assert "Window" in plan


def test_stratified_split_windows_by_label_and_bucket(spark):
    d = sp.encode_label(documents(spark, "/root/testdata/sf0.001"), C.LANG4).select("doc_id", "label")
    plan = _plan(sp.stratified_split(d, 0.8, 42))
    assert "hashpartitioning(label" in plan and "_bucket" in plan


def test_examples_use_group_limit(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    plan = _plan(cmp.first_k_per_group(docs, "lang", "doc_ord", 2))
    assert "WindowGroupLimit" in plan


def test_parquet_projection_is_pruned(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    plan = _plan(docs.select(F.size(tx.words("text")).alias("n")))
    assert "ReadSchema: struct<text:string>" in plan


def test_prepared_tokenizers_do_not_move_texts(spark):
    """What a tokenizer is prepared by meets keys and languages, not the texts, and gives the same summary."""
    from lingotile.operators import vocab as vb
    from lingotile.operators import wordpiece as wp

    rows = [(1, 1, "a", "un able un"), (2, 2, "b", "able"), (2, 2, "b", "un x"), (3, 3, None, ""), (None, 4, "a", "un un")]
    d = spark.createDataFrame(rows, "doc_id bigint, doc_ord bigint, lang string, text string")
    v = spark.createDataFrame([(i, t, None, False) for i, t in enumerate(["[UNK]", "un", "able"])], vb.VOCAB_SCHEMA)
    made = cmp.summarize_tokenizers(d, [tx.word_spec(), wp.wordpiece_spec(v)], round_digits=None)
    exchanges = [x for x in _plan(made).splitlines() if "Exchange" in x]
    assert exchanges and not any("text" in x for x in exchanges)
    assert {(r.language, r.tokenizer): (r.num_samples, r.avg_tokens, r.min_tokens, r.max_tokens, r.observed_vocab_size)
            for r in made.collect()} == {
        ("a", "word"): (1, 3.0, 3, 3, 2), ("b", "word"): (2, 1.5, 1, 2, 3), ("a", "wordpiece"): (1, 3.0, 3, 3, 2),
        ("b", "wordpiece"): (2, 3.0, 3, 3, 3), (None, "word"): (1, 0.0, 0, 0, None), (None, "wordpiece"): (1, 0.0, 0, 0, None)}
    # Each text's tokens are taken by batches: no row for each of them.
    assert "Generate" not in _plan(made)
