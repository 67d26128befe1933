import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

FAST = ["tokenizer_summary", "word_tokens", "vocab_words", "encode_words", "collate", "stratified_split",
        "wordpiece_tokens", "mean_pool", "src_csv_language", "tokenizer_examples"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 24
    assert df.columns == ["language", "tokenizer", "num_samples", "avg_tokens", "min_tokens", "max_tokens",
                          "observed_vocab_size", "tokenizer_vocab_size", "error"]


def test_every_query_has_callable_and_oracle_names_match():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity_small(spark, name):
    r = compare(spark, name, "/root/testdata/sf0.001", duck("/root/testdata/sf0.001"))
    assert r["status"] == "ok", r


def test_package_shipped_to_workers(spark):
    from pyspark import SparkFiles

    from lingotile.session import ship_package

    ship_package(spark)
    import os

    shipped = [f for f in os.listdir(SparkFiles.getRootDirectory()) if f.startswith("lingotile-pkg")]
    assert shipped
    df = E.queries()["safe_tokenizer_summary"](spark, "/root/testdata/sf0.001")
    assert df.count() == 4
