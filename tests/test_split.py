from pyspark.sql import functions as F

from lingotile.operators import ranking
from lingotile.operators import split as sp
from lingotile.plans.common import documents


def _docs3(spark):
    d = documents(spark, "/root/testdata/sf0.01").where(F.col("lang").isin("es", "en", "fr"))
    return sp.encode_label(d)


def test_stratified_split_fixture_counts(spark):
    s = sp.stratified_split(_docs3(spark), 0.8, 42)
    got = {(r.lang, r.split): r.n for r in s.groupBy("lang", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {("en", "train"): 496, ("en", "val"): 124, ("es", "train"): 84, ("es", "val"): 22,
                   ("fr", "train"): 116, ("fr", "val"): 29}


def test_stratified_rank_equals_plain_window(spark):
    from pyspark.sql import Window

    d = _docs3(spark)
    s = sp.stratified_split(d, 0.8, 42)
    key = ranking.md5_order_key(42, "doc_id")
    w = Window.partitionBy("label").orderBy(key, "doc_id")
    q = {r.label: r.quota for r in sp.quotas(d.groupBy("label").agg(F.count("*").alias("n")), 0.8).collect()}
    plain = d.withColumn("rk", F.row_number().over(w) - 1).collect()
    want = {r.doc_id: ("train" if r.rk < q[r.label] else "val") for r in plain}
    assert {r.doc_id: r.split for r in s.collect()} == want


def test_quotas_sum_and_ratio_validation(spark):
    import pytest

    c = spark.createDataFrame([(0, 7), (1, 3), (2, 5)], "label int, n bigint")
    q = sp.quotas(c, 0.7).collect()
    assert sum(r.quota for r in q) == int(15 * 0.7)
    with pytest.raises(ValueError):
        sp.stratified_split(c, 1.0)


def test_random_split_clamp_and_global_rank(spark, monkeypatch):
    d = documents(spark, "/root/testdata/sf0.001")
    n = d.count()
    s = sp.random_split(d, 0.0005, 42, clamp=True)
    assert s.where(F.col("split") == "train").count() == 1
    s = sp.random_split(d, 0.8, 42)
    assert s.where(F.col("split") == "train").count() == int(n * 0.8)
    want = {r.doc_id: r.batch_id for r in sp.assign_batches(d, 7).collect()}
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 10)
    assert {r.doc_id: r.batch_id for r in sp.assign_batches(d, 7).collect()} == want


def test_null_labels_and_groups_keep_their_rows(spark):
    d = spark.createDataFrame([(i, i, None if i % 3 else "a") for i in range(30)],
                              "doc_id bigint, doc_ord bigint, label string")
    got = {(r["label"], r["split"]): r["count"] for r in
           sp.stratified_split(d, 0.8, 1).groupBy("label", "split").count().collect()}
    assert got == {("a", "train"): 8, ("a", "val"): 2, (None, "train"): 16, (None, "val"): 4}
    assert sp.alternate_label(d, "doc_ord", "label", "alt").count() == 30
    assert sp.assign_batches(d.limit(0), 4).count() == 0


def test_can_stratify_and_labels(spark):
    one = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id bigint, label int")
    assert sp.can_stratify(one).first().can_stratify is False
    d = spark.createDataFrame([("es",), ("fr",)], "lang string")
    assert [r.label for r in sp.encode_label(d).collect()] == [0, 2]
    back = sp.decode_label(spark.createDataFrame([(0,), (7,)], "label int"))
    assert [r.language for r in back.collect()] == ["es", "7"]
    bad = spark.createDataFrame([("xx",)], "lang string")
    import pytest

    with pytest.raises(Exception, match="no label is mapped to language"):
        sp.encode_label(bad).collect()
