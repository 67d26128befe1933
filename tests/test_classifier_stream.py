import tempfile

from pyspark.sql import functions as F

from lingotile.operators import classifier as clf
from lingotile.plans import jobs
from lingotile.sources.readers import sample_corpus


def test_training_job_on_sample_corpus(spark):
    cfg = clf.TrainConfig(embedding_dim=16, hidden_dim=16, num_layers=1, epochs=4, lr=2e-2, early_stopping=2)
    out = tempfile.mkdtemp(prefix="lingotile-art-")
    res = jobs.run_training(spark, cfg, corpus=sample_corpus(spark, 10), artifacts_dir=out)
    hist = res["history"].orderBy("epoch").collect()
    assert 1 <= len(hist) <= 4
    assert res["pipeline_info"]["train_samples"] == 240 and res["pipeline_info"]["val_samples"] == 60
    assert res["pipeline_info"]["vocab_size"] == 173
    ev = res["evaluation"].first()
    assert ev.total_samples == 60 and ev.overall_accuracy >= 0.9
    model = clf.load_model(out + "/model")
    pred = clf.predict_language(model, spark.createDataFrame([("Le chat est dans la maison",)], "text string"))
    assert pred.first().predicted_language == "fr"
    summary = spark.read.json(out + "/training_summary").first()
    assert summary.evaluation.total_samples == 60


def test_streaming_predict_and_encode(spark):
    import os

    from lingotile.functions import text as tx
    from lingotile.operators import vocab as vb
    from lingotile.streaming import stream as st

    cfg = clf.TrainConfig(embedding_dim=8, hidden_dim=8, num_layers=1, epochs=1)
    res = jobs.run_training(spark, cfg, corpus=sample_corpus(spark, 3))
    s = st.read_table_stream(spark, "/root/testdata/sf0.001", "documents.parquet")
    q = (st.predict_stream(res["model"], s).select("doc_id", "pred").writeStream.format("memory")
         .queryName("pred_stream_test").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("pred_stream_test").count() == 200
    base = tempfile.mkdtemp(prefix="lingotile-stream-")
    s2 = s.select(F.col("doc_id").alias("doc_ord"), F.coalesce("text", F.lit("")).alias("text"))
    q2 = st.grow_vocab_batches(s2, lambda b: tx.edgegrams("text"), os.path.join(base, "vocab"),
                               os.path.join(base, "ckpt"))
    q2.awaitTermination()
    grown = st.vocab_from_versions(spark, os.path.join(base, "vocab"))
    from lingotile.plans.common import documents

    batch = vb.build_vocab(vb.token_rows(documents(spark, "/root/testdata/sf0.001"), tx.edgegrams("text")),
                           specials=tx.SPECIALS_SHORT)
    assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, batch.collect()))


def test_stateless_tokenizers_on_a_stream(spark):
    from lingotile.functions import text as tx
    from lingotile.streaming import stream as st

    s = st.read_table_stream(spark, "/root/testdata/sf0.001", "documents.parquet")
    toks = st.tokens_stream(s, tx.edgegram_spec(3)).select("doc_id", F.size("tokens").alias("n"))
    q = toks.writeStream.format("memory").queryName("tok_stream_test").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.doc_id: r.n for r in spark.table("tok_stream_test").collect()}
    batch = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.size(tx.edgegrams("text")).alias("n"))
    assert got == {r.doc_id: r.n for r in batch.collect()}
