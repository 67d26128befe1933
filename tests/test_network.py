"""The classifier's network: gradients, rounds, resuming, tokenizer stages."""

import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lingotile.operators import classifier as clf
from lingotile.operators import network as nw
from lingotile.operators import vocab as vb
from lingotile.operators.tokens import Tokens, named_spec
from lingotile.plans import jobs
from lingotile.sources.readers import sample_corpus


def _as_doubles(weights):
    return {k: w.astype(np.float64) for k, w in weights.items()}


@pytest.mark.parametrize("mode", ["mean", "flatten"])
def test_gradients_against_differences(mode):
    rng = np.random.default_rng(1)
    w = _as_doubles(nw.initial(20, 4, 6, 2, 3, mode, 5, 7))
    for k in ("b0", "b1", "b2"):
        w[k] += rng.normal(0, 0.1, w[k].shape)  # off the kinks that an empty text would lie on
    ids = [rng.integers(1, 21, n) for n in (5, 2, 0, 1)]
    labels = np.array([0, 2, 1, 1])
    loss, _, dense, slots, rows = nw.Network(w, mode, 5).gradients(ids, labels, 0.0, rng)
    assert list(slots) == sorted({int(i) for x in ids for i in x})
    for name, at, g in [("w0", (1, 2), dense["w0"]), ("b1", (0, 3), dense["b1"]), ("w2", (4, 1), dense["w2"]),
                        ("embedding", (int(slots[1]), 2), None)]:
        e = 1e-4
        ends = []
        for sign in (1, -1):
            moved = {k: x.copy() for k, x in w.items()}
            moved[name][at] += sign * e
            ends.append(nw.Network(moved, mode, 5).gradients(ids, labels, 0.0, rng)[0])
        want = (ends[0] - ends[1]) / (2 * e)
        got = rows[1, 2] if g is None else g[at]
        assert abs(want - got) < 5e-3 * max(1, abs(want)), name


def test_padding_adds_nothing_and_empty_texts_are_zero():
    w = nw.initial(10, 3, 4, 1, 2, "mean", 6, 1)
    x, _ = nw.Network(w, "mean", 6).inputs([np.array([3, 3, 5]), np.array([], int)])
    assert np.allclose(x[0], (2 * w["embedding"][3] + w["embedding"][5]) / 3) and not x[1].any()
    f, _ = nw.Network(nw.initial(10, 3, 4, 1, 2, "flatten", 6, 1), "flatten", 6).inputs([np.array([3, 5])])
    assert np.allclose(f[0], np.concatenate([w["embedding"][3], w["embedding"][5], np.zeros(12)]))


def _history(rows):
    return [tuple(r) for r in rows.orderBy("epoch").collect()]


def test_rounds_resume_and_do_not_depend_on_partitioning(spark):
    corpus = sample_corpus(spark, 10)
    cfg = dict(embedding_dim=8, hidden_dim=8, num_layers=2, lr=2e-2, shards=3, slots=512)
    a, b = (tempfile.mkdtemp(prefix="lingotile-rounds-") for _ in range(2))
    first = jobs.run_training(spark, clf.TrainConfig(epochs=2, **cfg), corpus=corpus, rounds_dir=a)
    resumed = jobs.run_training(spark, clf.TrainConfig(epochs=4, **cfg), corpus=corpus.repartition(11), rounds_dir=a)
    whole = jobs.run_training(spark, clf.TrainConfig(epochs=4, **cfg), corpus=corpus.coalesce(1), rounds_dir=b)
    h2, h4, hw = (_history(x["history"]) for x in (first, resumed, whole))
    assert h4[:2] == h2 and len(h4) == 4
    for x, y in zip(h4, hw):
        assert x == pytest.approx(y, abs=1e-9)
    for k, x in resumed["model"].stages[1].weights.items():
        assert np.array_equal(x, whole["model"].stages[1].weights[k])


def test_step_size_falls_on_a_plateau_and_the_best_round_stays(spark):
    corpus = sample_corpus(spark, 4)
    cfg = clf.TrainConfig(embedding_dim=4, hidden_dim=4, num_layers=1, lr=3.0, epochs=7, lr_patience=0, lr_factor=0.5,
                          early_stopping=99, slots=64)
    out = jobs.run_training(spark, cfg, corpus=corpus)
    h = _history(out["history"])
    steps, lr, best = [], 3.0, float("inf")
    for x in h:
        steps.append(lr)
        if x[2] < best:
            best = x[2]
        else:
            lr *= 0.5
    assert [x[5] for x in h] == steps and len(set(steps)) > 1
    stopped = jobs.run_training(spark, clf.TrainConfig(**{**clf.config_dict(cfg), "early_stopping": 1}), corpus=corpus)
    bad = next(k for k in range(1, len(h)) if h[k][2] >= min(x[2] for x in h[:k]))
    assert len(_history(stopped["history"])) == bad + 1


def test_every_token_is_a_feature(spark):
    docs = spark.createDataFrame([(1, "never seen before words", 0), (2, "", 1), (3, None, 1)], "doc_id bigint, text string, label int")
    cfg = clf.TrainConfig(slots=7)
    rows = {r.doc_id: r.ids for r in clf.features(docs, clf.tokens_stage(cfg), cfg).collect()}
    assert len(rows[1]) == 8 and all(1 <= i <= 7 for i in rows[1]) and rows[2] == [] and rows[3] == []


@pytest.mark.parametrize("name, options, want", [
    ("char", {}, ["a", "b", " ", "c"]), ("word", {}, ["ab", "c"]), ("edgegram", {"n": 1, "use_suffix": False}, ["a", "c"]),
    ("rule", {"lang": "en"}, ["ab", "c"]), ("wordpiece", {}, ["a", "##b", "[UNK]"])])
def test_tokenizer_stages_are_saved_with_all_they_need(spark, name, options, want):
    vocab = spark.createDataFrame([(0, "[UNK]", None, True), (1, "a", 1, False), (2, "##b", 1, False)], vb.VOCAB_SCHEMA)
    stage = Tokens(tokenizer=name, options=json.dumps(options), vocab=vocab if name == "wordpiece" else None)
    path = tempfile.mkdtemp(prefix="lingotile-stage-") + "/s"
    stage.write().save(path)
    back = Tokens.read().load(path)
    docs = spark.createDataFrame([(5, "ab c", "x")], "doc_id bigint, text string, other string")
    for s in (stage, back):
        made = s.transform(docs)
        assert made.columns == ["doc_id", "text", "other", "_tokens"] and made.first()["_tokens"] == want


def test_unknown_names_raise(spark):
    with pytest.raises(ValueError, match="no tokenizer is named"):
        named_spec("nothing")
    with pytest.raises(ValueError, match="vocabulary table"):
        named_spec("wordpiece")
    with pytest.raises(ValueError, match="the mode is one of"):
        jobs.run_training(spark, clf.TrainConfig(mode="sum"), corpus=sample_corpus(spark, 2))


def test_training_with_wordpiece_and_flatten(spark):
    from lingotile.operators.wordpiece import wordpiece_vocab_from_corpus

    corpus = sample_corpus(spark, 6)
    cfg = clf.TrainConfig(tokenizer="wordpiece", mode="flatten", max_length=12, embedding_dim=8, hidden_dim=16, num_layers=1,
                          epochs=4, lr=2e-2, dropout=0.0, slots=2048)
    pieces = vb.materialize(wordpiece_vocab_from_corpus(corpus))
    out = jobs.run_training(spark, cfg, corpus=corpus, wordpiece_vocab=pieces)
    assert out["evaluation"].first().overall_accuracy >= 0.9 and out["pipeline_info"]["vocab_size"] == pieces.count()
    path = tempfile.mkdtemp(prefix="lingotile-wp-")
    clf.save_model(out["model"], path)
    fresh = spark.createDataFrame([(1, "El gato está en la casa"), (2, "The cat is in the house")], "doc_id bigint, text string")
    got = {r.doc_id: r.predicted_language for r in clf.predict_language(clf.load_model(path), fresh).collect()}
    assert got == {1: "es", 2: "en"}


def test_baseline(spark):
    corpus = sample_corpus(spark, 3)
    model = clf.fit_baseline(corpus, clf.TrainConfig(slots=4096))
    assert clf.predict_language(model, corpus).where(F.col("pred") == F.col("label")).count() == 90


def test_scoring_holds_the_vectors_of_few_rows():
    import numpy as np
    import pandas as pd

    from lingotile.operators import network

    sizes = []

    class Net:
        def forward(self, ids):
            sizes.append(len(ids))
            return np.array([[float(x[0]), 0.0] for x in ids]), None, None

    got = network.scored(Net(), pd.Series([[k % 3] for k in range(1000)]))
    assert len(got) == 1000 and max(sizes) <= 256 and np.allclose(got[5], network.softmax(np.array([[2.0, 0.0]]))[0])
    assert network.scored(Net(), pd.Series([], dtype=object)) == []


def test_only_the_tokens_the_network_takes_are_made(spark):
    """The limited stage makes the same features and reads no text beyond them; a fitted model has it."""
    docs = spark.createDataFrame([(k, 9 - k, "uno dos tres " * k, k % 2) for k in range(5)], "doc_id bigint, doc_ord bigint, text string, label int")
    for name, options in (("edgegram", {}), ("word", {}), ("char", {}), ("rule", {"lang": "en"})):
        cfg = clf.TrainConfig(tokenizer=name, tokenizer_options=options, max_length=4, slots=64)
        short = clf.tokens_stage(cfg, limit=4)
        assert max(len(r._tokens) for r in short.transform(docs).collect()) == 4
        some, whole = clf.features(docs, short, cfg), clf.features(docs, clf.tokens_stage(cfg), cfg)
        assert sorted(some.collect()) == sorted(whole.collect())
        assert sorted(clf.features(some, short, cfg).collect()) == sorted(whole.collect())
    out = jobs.run_training(spark, clf.TrainConfig(epochs=1, slots=64, embedding_dim=4, hidden_dim=4), corpus=sample_corpus(spark, 2))
    assert out["model"].stages[0].getOrDefault("limit") == 100 and out["model"].stages[0].spec().head is not None
