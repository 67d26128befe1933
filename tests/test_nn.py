import math

import numpy as np
from pyspark.sql import functions as F

from lingotile.operators import nn


def test_softmax_argmax_ce(spark):
    rows = [(0, [1.0, 2.0, 0.5], 1), (1, [3.0, 3.0, -1.0], 0), (2, [-5.0, 0.0, 5.0], 0)]
    df = spark.createDataFrame(rows, "id int, z array<double>, label int")
    out = df.select("id", nn.softmax("z").alias("p"), nn.argmax("z").alias("a"),
                    nn.cross_entropy("z", "label").alias("ce")).orderBy("id").collect()
    for (i, z, y), r in zip(rows, out):
        e = np.exp(np.array(z) - max(z))
        p = e / e.sum()
        assert np.allclose(r.p, p)
        assert r.a == int(np.argmax(z))
        assert math.isclose(r.ce, -math.log(p[y]), rel_tol=1e-12)


def test_mean_pool_padding_and_empty(spark):
    emb = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0])],
                                "vec_id bigint, embedding array<float>")
    df = spark.createDataFrame([(0, [1, 2, 2, 0, 0]), (1, [0, 0])], "doc_id bigint, ids array<bigint>")
    got = {r.doc_id: list(r.pooled) for r in nn.mean_pool(df, "ids", emb, 2).collect()}
    assert np.allclose(got[0], [(1 + 3 + 3) / 3, (2 + 4 + 4) / 3]) and got[1] == [0.0, 0.0]
    flat = nn.flatten_embeddings(df.where(F.col("doc_id") == 0), "ids", emb, 5, 2).first().flat
    assert list(flat) == [1.0, 2.0, 3.0, 4.0, 3.0, 4.0, 0.0, 0.0, 0.0, 0.0]
    marked = spark.createDataFrame([(0, [9.0, 9.0]), (1, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    one = spark.createDataFrame([(0, [1, 0])], "doc_id bigint, ids array<bigint>")
    assert list(nn.flatten_embeddings(one, "ids", marked, 2, 2).first().flat) == [1.0, 2.0, 0.0, 0.0]


def test_mlp_and_batch_loss(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0])], "id int, x array<double>")
    w1, w2 = [[1.0, 0.0], [0.0, 1.0]], [[1.0, 1.0], [2.0, -1.0]]
    z = df.select(nn.mlp_logits("x", [(w1, [0.0, 0.5]), (w2, [0.1, 0.0])]).alias("z")).first().z
    h = [max(1.0, 0), max(-1.0 + 0.5, 0)]
    assert np.allclose(z, [h[0] + h[1] + 0.1, 2 * h[0] - h[1]])
    b = spark.createDataFrame([(0, 1.0, 1, 1), (0, 3.0, 0, 1), (1, 10.0, 1, 1)],
                              "batch_id int, loss double, pred int, label int")
    m = nn.batch_mean_loss(b).first()
    assert m.loss == (2.0 + 10.0) / 2 and math.isclose(m.accuracy, 2 / 3)


def test_flatten_chunks_whole_text(spark):
    emb = spark.createDataFrame([(0, [9.0, 9.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0])],
                                "vec_id bigint, embedding array<float>")
    df = spark.createDataFrame([(0, [1, 2, 0, 2, 1])], "doc_id bigint, ids array<bigint>")
    got = {r.chunk: list(r.flat) for r in nn.flatten_chunks(df, "ids", emb, 2, 2).collect()}
    assert got == {0: [1.0, 2.0, 3.0, 4.0], 1: [0.0, 0.0, 3.0, 4.0], 2: [1.0, 2.0, 0.0, 0.0]}


def test_ids_outside_the_table_count_as_zero_vectors(spark):
    from lingotile.operators import nn

    emb = spark.createDataFrame([(1, [2.0, 4.0])], "vec_id bigint, embedding array<double>")
    df = spark.createDataFrame([(0, [1, 9, 0]), (1, [0, 0, 0])], "doc_id bigint, ids array<bigint>")
    got = {r.doc_id: list(r.pooled) for r in nn.mean_pool(df, "ids", emb, 2).collect()}
    assert got == {0: [1.0, 2.0], 1: [0.0, 0.0]}
    flat = {r.doc_id: list(r.flat) for r in nn.flatten_embeddings(df, "ids", emb, 3, 2).collect()}
    assert flat == {0: [2.0, 4.0, 0.0, 0.0, 0.0, 0.0], 1: [0.0] * 6}


def test_few_ids_take_few_vectors_of_a_large_table(spark):
    emb = spark.range(3000).selectExpr("id AS vec_id", "transform(sequence(0, 63), k -> CAST(id + k / 64 AS float)) AS embedding")
    df = spark.createDataFrame([(0, [1, 2, 0, 2, 1]), (1, [0]), (2, []), (3, [3, 9])], "doc_id bigint, ids array<bigint>")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")   # far below the table
    try:
        looked, flat, pooled = (nn.lookup_embeddings(df, "ids", emb), nn.flatten_chunks(df, "ids", emb, 2, 64),
                                nn.mean_pool(df, "ids", emb, 64))
        assert "SortMergeJoin" not in plan(looked) and "Exchange" not in plan(flat)
        assert {(r.doc_id, r.pos): r.vec[0] for r in looked.collect()} == {
            (k, p): float(i) for k, ids in [(0, [1, 2, 0, 2, 1]), (1, [0]), (3, [3, 9])] for p, i in enumerate(ids)}
        got = {(r.doc_id, r.chunk): (r.flat[0], r.flat[64], len(r.flat)) for r in flat.collect()}
        assert got == {(0, 0): (1.0, 2.0, 128), (0, 1): (0.0, 2.0, 128), (0, 2): (1.0, 0.0, 128), (1, 0): (0.0, 0.0, 128),
                       (3, 0): (3.0, 9.0, 128)}
        assert {r.doc_id: round(r.pooled[0], 9) for r in pooled.collect()} == {0: 1.5, 1: 0.0, 2: 0.0, 3: 6.0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_windows_are_summarised_where_they_are_made(spark):
    """Vectors need not leave their task; odd vectors take the slower way to the same figures."""
    from pyspark.sql import types as T

    rows = [(0, [1, 2, 0, 2, 1, 7, None]), (None, [2]), (2, []), (3, None), (4, [1] * 900), (4, [2, 2])]
    df = spark.createDataFrame(rows, "doc_id bigint, ids array<bigint>")
    vec = {0: [9.0, 9.0], 1: [1.0, 2.0], 2: [3.0, 4.0], 5: None}
    summary = {"n": (T.IntegerType(), lambda m: np.full(len(m), m.shape[1], np.int32), F.size),
               "total": (T.DoubleType(), lambda m: m.sum(axis=1), lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x))}
    want = {}
    for k, ids in rows:
        for c in range(0, len(ids or []), 2):
            own = [x for i in ids[c:c + 2] for x in (vec.get(i) or [0.0, 0.0]) if i != 0] + [0.0] * 2 * ids[c:c + 2].count(0)
            want.setdefault((k, c // 2), []).append(sum(own))
    for extra, fast in (([], True), ([(3, [5.0, None])], False)):
        emb = spark.createDataFrame([*vec.items(), *extra], "vec_id bigint, embedding array<double>")
        made = nn.flatten_chunks(df, "ids", emb, 2, 2, summary=summary)
        assert made.columns == ["doc_id", "chunk", "n", "total"]
        assert ("MapInArrow" in made._jdf.queryExecution().executedPlan().toString()) == fast
        got = {}
        for r in made.collect():
            assert r.n == 4
            got.setdefault((r.doc_id, r.chunk), []).append(r.total)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        flat = nn.flatten_chunks(df, "ids", emb, 2, 2).collect()
        assert sorted((str(r.doc_id), r.chunk, sum(r.flat)) for r in flat) == sorted((str(k), c, t) for (k, c), v in want.items() for t in v)
