"""Embedding features and model scoring as DataFrame expressions.

* ``mean_pool`` never materialises per-token vectors per document: ids are
  first counted per ``(doc, id)`` (partial aggregation), joined to the
  embedding table (broadcast behind a row-count check), and averaged with a
  weighted ``Summarizer.mean`` per document.
* ``flatten_chunks`` puts a window's vectors together in Arrow batches, from a
  matrix of the few vectors that ids can reach; a summary of the vectors is
  taken where they are made, so that they need not leave the task.
* Scoring with an MLP uses the weights as array literals (the weights are a
  model of bounded size, not data), evaluated with higher-order array
  functions per row: no Python, no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingotile.operators.encode import ID_RANGE, lookup
from lingotile.session import ship_package


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _vectors(df: DataFrame, ids: Column | str, emb: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, int]:
    """The embedding table as ``(_eid, _v)``, only what lies between the least
    and the greatest of ``ids``, and these two: a corpus of characters needs a
    few rows of a table of any size.  An id that the table holds twice raises."""
    side = emb.select(F.col(id_col).cast("bigint").alias("_eid"), F.col(vec_col).cast("array<double>").alias("_v"))
    most = side.groupBy("_eid").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if most > 1:
        raise ValueError(f"the lookup table holds a value of _eid {most} times")
    # An alphabet's ids are known without a look at the texts.
    known = df.__dict__.get(ID_RANGE, {}).get(ids) if isinstance(ids, str) else None
    low, high = known or df.select(_col(ids).alias("_l")).agg(F.min(F.array_min("_l")), F.max(F.array_max("_l"))).first()
    low, high = (0, -1) if low is None else (int(low), int(high))
    return side.where(F.col("_eid").between(low, high)), low, high


def _with_vectors(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """``rows`` with the vector of their ``id`` as ``_vec`` (null: not in the table)."""
    return lookup(rows, "id", side, "_eid", "_v", "_vec", key)


# Vectors of up to this many numbers are one constant, indexed by id.
LITERAL_NUMBERS = 1 << 18


def _constant(side: DataFrame, low: int, high: int, dim: int) -> Column | None:
    """The table as an array constant (place ``id - low + 1``, null where the
    table has no row), if it is small enough."""
    if high < low or (high - low + 1) * max(dim, 1) > LITERAL_NUMBERS:
        return None
    rows: list = [None] * (high - low + 1)
    for r in side.where(F.size("_v") <= dim).collect():
        rows[r["_eid"] - low] = r["_v"]
    if side.where(F.size("_v") > dim).limit(1).count():   # vectors of another width
        return None
    return F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")


WINDOWS = 128   # whose vectors are made at a time: they stay in a core's cache


def _matrix(side: DataFrame, low: int, high: int, dim: int, pad_id: int) -> np.ndarray | None:
    """The table as rows of a matrix (place ``id - low``; zero where there is no
    vector, for the padding id, and in one more row at the end), if it is small
    enough and all vectors are whole."""
    if high < low or (high - low + 1) * max(dim, 1) > LITERAL_NUMBERS:
        return None
    whole = (F.size("_v") == dim) & ~F.exists("_v", lambda x: x.isNull())
    if side.where(F.col("_v").isNotNull() & ~whole).limit(1).count():
        return None
    made = np.zeros((high - low + 2, dim))
    for r in side.where(F.col("_v").isNotNull() & (F.col("_eid") != pad_id)).collect():
        made[r["_eid"] - low] = r["_v"]
    return made


def _windows(matrix: np.ndarray, low: int, seq_len: int, summary: list | None):
    """mapInArrow function over ``(key, ids)``: windows of ``seq_len`` ids as
    vectors, or what ``summary`` makes of them.  Held are one batch of ids and
    the vectors of ``WINDOWS`` windows."""
    none = len(matrix) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            ids = pc.fill_null(lists.flatten(), low - 1).to_numpy() - low
            count = -(-size // seq_len)
            first = np.cumsum(count) - count
            row = np.repeat(np.arange(len(size)), count)
            chunk = np.arange(len(row)) - first[row]
            starts = np.cumsum(size) - size
            places = np.full(len(row) * seq_len, none, np.int64)
            places[np.repeat(first * seq_len - starts, size) + np.arange(len(ids))] = np.where((ids >= 0) & (ids < none), ids, none)
            places = places.reshape(len(row), seq_len)
            vectors = (np.take(matrix, places[a:a + WINDOWS].ravel(), axis=0).reshape(-1, seq_len * matrix.shape[1]) for a in range(0, len(row), WINDOWS))
            if summary is not None:
                made = [[f(v) for f in summary] for v in vectors]
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(row)), pa.array(chunk), *[pa.array(np.concatenate(x)) for x in zip(*made)]],
                        names=[str(i) for i in range(2 + len(summary))])
                continue
            for a, v in zip(range(0, len(row), WINDOWS), vectors):
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.reshape(-1)))
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row[a:a + WINDOWS])), pa.array(chunk[a:a + WINDOWS]), flat], names=["0", "1", "2"])

    return run


def lookup_embeddings(df: DataFrame, ids: Column | str, emb: DataFrame, key: str = "doc_id",
                      id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(key, pos, id, vec)`` for every position (null vec: id not in table)."""
    side, _, _ = _vectors(df, ids, emb, id_col, vec_col)
    rows = df.select(key, F.posexplode(_col(ids)).alias("pos", "id"))
    return _with_vectors(rows, side, key).select(key, "pos", "id", F.col("_vec").alias("vec"))


def mean_pool(df: DataFrame, ids: Column | str, emb: DataFrame, dim: int, key: str = "doc_id",
              pad_id: int = 0, out: str = "pooled", id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """Adds ``out ARRAY<DOUBLE>``: mean embedding over the non-padding ids;
    a row with only padding gets the zero vector.  Ids that the table lacks
    count as zero vectors."""
    counts = (df.select(key, F.explode(_col(ids)).alias("id"))
              .where(F.col("id") != pad_id)
              .groupBy(key, "id").agg(F.count(F.lit(1)).cast("double").alias("_w")))
    # Counts are dealt by row: the means of a row are then made in one task,
    # and neither vectors nor unfinished means (several vectors each) shuffled.
    side, _, _ = _vectors(df, ids, emb, id_col, vec_col)
    zero = F.array_repeat(F.lit(0.0), dim)
    weighted = _with_vectors(counts.repartition(key), side, key).withColumn("_vec", F.coalesce("_vec", zero))
    pooled = (weighted.groupBy(key)
              .agg(Summarizer.mean(array_to_vector("_vec"), F.col("_w")).alias("_m"))
              .select(key, vector_to_array("_m", "float64").alias("_pooled")))
    return (df.join(pooled, key, "left")
            .withColumn(out, F.coalesce(F.col("_pooled"), zero)).drop("_pooled"))


def flatten_embeddings(df: DataFrame, ids: Column | str, emb: DataFrame, seq_len: int, dim: int,
                       key: str = "doc_id", pad_id: int = 0, out: str = "flat", id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """Adds ``out``: the ``seq_len x dim`` embeddings concatenated in
    position order; padding ids map to the zero vector, a sequence of
    another length raises."""
    checked = df.withColumn("_len_ok", F.when(F.size(_col(ids)) == seq_len, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"flattening takes sequences of {seq_len} ids, this one has "),
                               F.coalesce(F.size(_col(ids)).cast("string"), F.lit("none"))))))
    rows = lookup_embeddings(checked.where(F.col("_len_ok")), ids, emb, key, id_col, vec_col)
    zero = F.array_repeat(F.lit(0.0), dim)
    packed = rows.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("id") == pad_id, zero).otherwise(
            F.coalesce("vec", zero)).alias("vec")))).alias("_s"))
    flat = packed.select(key, F.flatten(F.transform("_s", lambda s: s["vec"])).alias(out))
    return df.join(flat, key, "left")


def flatten_chunks(df: DataFrame, ids: Column | str, emb: DataFrame, seq_len: int, dim: int,
                   key: str = "doc_id", pad_id: int = 0, out: str = "flat", id_col: str = "vec_id",
                   vec_col: str = "embedding", summary: dict[str, tuple[T.DataType, Callable, Callable]] | None = None) -> DataFrame:
    """Whole-text flatten: the id sequence is cut into consecutive windows
    of ``seq_len`` (the last one padded), and each window becomes one
    ``seq_len x dim`` vector -> rows ``(key, chunk, out)``.  Padding ids map
    to the zero vector.  Each group holds at most ``seq_len`` vectors.

    ``summary`` gives columns to return instead of the vectors: ``name ->
    (type, of a matrix of some windows' vectors, the same of a Column)``."""
    zero = F.array_repeat(F.lit(0.0), dim)
    side, low, high = _vectors(df, ids, emb, id_col, vec_col)
    matrix = _matrix(side, low, high, dim, pad_id)
    if matrix is not None:
        ship_package(df.sparkSession)
        rows = df.select(key, F.coalesce(_col(ids).cast("array<bigint>"), F.array().cast("array<bigint>")).alias("_l"))
        made = {out: T.ArrayType(T.DoubleType())} if summary is None else {n: kind for n, (kind, _, _) in summary.items()}
        schema = T.StructType([rows.schema[key], T.StructField("chunk", T.LongType()), *[T.StructField(n, kind) for n, kind in made.items()]])
        named = T.StructType([T.StructField(str(i), f.dataType) for i, f in enumerate(schema.fields)])
        got = rows.mapInArrow(_windows(matrix, low, seq_len, None if summary is None else [f for _, f, _ in summary.values()]), named)
        return got.toDF(*schema.names)
    made = _flatten_rows(df, ids, side, low, high, seq_len, dim, key, pad_id, zero)
    if summary is None:
        return made.withColumnRenamed("_flat", out)
    return made.select(key, "chunk", *[f("_flat").cast(kind).alias(n) for n, (kind, _, f) in summary.items()])


def _flatten_rows(df: DataFrame, ids: Column | str, side: DataFrame, low: int, high: int, seq_len: int, dim: int, key: str,
                  pad_id: int, zero: Column) -> DataFrame:
    """``flatten_chunks`` for tables of any size and vectors of any width."""
    out = "_flat"
    known = _constant(side, low, high, dim)
    if known is not None:
        # A window's vectors are put together in its row: nothing is shuffled.
        windows = F.transform(F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / seq_len).cast("int")),
                              lambda c: F.struct(c.cast("bigint").alias("chunk"), F.slice("_l", c * seq_len + 1, seq_len).alias("own")))
        cut = df.select(key, _col(ids).alias("_l")).where(F.size("_l") > 0).select(key, F.explode(windows).alias("_w"))
        vec = lambda i: F.when(i == pad_id, zero).otherwise(
            F.coalesce(F.try_element_at(known, (i - low + 1).cast("int")), zero))
        made = cut.select(key, F.col("_w.chunk").alias("chunk"), F.flatten(F.transform("_w.own", vec)).alias("_f"))
        return made.select(key, "chunk", _filled_up("_f", seq_len * dim).alias(out))
    # Documents are hash-partitioned by key first: the (key, chunk) regroup
    # then needs no exchange, so embedding vectors are never shuffled.
    rows = df.repartition(key).select(key, F.posexplode(_col(ids)).alias("pos", "id"))
    rows = rows.select(key, F.floor(F.col("pos") / seq_len).alias("chunk"),
                       (F.col("pos") % seq_len).alias("slot"), "id")
    looked = _with_vectors(rows, side, key)
    vec = F.when(F.col("id") == pad_id, zero).otherwise(F.coalesce(F.col("_vec"), zero))
    grouped = looked.groupBy(key, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("slot", vec.alias("v")))).alias("_s"))
    made = grouped.select(key, F.col("chunk").cast("bigint").alias("chunk"), F.flatten(F.transform("_s", lambda s: s["v"])).alias("_f"))
    return made.select(key, "chunk", _filled_up("_f", seq_len * dim).alias(out))


def _filled_up(flat: str, width: int) -> Column:
    return F.concat(flat, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(flat)))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def dense_layer(x: Column, weights: list[list[float]], bias: list[float] | None = None,
                relu: bool = False) -> Column:
    """``W x + b`` (optionally ReLU) with literal weights (rows = outputs)."""
    rows = json.dumps([[*map(float, row), float(b)] for row, b in zip(weights, bias or [0.0] * len(weights))])
    matrix = F.from_json(F.lit(rows), "array<array<double>>")   # one constant, not a literal per weight
    n = len(weights[0])

    def layer(h: Column) -> Column:
        y = F.transform(matrix, lambda r: _dot(F.slice(r, 1, n), h) + F.element_at(r, n + 1))
        return F.transform(y, lambda v: F.greatest(v, F.lit(0.0))) if relu else y

    # ``x`` is bound once per row, not evaluated again for every output.
    return F.element_at(F.transform(F.array(x), layer), 1)


def mlp_logits(x: Column | str, layers: list[tuple[list[list[float]], list[float]]]) -> Column:
    """Hidden layers with ReLU, then a linear output layer -> logits."""
    h = _col(x)
    for i, (w, b) in enumerate(layers):
        h = dense_layer(h, w, b, relu=i < len(layers) - 1)
    return h


def argmax(a: Column | str) -> Column:
    """0-based index of the largest value (first one on ties)."""
    c = _col(a)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def softmax(a: Column | str) -> Column:
    c = _col(a)
    m = F.array_max(c)
    ex = F.transform(c, lambda v: F.exp(v - m))
    s = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(ex, lambda v: v / s)


def logsumexp(a: Column | str) -> Column:
    c = _col(a)
    m = F.array_max(c)
    return m + F.log(F.aggregate(F.transform(c, lambda v: F.exp(v - m)), F.lit(0.0), lambda acc, v: acc + v))


def cross_entropy(logits: Column | str, label: Column | str) -> Column:
    """``-log softmax(logits)[label]`` (label 0-based)."""
    c = _col(logits)
    return logsumexp(c) - F.element_at(c, _col(label) + 1)


def batch_mean_loss(df: DataFrame, loss_col: str = "loss", batch_col: str = "batch_id",
                    pred_col: str = "pred", label_col: str = "label") -> DataFrame:
    """Epoch metrics: loss = mean of per-batch mean losses (a partial last
    batch weighs as much as a full one); accuracy = correct / total."""
    per_batch = df.groupBy(batch_col).agg(
        F.avg(loss_col).alias("_bl"), F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col(pred_col) == F.col(label_col), 1).otherwise(0)).alias("_c"))
    return per_batch.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_batches"),
        F.avg("_bl").alias("loss"),
        (F.sum("_c") / F.sum("_n")).cast("double").alias("accuracy"))


def evaluate_predictions(df: DataFrame, language_map: dict[str, int], label_col: str = "label",
                         pred_col: str = "pred") -> DataFrame:
    """Per language of the map: samples, correct, accuracy (null when the
    class has no samples)."""
    spark = df.sparkSession
    m = spark.createDataFrame([(k, int(v)) for k, v in language_map.items()], f"language string, {label_col} int")
    per = df.groupBy(label_col).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col(pred_col) == F.col(label_col), 1).otherwise(0)).alias("_c"))
    out = m.join(per, label_col, "left")
    return out.select(
        "language", label_col,
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("total"),
        F.coalesce("_c", F.lit(0)).cast("bigint").alias("correct"),
        F.when(F.col("_n") > 0, F.col("_c") / F.col("_n")).cast("double").alias("accuracy"))


def evaluation_summary(per_class: DataFrame) -> DataFrame:
    """One row: overall accuracy, per-language accuracy map, total samples."""
    return per_class.agg(
        (F.sum("correct") / F.sum("total")).cast("double").alias("overall_accuracy"),
        F.map_from_entries(F.collect_list(F.struct("language", "accuracy"))).alias("per_class_accuracy"),
        F.sum("total").cast("bigint").alias("total_samples"))


def weights_from_table(emb: DataFrame, ids: list[int], width: int | None = None,
                       id_col: str = "vec_id", vec_col: str = "embedding") -> list[list[float]]:
    """Collect a bounded set of rows of a table as a weight matrix."""
    rows = {r[0]: r[1] for r in emb.where(F.col(id_col).isin(*ids)).select(id_col, vec_col).collect()}
    mat = [[float(v) for v in rows[i]] for i in ids]
    return [r[:width] for r in mat] if width else mat
