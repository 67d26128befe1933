"""Train/validation splits, label maps and mini-batch assignment.

Shuffles are seeded hash orders (``md5(seed|id)``), identical in any engine
and independent of partitioning.  Ranks never use a one-task window: rows
are spread over md5-prefix buckets (4096 by default) and ranked per bucket
with prefix offsets (see ``ranking``), so a label holding a third of all rows
is still ranked by thousands of tasks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingotile.operators.ranking import global_rank, md5_bucket, md5_order_key, rank_in_buckets

# The default language map of the classifier.
DEFAULT_LANGUAGE_MAP = {"es": 0, "en": 1, "fr": 2}


def encode_label(df: DataFrame, language_map: dict[str, int] | None = None,
                 lang_col: str = "lang", out: str = "label", strict: bool = True) -> DataFrame:
    """Language code -> integer label.  ``strict`` raises on a language
    outside the map (as the reference does); otherwise such rows get null."""
    m = language_map or DEFAULT_LANGUAGE_MAP
    mapping = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(int(v)))])
    label = F.element_at(mapping, F.col(lang_col)) if m else F.lit(None).cast("int")
    if strict:
        label = F.when(F.col(lang_col).isin(*m.keys()), label).otherwise(
            F.raise_error(F.concat(F.lit("no label is mapped to language '"), F.coalesce(F.col(lang_col), F.lit("")),
                                   F.lit(f"'; mapped are {', '.join(m)}"))))
    return df.withColumn(out, label.cast("int"))


def decode_label(df: DataFrame, language_map: dict[str, int] | None = None,
                 label_col: str = "label", out: str = "language") -> DataFrame:
    """Integer label -> language code; unknown ids are shown as the number."""
    m = language_map or DEFAULT_LANGUAGE_MAP
    inverse = F.create_map(*[x for k, v in m.items() for x in (F.lit(int(v)), F.lit(k))])
    return df.withColumn(out, F.coalesce(F.element_at(inverse, F.col(label_col)),
                                         F.col(label_col).cast("string")))


def with_default_label(df: DataFrame, out: str = "label") -> DataFrame:
    """No labels given: every row gets 0."""
    return df.withColumn(out, F.lit(0))


def alternate_label(df: DataFrame, order_col: str = "doc_ord", group_col: str | None = None,
                    out: str = "label") -> DataFrame:
    """Demo labels: 1, 0, 1, 0, ... by position (within ``group_col``)."""
    ranked = _rank(df, order_col, "_alt_rank", group_col)
    return ranked.withColumn(out, F.when(F.col("_alt_rank") % 2 == 0, 1).otherwise(0)).drop("_alt_rank")


def _rank(df: DataFrame, order_col: str, out: str, group_col: str | None) -> DataFrame:
    """0-based rank by a numeric order column, optionally per group; parallel."""
    if group_col is None:
        return global_rank(df, [order_col], out=out)
    from lingotile.operators.ranking import quantile_buckets
    b = quantile_buckets(df, order_col, _n_buckets(df))
    return rank_in_buckets(b, [F.col(order_col)], "_bucket", out, 0, [group_col]).drop("_bucket")


def _n_buckets(df: DataFrame) -> int:
    n = df.count()
    return max(2, min(8192, n // 250_000 + 2))


def quotas(counts: DataFrame, ratio: float, label_col: str = "label") -> DataFrame:
    """Exact per-class train quotas: ``n_train = floor(N*ratio)``; each class
    gets ``floor(n_c*ratio)`` and the remaining ``n_train - sum`` seats go to
    the largest fractional parts (ties: lower label).  Decimal arithmetic."""
    r = F.lit(Decimal(str(ratio))).cast("decimal(20,10)")
    tot = Window.partitionBy()
    c = counts.withColumn("_exact", F.col("n").cast("decimal(30,10)") * r)
    c = c.withColumn("_base", F.floor("_exact").cast("bigint"))
    c = c.withColumn("_frac", F.col("_exact") - F.col("_base"))
    c = c.withColumn("_n_train", F.floor(F.sum("n").over(tot).cast("decimal(30,10)") * r).cast("bigint"))
    c = c.withColumn("_left", F.col("_n_train") - F.sum("_base").over(tot))
    c = c.withColumn("_order", F.row_number().over(Window.orderBy(F.col("_frac").desc(), F.col(label_col))))
    return c.select(label_col, "n", (F.col("_base") + F.when(F.col("_order") <= F.col("_left"), 1)
                                     .otherwise(0)).cast("bigint").alias("quota"))


def stratified_split(df: DataFrame, ratio: float = 0.8, seed: int = 42, id_col: str = "doc_id",
                     label_col: str = "label", out: str = "split",
                     hex_digits: int = 3) -> DataFrame:
    """Per label, the first ``quota(label)`` rows in ``md5(seed|id), id``
    order go to ``train``, the rest to ``val``.  ``0 < ratio < 1``."""
    if not 0 < ratio < 1:
        raise ValueError(f"a split needs a ratio inside (0, 1), not {ratio}")
    keys = df.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"))
    keys = keys.withColumn("_key", md5_order_key(seed, "_id"))
    keys = keys.withColumn("_bucket", md5_bucket(F.col("_key"), hex_digits))
    counts = keys.groupBy("label", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    q = quotas(counts.groupBy("label").agg(F.sum("n").alias("n")), ratio).select(
        F.col("label").alias("_label"), "quota")   # one row per label
    last = _last_taken(keys, counts, q)
    taken = (F.col("_key") < F.col("_last_key")) | (
        (F.col("_key") == F.col("_last_key")) & (F.col(id_col) <= F.col("_last_id")))
    return (df.withColumn("_key", md5_order_key(seed, id_col))
            .join(F.broadcast(last), F.col(label_col).eqNullSafe(F.col("_label")), "left")
            .withColumn(out, F.when(taken, "train").otherwise("val"))
            .drop("_key", "_label", "_last_key", "_last_id"))


def _last_taken(keys: DataFrame, counts: DataFrame, q: DataFrame) -> DataFrame:
    """``(_label, _last_key, _last_id)``: the last row each label's quota
    takes (none for a quota of 0).  Only the keys of the bucket that the quota
    ends in are sorted; all other rows are told apart by this row alone, so
    the table that is split is not shuffled."""
    before = Window.partitionBy("label").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = counts.select(F.col("label").alias("_l"), F.col("_bucket").alias("_b"), "n",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    ends = ends.join(F.broadcast(q), F.col("_l").eqNullSafe(F.col("_label"))).where(
        (F.col("_off") < F.col("quota")) & (F.col("quota") <= F.col("_off") + F.col("n"))).select(
        "_label", "_b", (F.col("quota") - F.col("_off")).alias("_take"))
    inside = keys.join(F.broadcast(ends), F.col("label").eqNullSafe(F.col("_label"))
                       & (F.col("_bucket") == F.col("_b")))
    w = Window.partitionBy("_label").orderBy("_key", "_id")
    return inside.withColumn("_pos", F.row_number().over(w)).where(F.col("_pos") == F.col("_take")).select(
        "_label", F.col("_key").alias("_last_key"), F.col("_id").alias("_last_id"))


def random_split(df: DataFrame, ratio: float = 0.8, seed: int = 42, id_col: str = "doc_id",
                 out: str = "split", clamp: bool = False, shuffle: bool = True,
                 order_col: str = "doc_ord", hex_digits: int = 3) -> DataFrame:
    """Unstratified split: the first ``floor(N*ratio)`` rows of the seeded
    order are ``train``.  ``clamp`` keeps both sides non-empty when N > 1
    (N = 1 -> one train row).  ``shuffle=False`` cuts in corpus order."""
    if not 0 < ratio < 1:
        raise ValueError(f"a split needs a ratio inside (0, 1), not {ratio}")
    n = df.count()
    cut = int(Decimal(n) * Decimal(str(ratio)))
    if clamp:
        cut = max(1, min(cut, n - 1)) if n > 1 else 1
    if shuffle:
        keyed = df.withColumn("_key", md5_order_key(seed, id_col))
        ranked = global_rank(keyed, ["_key", id_col], out="_rank",
                             bucket=md5_bucket(F.col("_key"), hex_digits), n_rows=n)
    else:
        keyed = df.withColumn("_key", F.lit(None))
        ranked = global_rank(keyed, [order_col], out="_rank", n_rows=n)
    return (ranked.withColumn(out, F.when(F.col("_rank") < cut, "train").otherwise("val"))
            .drop("_key", "_rank"))


def can_stratify(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: label count, smallest class, N, and whether a stratified
    split is possible (> 1 label, every label >= 2 rows, N > 1)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_labels"),
        F.min("n").cast("bigint").alias("min_count"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
    ).withColumn("can_stratify", (F.col("n_labels") > 1) & (F.col("min_count") >= 2)
                 & (F.col("n_rows") > 1))


def split_distribution(split_df: DataFrame, language_map: dict[str, int] | None = None,
                       label_col: str = "label", split_col: str = "split") -> DataFrame:
    """Rows per (split, language) with labels shown by language name."""
    counts = split_df.groupBy(split_col, label_col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return decode_label(counts, language_map, label_col, "language").select(
        split_col, "language", label_col, "n")


def batch_counts(split_df: DataFrame, batch_size: int, split_col: str = "split") -> DataFrame:
    """Batches per split: ``ceil(n / min(batch_size, n))``."""
    counts = split_df.groupBy(split_col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    bs = F.least(F.lit(batch_size).cast("bigint"), F.col("n"))
    return counts.select(split_col, "n", bs.alias("batch_size"),
                         F.ceil(F.col("n") / bs).cast("bigint").alias("n_batches"))


def assign_batches(df: DataFrame, batch_size: int, shuffle_seed: int | None = None,
                   id_col: str = "doc_id", order_col: str = "doc_ord",
                   out: str = "batch_id") -> DataFrame:
    """Consecutive mini-batches of ``batch_size`` (last one partial), in
    corpus order or, with ``shuffle_seed``, in seeded hash order."""
    if shuffle_seed is None:
        ranked = global_rank(df, [order_col], out="_rank")
    else:
        keyed = df.withColumn("_key", md5_order_key(shuffle_seed, id_col))
        ranked = global_rank(keyed, ["_key", id_col], out="_rank",
                             bucket=md5_bucket(F.col("_key"))).drop("_key")
    return ranked.withColumn(out, F.floor(F.col("_rank") / batch_size).cast("bigint")).drop("_rank")


def pad_batches(df: DataFrame, ids_col: str, batch_col: str = "batch_id", pad_id: int = 0,
                out: str | None = None) -> DataFrame:
    """Right-pad each sequence to its batch's longest (never truncates).
    A batch holds at most ``batch_size`` rows, so the window is small."""
    from lingotile.operators.encode import pad_to

    m = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    return df.withColumn(out or ids_col, pad_to(ids_col, m, pad_id))
