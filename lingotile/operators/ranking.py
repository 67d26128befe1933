"""Dense, consecutive ranks without a single-task window, and sizes of lookup tables.

``row_number() over (order by k)`` with no partition runs in one task.  The
two-level rank here gives the same numbers in parallel: rows are put in
buckets by a column that is monotone in the order (a hash prefix, or
quantile boundaries of a numeric key), each bucket is ranked on its own
(``row_number`` over ``partition by bucket``), and a tiny per-bucket count
table turned into prefix offsets is broadcast back.  The bucket table has a
fixed upper size, so the broadcast is bounded, and bucket membership
depends on row content only, so a recomputed task reproduces the same
ranks.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Aim for this many rows per bucket on the parallel path.
ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 8192


def _bytes(c: str, kind: str) -> Column:
    if kind == "string":
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if kind == "array<string>":
        return F.aggregate(F.coalesce(c, F.array().cast(kind)), F.lit(16), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16)
    return F.coalesce(F.size(c), F.lit(0)) * 8 + 16 if kind.startswith("array") else F.lit(8)


def measured(df: DataFrame, key: str) -> tuple[int, int]:
    """``(bytes, most rows of one key)`` of a lookup table."""
    size = sum((_bytes(c, kind) for c, kind in df.dtypes), F.lit(16)).cast("bigint")
    each = df.groupBy(key).agg(F.sum(size).alias("_b"), F.count(F.lit(1)).alias("_n"))
    total, most = each.agg(F.sum("_b"), F.max("_n")).first()
    return int(total or 0), int(most or 0)


def broadcast_limit(df: DataFrame) -> int:
    """Bytes up to which the session broadcasts a side of a join."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def quantile_buckets(df: DataFrame, key: str, n_buckets: int,
                     out: str = "_bucket") -> DataFrame:
    """Adds ``out``: the index of the approximate ``n_buckets``-quantile range
    that numeric column ``key`` falls in (monotone in ``key``)."""
    if n_buckets <= 1:
        return df.withColumn(out, F.lit(0.0))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.approxQuantile(key, probs, 1.0 / (4 * n_buckets))
    if not qs:   # no key at all
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf")] + sorted(set(float(q) for q in qs)) + [float("inf")]
    tmp = f"{out}_key"
    keyed = df.withColumn(tmp, F.col(key).cast("double"))
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return b.transform(keyed).drop(tmp)


def global_rank(df: DataFrame, order_cols: list[str], out: str = "rank", start: int = 0,
                bucket: Column | None = None, n_rows: int | None = None) -> DataFrame:
    """Adds ``out`` = start + 0-based position of each row in ``order_cols``
    order.  ``order_cols`` must be unique per row.  ``bucket`` (optional)
    must be non-decreasing in that order; otherwise quantile buckets over
    the first order column (numeric) are used.  ``df`` should be
    materialised by the caller: it is read more than once."""
    order = [F.col(c) for c in order_cols]
    if bucket is not None:
        b = df.withColumn("_bucket", bucket)
    else:
        total = df.count() if n_rows is None else n_rows
        n_buckets = max(2, min(MAX_BUCKETS, total // ROWS_PER_BUCKET + 1))
        b = quantile_buckets(df, order_cols[0], n_buckets)
    return rank_in_buckets(b, order, "_bucket", out, start).drop("_bucket")


def rank_in_buckets(df: DataFrame, order: list[Column], bucket_col: str, out: str,
                    start: int = 0, partition_cols: list[str] | None = None) -> DataFrame:
    """Two-level rank; ``partition_cols`` ranks independently per group (like
    ``partition by``) while still spreading each group over buckets."""
    parts = list(partition_cols or [])
    counts = df.groupBy(*parts, bucket_col).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*parts).orderBy(bucket_col).rowsBetween(
        Window.unboundedPreceding, -1)
    names = [*parts, bucket_col]
    offsets = counts.select(*[F.col(c).alias(f"_o_{c}") for c in names],
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    w_local = Window.partitionBy(*parts, bucket_col).orderBy(*order)
    local = df.withColumn("_local", F.row_number().over(w_local))
    # counts has at most |groups| x |buckets| rows: a bounded broadcast.
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in names]   # a null group is a group
    joined = local.join(F.broadcast(offsets), same, "inner")
    return joined.withColumn(out, (F.col("_off") + F.col("_local") - 1 + start).cast("bigint")) \
        .drop("_off", "_local", *[f"_o_{c}" for c in names])


def md5_order_key(seed: int | str, id_col: str) -> Column:
    """Seeded pseudo-random order key, identical in Spark and DuckDB."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def md5_bucket(key: Column, hex_digits: int = 3) -> Column:
    """Bucket = leading hex digits of an md5 key: monotone in the key."""
    return F.conv(F.substring(key, 1, hex_digits), 16, 10).cast("int")
