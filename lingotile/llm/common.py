"""Table access, shared scratch tables and skew-proof ranks for the operators of this subpackage."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lingotile.session import checkpoint_dir, scratch_path, ship_package

# Whole texts travel to Python in Arrow batches; a small row count keeps a
# batch of very long documents within a worker's memory.
ROWS_PER_BATCH = 256


def prepare(spark: SparkSession) -> None:
    """Package on the workers, shared scratch folder known, small Arrow batches."""
    checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_scratch: list[str] = []


def _clear(spark: SparkSession, paths: list[str]) -> None:
    try:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # the session is already gone: the cluster's own clean-up applies
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet below the shared checkpoint folder and
    reads it back: later stages neither recompute it nor depend on the
    executor that made it.  The files go when the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    if not _scratch:
        atexit.register(lambda: _clear(spark, _scratch))
    _scratch.append(path)
    spark._jvm.System.gc()  # lets Spark's cleaner drop the shuffle files of finished jobs
    out = spark.read.schema(schema).parquet(path)
    out.scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes materialized tables that no later step reads: what was made
    from them has been written too, so nothing goes back to them."""
    for made in tables:
        _clear(made.sparkSession, [made.scratch_path])
        _scratch.remove(made.scratch_path)


def rank_in_group(df: DataFrame, group: list[str], part: str, order: list[str], out: str) -> DataFrame:
    """0-based gapless position of each row in its ``group``.  ``df`` is
    materialized and holds ``part``, the number of the partition that wrote
    the row: rows are ranked in (group, part), then shifted by the counts of
    the parts before.  A group of any size is thus ranked by many tasks."""
    keys = [*group, part]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_local", F.row_number().over(local) - 1)
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    return (ranked.join(shift, on, "inner").withColumn(out, (F.col("_local") + F.col("_before")).cast("bigint"))
            .drop("_local", "_before", *[f"_s_{k}" for k in keys]))
