"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the caller owns the session; the library only reads
``spark.checkpoint.dir`` from it.  A local default is set only when the
session has none (tests, bench).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "lingotile", driver_memory: str = "8g") -> SparkSession:
    """A local[*] session configured the way tests and bench expect."""
    master = master or os.environ.get("LINGOTILE_MASTER", "local[*]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Vocabularies of some million entries are still broadcast here.
        .config("spark.sql.autoBroadcastJoinThreshold", "128m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Regroups (collect_list per document) keep hashing instead of
        # falling back to sort-based aggregation after 128 keys per task.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "65536")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses the directory the cluster configured (``spark.checkpoint.dir`` or
    an already-set SparkContext checkpoint dir).  Only when neither is set
    on a local master (tests) a private folder under the system temp dir is
    created; any other master without one is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lingotile-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


_written: list[str] = []


def _clear(spark: SparkSession) -> None:
    try:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _written:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # the session is already gone: the cluster's own clean-up applies
        pass


SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files as soon as it is done, not
    when the driver happens to collect its garbage.  The session's own setting
    is put back."""
    was = spark.conf.get(SHUFFLES_DROPPED, None)
    spark.conf.set(SHUFFLES_DROPPED, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLES_DROPPED)
        else:
            spark.conf.set(SHUFFLES_DROPPED, was)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and
    read back: no later step computes it again or depends on the executor
    that made it (a checkpoint would compute its last stage twice).  The
    files go when they are ``released`` or the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    if not _written:
        atexit.register(lambda: _clear(spark))
    _written.append(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._written_path = path
    return made


def released(*tables: DataFrame) -> None:
    """Removes the files of ``written`` tables that nothing reads any more."""
    for table in tables:
        spark, path = table.sparkSession, table._written_path
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _written.remove(path)


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``lingotile`` importable in the Python workers (needed by the
    pandas UDFs): the package is zipped once per SparkContext, written into
    the shared checkpoint folder through the Hadoop FileSystem API and
    registered with ``addPyFile``, which distributes it to every executor."""
    import io
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if getattr(sc, "_lingotile_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.join("lingotile", os.path.relpath(full, root)))
    path = scratch_path(spark, "lingotile-pkg") + ".zip"
    jvm = sc._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path)
    sc._lingotile_shipped = True
