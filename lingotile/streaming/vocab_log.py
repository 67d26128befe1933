"""A growing vocabulary as a log of per-batch segments.

Each micro-batch adds one segment, so what it writes follows its own tokens
and not the vocabulary:

``<root>/<first batch>-<last batch>-<first id>-<next id>/``
    ``new/``   the tokens first seen in these batches, ``id`` in
               ``[first id, next id)``, with their count in these batches;
    ``seen/``  ``(id, n)``: further occurrences of tokens of older segments;
    ``_DONE``  empty marker, made last.  A folder without it does not exist.

``FAN`` adjoining segments of equal length are merged into one, and those
again, like the carries of a counter: a row is rewritten once per power of
``FAN`` batches, and a reader opens a number of segments that grows with the
logarithm of the batches.  Which merges are due follows from the batch id
alone, so a batch that is tried again writes what is missing and nothing
twice.  A segment is removed when a merge that holds it is older than the
batch being written; a reader must not outlast two batches.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingotile.operators import vocab as vb

FAN = 8
SEEN_SCHEMA = "id bigint, n bigint"


class Segment(NamedTuple):
    first: int     # batches first..last
    last: int
    low: int       # ids low..high - 1 are its own
    high: int
    path: str


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _segments(spark: SparkSession, root: str) -> list[Segment]:
    """All finished segments, merged ones and their parts."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName().split("-")
        if len(name) == 4 and all(n.isdigit() for n in name):
            path = f"{root.rstrip('/')}/{s.getPath().getName()}"
            if fs.exists(_fs(spark, f"{path}/_DONE")[1]):
                found.append(Segment(*map(int, name), path))
    return found


def live_segments(spark: SparkSession, root: str) -> list[Segment]:
    """The segments that hold the log, in batch order: from each batch on the
    longest one."""
    longest: dict[int, Segment] = {}
    for s in _segments(spark, root):
        if s.first not in longest or longest[s.first].last < s.last:
            longest[s.first] = s
    live, at = [], 0
    while at in longest:
        live.append(longest[at])
        at = longest[at].last + 1
    return live


def _new(spark: SparkSession, segments: list[Segment]) -> DataFrame:
    return spark.read.schema(vb.VOCAB_SCHEMA).parquet(*[f"{s.path}/new" for s in segments])


def _seen(spark: SparkSession, segments: list[Segment]) -> DataFrame:
    return spark.read.schema(SEEN_SCHEMA).parquet(*[f"{s.path}/seen" for s in segments])


def _counted(new: DataFrame, seen: DataFrame) -> DataFrame:
    """``new`` with the counts of ``seen`` added; specials have no count."""
    more = seen.select("id", F.lit(None).cast("string").alias("token"), F.col("n").alias("freq"),
                       F.lit(False).alias("is_special"))
    return new.unionByName(more).groupBy("id").agg(
        F.max("token").alias("token"), F.sum("freq").alias("freq"), F.max("is_special").alias("is_special"))


def read(spark: SparkSession, root: str) -> DataFrame:
    """The vocabulary of all finished batches; ``freq`` counts all of them."""
    live = live_segments(spark, root)
    if not live:
        raise FileNotFoundError(f"no vocabulary below {root}")
    new = _new(spark, live)
    return new if len(live) == 1 else _counted(new, _seen(spark, live)).select(*vb.VOCAB_SCHEMA.names)


def _write(spark: SparkSession, root: str, span: tuple[int, int, int, int], new: DataFrame, seen: DataFrame) -> None:
    path = f"{root.rstrip('/')}/{'-'.join(map(str, span))}"
    new.select(*vb.VOCAB_SCHEMA.names).write.mode("overwrite").parquet(f"{path}/new")
    seen.select("id", "n").write.mode("overwrite").parquet(f"{path}/seen")
    fs, marker = _fs(spark, f"{path}/_DONE")
    fs.create(marker, True).close()


def add_batch(tokens: DataFrame, root: str, batch_id: int, specials: list[str]) -> None:
    """Write batch ``batch_id`` of ``tokens(doc_ord, pos, token)``: unseen
    tokens get the next ids in the order they first occur.  Does nothing for a
    batch already written; batches come in order, from 0."""
    spark = tokens.sparkSession
    live = live_segments(spark, root)
    done = live[-1].last if live else -1
    if batch_id > done + 1:
        raise ValueError(f"batch {batch_id} follows batch {done}: the log below {root} is of another stream")
    if batch_id == done + 1:
        found = vb.materialize(vb._first_occurrence(tokens.where(F.col("token").isNotNull())))
        if live:
            # The scan of the vocabulary keeps what the batch holds; the smaller side is broadcast if it fits.
            known = _new(spark, live).select("token", F.col("id").alias("_id"), "is_special")
            hits = known.join(found.select("token"), "token")
            found = vb.materialize(found.join(hits, "token", "left"))
            low, head = live[-1].high, None
        else:
            known = vb.specials_frame(spark, specials).select("token", F.col("id").alias("_id"), "is_special")
            found = found.join(F.broadcast(known), "token", "left")   # a few specials
            low, head = 0, vb.specials_frame(spark, specials)
        start = low + (len(specials) if head is not None else 0)
        fresh = vb._rank_tokens(found.where(F.col("_id").isNull()).drop("_id", "is_special"), start)
        fresh = vb.materialize(fresh)
        again = found.where(F.col("_id").isNotNull() & ~F.col("is_special")).select(
            F.col("_id").alias("id"), F.col("freq").alias("n"))
        high = start + fresh.count()
        _write(spark, root, (batch_id, batch_id, low, high), fresh if head is None else head.unionByName(fresh), again)
    _merge_due(spark, root, batch_id)
    _remove_merged(spark, root, batch_id)


def _merge_due(spark: SparkSession, root: str, batch_id: int) -> None:
    width = FAN
    while (batch_id + 1) % width == 0:
        first = batch_id + 1 - width
        live = live_segments(spark, root)
        parts = [s for s in live if first <= s.first and s.last <= batch_id]
        if len(parts) > 1:
            low, high = parts[0].low, parts[-1].high
            seen = _seen(spark, parts)
            new = _counted(_new(spark, parts), seen.where(F.col("id") >= low))
            older = seen.where(F.col("id") < low).groupBy("id").agg(F.sum("n").alias("n"))
            _write(spark, root, (first, batch_id, low, high), new, older)
        width *= FAN


def _remove_merged(spark: SparkSession, root: str, batch_id: int) -> None:
    found = _segments(spark, root)
    for s in found:
        if any(m.first <= s.first and s.last <= m.last < batch_id and m[:2] != s[:2] for m in found):
            fs, p = _fs(spark, s.path)
            fs.delete(p, True)
