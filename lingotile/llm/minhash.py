"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star edges.

1. A document's set is its distinct word shingles.  Documents with equal sets
   form one class (a partial aggregation, so any number of copies is one row).
2. One hash per shingle fills ``bins`` bins; an empty bin borrows from the
   first filled bin in its own fixed random order of all bins.  Bands of
   ``rows`` bins give bucket keys; with 40 bands of 5 a pair at the limit of
   0.8 shares no bucket with probability 1.2e-7.
3. Every bucket links its members to its most central one: a star, linear in
   the bucket.  Each distinct edge is confirmed on the full sets.
4. A star misses pairs that are near each other but not near the centre.  So
   members of a bucket that the confirmed edges have not yet connected are
   compared across components: those outside the bucket's largest component
   with the members of others, unless set sizes or the triangle inequality of
   the Jaccard distance rule the pair out.  Nothing is capped.
5. Components of the confirmed edges; the smallest id names a component.

Edge cases: null, empty and blank texts have empty sets and link to nothing;
a text of fewer words than a shingle has its whole sequence as one; repeated
rows are copies; rows without an id link like others and take their
component's smallest id (null, and kept, if no row of it has one); an empty
table gives an empty result.  Set elements are 64-bit
hashes, classes 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize
from lingotile.llm.components import components
from lingotile.llm.hashing import chain, shingle_set

BANDS, ROWS = 40, 5


def donor_order(bins: int) -> np.ndarray:
    """Row i: the rank of every bin in the order in which bin i asks for a value."""
    return np.argsort(np.random.default_rng(20160).random((bins, bins)), axis=1).argsort(axis=1)


def signature(shingles: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Densified one-permutation minima of an ascending hash set."""
    k = len(order)
    bins = ((shingles >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))  # ascending, so a bin's first is its minimum
    full = bins[first]
    sig = np.zeros(k, np.uint64)
    sig[full] = shingles[first]
    if len(full) < k:
        empty = np.setdiff1d(np.arange(k), full, assume_unique=True)
        sig[empty] = sig[full[order[np.ix_(empty, full)].argmin(axis=1)]]
    return sig


def class_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signed(text: Column, width: int, bands: int, rows: int) -> Column:
    """Struct ``(n_shingles, node, buckets)``; ``buckets`` has a key for each band."""
    @F.pandas_udf("n_shingles bigint, node binary, buckets array<bigint>")
    def run(texts: pd.Series) -> pd.DataFrame:
        order, salt, out = donor_order(bands * rows), np.arange(bands, dtype=np.uint64), []
        for t in texts:
            s = shingle_set(t, width)
            if len(s):
                sig = signature(s, order).reshape(bands, rows)
                out.append((len(s), class_key(s), chain([salt, *sig.T], rows).view(np.int64)))
            else:
                out.append((0, None, None))
        return pd.DataFrame(out, columns=["n_shingles", "node", "buckets"])

    return run(text)


def full_sets(text: Column, width: int) -> Column:
    """Struct ``(node, shingles)``.  Not deterministic in name, so that the
    optimizer does not copy it into a filter on its result."""
    @F.pandas_udf("node binary, shingles array<bigint>")
    def run(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t, width) for t in texts]
        return pd.DataFrame({"node": [class_key(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    return run.asNondeterministic()(text)


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` with their Jaccard distance on the full sets and
    whether they link (100 * intersection >= percent * union)."""
    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b")), "b"))
    both = full.select("a", "b", F.size(F.array_intersect("s_a", "s_b")).cast("bigint").alias("_c"),
                       (F.size("s_a") + F.size("s_b")).cast("bigint").alias("_n"))
    return both.select("a", "b", (1 - F.col("_c") / (F.col("_n") - F.col("_c"))).alias("distance"),
                       (100 * F.col("_c") >= percent * (F.col("_n") - F.col("_c"))).alias("linked"))


def central(members: DataFrame) -> DataFrame:
    """``members(bucket, node, n)`` with each bucket's centre: the member whose
    buckets are the largest in all.  Among edited copies of one text that is
    the text nearest to most of them."""
    weight = members.groupBy("node").agg(F.sum("n").alias("w"))
    heavy = members.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("w", "node")).alias("_m")).select(
        "bucket", F.col("_m.node").alias("center"))
    return members.select("bucket", "node").join(heavy, "bucket")


def _block_links(opened: list, others: list, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between one block of a bucket's open members and one block of all
    its members; a member is ``(node, n, label, d, shingles)``."""
    n_b, d_b = (np.array([m[k] for m in others]) for k in (1, 3))
    may = []
    for _, n, label, d, _ in opened:
        ok = (np.abs(d_b - d) <= 1 - percent / 100 + 1e-9) & (
            100 * np.minimum(n_b, n) >= percent * np.maximum(n_b, n))
        may.append(ok & np.array([m[2] != label for m in others]))
    asked = np.flatnonzero(np.any(may, axis=0))
    if not len(asked):
        return []
    shingles = np.concatenate([others[j][4] for j in asked])
    starts = np.concatenate([[0], np.cumsum(n_b[asked])[:-1]])
    values, codes = np.unique(shingles, return_inverse=True)
    held, found = np.zeros(len(values), np.int32), []
    for ok, (node, n, _, _, mine) in zip(may, opened):
        if ok.any():
            at = np.searchsorted(values, mine)
            at = at[values[np.minimum(at, len(values) - 1)] == mine]
            held[at] = 1
            common = np.add.reduceat(held[codes], starts)
            held[at] = 0
            hit = ok[asked] & (100 * common >= percent * (n + n_b[asked] - common))
            found += [(node, others[asked[j]][0]) for j in np.flatnonzero(hit)]
    return found


def _links_of_blocks(percent: int):
    """mapInPandas function over rows sorted by block."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, opened, others, found = None, [], [], []
        for batch in batches:
            for bucket, block_a, block_b, open_, *member in batch.itertuples(index=False, name=None):
                if (bucket, block_a, block_b) != key:
                    if opened and others:
                        found += _block_links(opened, others, percent)
                    key, opened, others = (bucket, block_a, block_b), [], []
                (opened if open_ else others).append(member)
            yield pd.DataFrame(found, columns=["a", "b"])
            found = []
        if opened and others:
            yield pd.DataFrame(_block_links(opened, others, percent), columns=["a", "b"])

    return run


OPEN_SHINGLES, BLOCK_SHINGLES = 50_000, 200_000


def residual_links(members: DataFrame, stars: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Distinct links within buckets that the stars did not find.  In each
    bucket the members outside its largest component meet the members of all
    other components, in blocks of bounded size, unless set sizes or the
    distances to the bucket's centre (a metric) rule a link out.  Pairs with
    the centre are known already, so buckets of two are done."""
    far = stars.select(F.col("a").alias("center"), F.col("b").alias("node"), "distance")
    sizes = sets.select("node", F.size("shingles").cast("bigint").alias("n"))
    known = members.where("node != center").join(labels, "node", "left").join(far, ["center", "node"]).join(
        sizes, "node").select("bucket", "node", "n", F.coalesce("label", "node").alias("label"),
                              F.col("distance").alias("d"))
    known = materialize(known, "members")
    parts = known.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("k", "label", "s")).alias("main"), F.sum("s").alias("s"),
                                        F.count(F.lit(1)).alias("parts")).where("parts > 1")
    blocks = lambda total, size: F.ceil(total / size).cast("bigint")
    mixed = mixed.select("bucket", F.col("main.label").alias("main"),
                         blocks(F.col("s") - F.col("main.s"), OPEN_SHINGLES).alias("na"),
                         blocks(F.col("s"), BLOCK_SHINGLES).alias("nb"))
    full = known.join(mixed, "bucket").join(sets, "node")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    keys, carried = ["bucket", "block_a", "block_b"], ["node", "n", "label", "d", "shingles"]
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    opened = full.where(F.col("label") != F.col("main")).withColumn("block_a", mine("na")).withColumn("block_b", every("nb"))
    others = full.withColumn("block_b", mine("nb")).withColumn("block_a", every("na"))
    rows = opened.select(*keys, F.lit(True).alias("open"), *carried).union(
        others.select(*keys, F.lit(False), *carried))
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        _links_of_blocks(percent), "a binary, b binary").distinct()


def _grouped(texts: DataFrame, width: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """For ``texts(doc_id, text)``: its rows as ``(doc_id, digest, n_shingles,
    node)``, and the linked classes as ``(node, component)``, the component
    named by its first row ``(none, doc_id, digest)``.  A row is told by its
    id and its text's digest, so rows without an id are found again too."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    sigs = materialize(texts.select("doc_id", digest.alias("digest"), signed(F.col("text"), width, bands, rows).alias(
        "_s")).select("doc_id", "digest", "_s.*"), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    classes = materialize(sigs.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(row).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("buckets").alias("buckets")),
        "classes")
    keyed = classes.select("node", F.explode("buckets").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(central(materialize(keyed.join(shared, "bucket"), "buckets")), "stars")
    # Full sets of the classes that share a bucket, from one text of each.
    involved = members.select("node").distinct().join(classes, "node").select(
        F.col("node").alias("_node"), F.col("rep.doc_id").alias("_id"), F.col("rep.digest").alias("_digest"))
    found = texts.withColumn("digest", digest).join(
        involved, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    one = found.groupBy("_node").agg(F.first("text").alias("text"))  # repeated rows are one text
    sets = materialize(one.select(full_sets(F.col("text"), width).alias("_f")).select("_f.*"), "sets")
    stars = members.select(F.col("center").alias("a"), F.col("node").alias("b")).where("a != b").distinct()
    stars = materialize(compared(stars, sets, percent), "stars")
    edges = stars.where("linked").select("a", "b")
    labels = components(edges)
    more = materialize(residual_links(members, stars, sets, labels, percent), "links")
    if not more.isEmpty():
        labels = components(edges.union(more))
    named = labels.join(classes.select("node", "rep"), "node")
    firsts = named.groupBy("label").agg(F.min("rep").alias("component"))
    linked = named.join(firsts, "label").select("node", "component").union(
        classes.where("copies > 1").join(labels, "node", "left_anti").select("node", F.col("rep").alias("component")))
    return sigs.drop("buckets"), linked


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sigs, linked = _grouped(texts, width, percent, bands, rows)
    out = sigs.join(linked, "node", "left")
    component = F.coalesce("component.doc_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The documents that stay: of each component the one with the smallest id
    (without ids: the smallest text digest); rows that repeat its id and text
    are that document again and stay too."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sigs, linked = _grouped(texts, width, percent, bands, rows)
    first = F.col("component.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("component.digest") == F.col("digest"))
    stay = sigs.join(linked, "node", "left").where(F.col("component").isNull() | first).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    whole = docs.select(F.struct("*").alias("_d"))  # one column, so that no name of theirs meets one of ours
    mine = F.col("_d").getField(id_col).eqNullSafe(F.col("_id"))
    text = F.md5(F.coalesce(F.col("_d").getField(text_col), F.lit("")).cast("binary"))
    return whole.join(stay, mine & (text == F.col("_digest")), "left_semi").select("_d.*")
