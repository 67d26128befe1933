"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised apart, ``K`` centroids each, so a
vector's cell is a pair of centroids (K*K cells).  A query traverses the
pairs by the sum of its squared distances to both centroids, with a heap, in
two passes:

1. until the pairs hold ``first`` entries; these are reranked, which gives a
   radius (the distance of the k-th best found);
2. on, until the pairs left hold at most ``miss`` of the entries expected
   within that radius, as estimated from each centroid's mean and variance of
   squared residuals; these are reranked too.

So the share visited follows the data: small where vectors cluster, large
where they are spread evenly over a sphere (there no index can do better).
Reranking uses the original vectors in double precision.  The centroids are
fitted to at most ``SAMPLE`` rows chosen by hash; every row is indexed.

Cells of one first-half centroid form a tile; tiles and their queries meet in
blocks of bounded size, so a hot cell is many tasks, and only the ``k`` nearest
of a block leave it.  Rows that repeat an id and its vector are searched once
and counted: such copies fill as many ranks.  Of equal vectors only the
``k + 1`` smallest ids can be results, so further ones are not searched; equal
query vectors are searched once.  A search returns ``k + 1`` distinct ids, so
``k`` are left when a query's own rows, however often repeated, go.

Edge cases: vectors that are null, zero, hold null or non-finite components,
or have another length than most (ties: the longer), take no part; rows with
a null id neither; a query with fewer candidates than ``k`` returns them all;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingotile.llm.common import materialize

SAMPLE = 20_000
ROUNDS = 15
TILE_BLOCK, QUERY_BLOCK = 4096, 512
POINTS = "vec_id bigint, embedding array<double>"


@dataclass
class Index:
    """Centroids of both halves, each one's mean and variance of squared
    residuals, and the entries of every cell."""
    centroids: tuple[np.ndarray, np.ndarray]
    mean: tuple[np.ndarray, np.ndarray]
    var: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, points by centroids."""
    out = (points ** 2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids ** 2).sum(1)
    return np.maximum(out, 0)


def fit_half(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's iterations from distinct rows; an emptied centroid stays."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    c = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = squared(points, c).argmin(1)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, points)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = max(1, x.shape[1] // 2)
    return x[:, :cut], x[:, cut:]


def _quantised(centroids):
    """mapInPandas function adding each row's centroids and squared residuals."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            out = b
            for side, (part, c) in enumerate(zip(halves(np.stack(b["embedding"])), centroids)):
                d = squared(part, c)
                near = d.argmin(1)
                out = out.assign(**{f"c{side}": near, f"r{side}": d[np.arange(len(b)), near]})
            yield out

    return run


def pairs_by_sum(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Centroid pairs in ascending order of d1 + d2: a pair enters the heap
    once both its predecessors in the two sorted lists are out."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    taken = [0] * len(s1)  # of row i, how many columns are out
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap:
        s, i, j = heapq.heappop(heap)
        yield s, int(o1[i]), int(o2[j])
        taken[i] = j + 1
        if i + 1 < len(s1) and taken[i + 1] == j:
            heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
        if j + 1 < len(s2) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))


_cdf = np.vectorize(lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2))), otypes=[float])


def probe(q: np.ndarray, index: Index, first: int, radius2: float | None, miss: float) -> tuple[list[int], list[int]]:
    """Cells of the first pass and, given a radius, those of the second."""
    (d1,), (d2,) = (squared(h, c) for h, c in zip(halves(q[None]), index.centroids))
    counts, k2 = index.counts, len(d2)
    order = pairs_by_sum(d1, d2)
    cells, held = [], 0
    for _, i, j in order:
        cells.append(i * k2 + j)
        held += int(counts[i, j])
        if held >= first:
            break
    if radius2 is None:
        return cells, []
    spread = [4 * d * m / max(1, c.shape[1]) + v for d, m, v, c in
              zip((d1, d2), index.mean, index.var, index.centroids)]
    mean = (d1 + index.mean[0])[:, None] + (d2 + index.mean[1])
    sd = np.sqrt(spread[0][:, None] + spread[1] + 1e-12)
    expected = (counts * _cdf((radius2 - mean) / sd)).ravel()
    left = expected.sum() - expected[cells].sum()
    limit, more = miss * expected.sum(), []
    for _, i, j in order:
        if left <= limit:
            break
        more.append(i * k2 + j)
        left -= expected[i * k2 + j]
    return cells, more


def _probes(index: Index, first: int, second: bool, miss: float, blocks: np.ndarray):
    """mapInPandas function: (query, vector, radius) -> a row for each block of
    each first-half centroid, with the second-half centroids to look at there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k2 = index.counts.shape[1]
        for b in batches:
            rows = []
            for row in b.itertuples(index=False):
                radius2 = row.radius ** 2 * (1 + 1e-9) if second else None
                cells = np.array(probe(np.asarray(row.embedding), index, first, radius2, miss)[int(second)], np.int64)
                cells = np.sort(cells[index.counts.ravel()[cells] > 0]) if len(cells) else cells
                for tile in np.unique(cells // k2):
                    inner = cells[cells // k2 == tile] % k2
                    rows += [(row.query, tile, block, inner, row.embedding, row.radius)
                             for block in range(int(blocks[tile]))]
            yield pd.DataFrame(rows, columns=["query", "tile", "block", "inner", "embedding", "radius"])

    return run


def _nearest(k: int):
    """cogroup function of one block of a tile and one block of its queries:
    the ``k`` nearest within the query's radius, ties by id."""
    def run(key, queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(points):
            x, ids, inner = np.stack(points["embedding"]), points["vec_id"].to_numpy(), points["inner"].to_numpy()
            copies = points["copies"].to_numpy()
            for query, cells, q, radius in queries[["query", "inner", "embedding", "radius"]].itertuples(index=False):
                wanted = np.zeros(max(int(inner.max()), int(cells.max())) + 1, bool)
                wanted[cells] = True
                at = np.flatnonzero(wanted[inner])
                d = np.sqrt(((x[at] - q) ** 2).sum(1))
                at, d = at[d <= radius], d[d <= radius]
                if len(at):
                    near = d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1]
                    at, d = at[near], d[near]
                    best = np.lexsort((ids[at], d))[:k]
                    found.append(pd.DataFrame({"query": query, "vec_id": ids[at[best]], "score": d[best],
                                               "copies": copies[at[best]]}))
        return pd.concat(found) if found else pd.DataFrame({"query": [], "vec_id": [], "score": [], "copies": []})

    return run


def _rerank(probes: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """The k nearest entries found in each block for each query."""
    probes = materialize(probes.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(1 << 30))), "probes")
    load = probes.groupBy("tile").agg(F.countDistinct("query").alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / QUERY_BLOCK)).select("tile", "parts")
    asked = probes.join(load, "tile").withColumn("part", F.col("part") % F.col("parts"))
    held = entries.join(load, "tile").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    keys = ["tile", "block", "part"]
    asked, held = (x.withColumn("block", F.col("block").cast("bigint")).withColumn("part", F.col("part").cast("bigint"))
                   for x in (asked, held))
    return asked.select(*keys, "query", "inner", "embedding", "radius").groupBy(*keys).cogroup(
        held.select(*keys, "vec_id", "inner", "embedding", "copies").groupBy(*keys)).applyInPandas(
        _nearest(k), "query bigint, vec_id bigint, score double, copies bigint")


def valid_points(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, embedding) rows that take part."""
    v = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    finite: Column = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    sizes = v.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("d")).limit(1).collect()
    return v.where(F.size("embedding") == (sizes[0]["d"] if sizes else 0))


def search(vectors: DataFrame, every: int = 100, k: int = 10, centroids: int = 64, first: int = 2000,
           miss: float = 0.15, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found to each row
    whose id is divisible by ``every``, among all other rows."""
    spark = vectors.sparkSession
    points = materialize(valid_points(vectors, id_col, vec_col), "points")
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    both = tuple(fit_half(h, centroids, s) for s, h in enumerate(halves(np.stack(sample["embedding"]))))
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    searched = points.groupBy("vec_id", "embedding").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    searched = searched.withColumn("_e", F.row_number().over(equal)).where(F.col("_e") <= k + 1).drop("_e")
    coded = materialize(searched.mapInPandas(
        _quantised(both), POINTS + ", copies bigint, c0 bigint, r0 double, c1 bigint, r1 double"), "coded")
    shape = [len(c) for c in both]
    stats = []
    for side in (0, 1):
        rows = coded.groupBy(f"c{side}").agg(F.avg(f"r{side}"), F.var_pop(f"r{side}")).collect()
        mean, var = np.zeros(shape[side]), np.zeros(shape[side])
        for c, m, v in rows:  # one row for each centroid
            mean[c], var[c] = m, v
        stats.append((mean, var))
    counts = np.zeros(shape, np.int64)
    for c0, c1, n in coded.groupBy("c0", "c1").agg(F.count(F.lit(1))).collect():  # centroids squared, at most
        counts[c0, c1] = n
    index = Index(both, (stats[0][0], stats[1][0]), (stats[0][1], stats[1][1]), counts)
    blocks = np.maximum(-(-counts.sum(1) // TILE_BLOCK), 1)
    block = F.pmod(F.xxhash64("vec_id"), F.get(F.array(*[F.lit(int(b)) for b in blocks]), F.col("c0").cast("int")))
    entries = coded.select("vec_id", "embedding", "copies", F.col("c0").alias("tile"), F.col("c1").alias("inner"),
                           block.cast("bigint").alias("block"))
    # Equal query vectors share one search, named by their smallest id.
    asking = points.where(F.col("vec_id") % every == 0)
    asking = materialize(asking.groupBy("embedding").agg(F.min("vec_id").alias("query")), "queries")
    schema = "query bigint, tile bigint, block bigint, inner array<bigint>, embedding array<double>, radius double"
    near = materialize(_rerank(asking.withColumn("radius", F.lit(float("inf"))).mapInPandas(
        _probes(index, first, False, miss, blocks), schema), entries, k + 1), "near")
    place = Window.partitionBy("query").orderBy("score", "vec_id")
    kth = near.withColumn("_r", F.row_number().over(place)).where(F.col("_r") <= k + 1).groupBy("query").agg(
        F.max("score").alias("radius"))
    second = asking.join(kth, "query").select("query", "embedding", "radius").mapInPandas(
        _probes(index, first, True, miss, blocks), schema)
    found = near.unionByName(_rerank(second, entries, k + 1))
    top = found.withColumn("_r", F.row_number().over(place)).where(F.col("_r") <= k + 1).drop("_r")
    ids = points.where(F.col("vec_id") % every == 0).join(asking, "embedding").select(
        F.col("vec_id").alias("query_id"), "query").distinct()
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    top = top.join(ids, "query").where(F.col("query_id") != F.col("vec_id")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return top.withColumn(
        "rank", F.row_number().over(mine)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
