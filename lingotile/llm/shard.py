"""Sharding by a hierarchical weighted hash tree.

A row descends from the root: at each node every child draws
``-ln(u) / weight`` with ``u`` in (0, 1) hashed from the row's key and the
child's name, and the smallest draw wins (a child wins in proportion to its
weight).  Draws depend on nothing but key, name and weight: if a subtree's
weight grows, rows move only into it; if it shrinks, only out of it; every
other subtree keeps its rows and their places below.

Growing by one shard hangs the new shard below a region of its own, the only
subtree whose weight changes, so rows move into the new shard and nowhere
else.  The placement law is ``key``: id and shard count decide.

Edge cases: a null id draws like any other key value (all such rows share a
shard); rows with equal ids share a shard; null texts have no bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize, rank_in_group


@dataclass
class Node:
    """A subtree: ``shard`` and ``own`` weight for a leaf, children otherwise."""
    name: str
    children: list["Node"] = field(default_factory=list)
    shard: int | None = None
    own: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def layout(shards: int, planned: int | None = None, region_size: int = 4, rack_size: int = 2,
           weights: dict[int, float] | None = None) -> Node:
    """Root / regions / racks / shards.  The first ``planned`` shards fill
    regions of ``region_size`` and racks of ``rack_size``; each later shard
    gets a region and rack of its own."""
    planned = shards if planned is None else min(planned, shards)
    root, weights = Node("root"), weights or {}
    for s in range(shards):
        leaf = Node(f"s{s}", shard=s, own=weights.get(s, 1.0))
        region = f"g{s // region_size}" if s < planned else f"x{s}"
        rack = f"k{s // rack_size}" if s < planned else f"x{s}"
        for parent, name in ((root, region), (None, rack)):
            parent = parent or at
            at = next((c for c in parent.children if c.name == name), None)
            if at is None:
                at = Node(name)
                parent.children.append(at)
        at.children.append(leaf)
    return root


def draw(key: Column, name: str, weight: float, seed: int) -> Column:
    """Exponential draw with rate ``weight``; 52 hash bits give ``u``."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{seed}/{name}")), 12)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(2 ** 52))) / F.lit(weight)


def place(key: Column, node: Node, seed: int = 0, path: str = "") -> Column:
    """Shard number of ``key`` below ``node``."""
    if not node.children:
        return F.lit(node.shard)
    names = [f"{path}/{c.name}" for c in node.children]
    below = [place(key, c, seed, n) for c, n in zip(node.children, names)]
    if len(below) == 1:
        return below[0]
    draws = F.array(*[draw(key, n, c.weight, seed) for c, n in zip(node.children, names)])
    winner = F.array_position(draws, F.array_min(draws))
    out = F.when(winner == 1, below[0])
    for i, b in enumerate(below[1:], 2):
        out = out.when(winner == i, b)
    return out


def assign(docs: DataFrame, shards: int = 8, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
           planned: int | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row.
    Only ids, sizes and checksums are written and shuffled, never texts;
    slots are numbered in id order within the shard."""
    planned = shards if planned is None else planned
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    small = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"),
                        F.crc32(raw).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    placed = small.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    key = F.col("doc_id")
    placed = placed.select(*order, "_part", place(key, layout(shards, planned), seed).cast("int").alias("shard"),
                           place(key, layout(shards + 1, planned), seed).cast("int").alias("grown_shard"))
    ranked = rank_in_group(materialize(placed, "shards"), ["shard"], "_part", order, "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
