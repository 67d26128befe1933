"""Best-fit packing of tokenized documents by bin completion.

Which document goes where matters only up to its length, so the plan is made
on the histogram of piece lengths (at most ``capacity`` entries, whatever the
corpus) and then carried out by Spark: pieces are ranked within their length
by many tasks, and (length, rank) says sequence and offset.

The plan: the longest remaining length opens a sequence; undominated fillings
of the rest are enumerated over all lengths left (a filling is dominated when
its documents fit into the documents of another), best fit first, by a table
of the sums that can be reached; each is applied to half of the sequences that the counts allow, so a
plan has at most a few thousand blocks at any size.  Depth-first search keeps the best complete
plan as incumbent, starting from the first (best-fit) dive, and leaves a
branch once its waste exceeds what a better plan may waste.  It ends when the
lower bound ceil(total / capacity) is met or ``max_nodes`` fillings were
looked at after the first dive.  A plan above the bound is then improved part
by part: sequences that waste most, with full ones drawn at random, are planned
anew by the same search, and a part that needs fewer sequences, or gathers its
waste in fewer, takes the place of the old one.  That ends at the bound or
after ``rounds`` parts.

Edge cases: a null or empty text still has its closing id; repeated rows are
packed each; an empty table gives an empty plan and result.
"""

from __future__ import annotations

import bisect
import json
import random
import re
import struct
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize, rank_in_group

CAPACITY = 2048
CLOSING_ID = 0
# Fixed value: the byte-level pre-tokenizer's pattern.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Beyond these characters classes may differ between Unicode versions.
OTHER = re.compile(r"[^\x00-\u024f]")


class TokenIds:
    """Ids of whole texts as little-endian bytes, those of the tokenizer file.

    The file's vocabulary, as byte ranks, also runs in tiktoken, which is five
    times faster; texts with other than Latin characters, or that spell a
    special token, go through the tokenizer itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        if made["normalizer"] or (before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True)) != (
                "ByteLevel", False, True):
            raise ValueError("this file's normalizer or pre-tokenizer is not that of plain byte-level words")
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = list(added)
        # Byte-level files write each byte as a printable character: those
        # that are printable as themselves, the rest from U+0100 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte = {chr(b): b for b in shown} | {
            chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
        ranks = {bytes(byte[c] for c in token): i for token, i in self.tokenizer.get_vocab(False).items()
                 if token not in added}
        self.fast = tiktoken.Encoding("file", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


_coders: dict[str, TokenIds] = {}


def coder(path: str) -> TokenIds:
    if path not in _coders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        _coders[path] = TokenIds(path)
    return _coders[path]


def pieces_of(text: Column, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> Column:
    """Array of ``(piece, start, length, ids_crc32[, ids])`` structs for a text column.
    A document longer than ``capacity`` is cut from its end, so that only its
    first piece may be short."""
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids

    @F.pandas_udf(f"array<struct<{fields}>>")
    def run(texts: pd.Series) -> pd.Series:
        out, close = [], struct.pack("<I", CLOSING_ID)
        encode = coder(path)
        for t in texts:
            raw = encode(t if isinstance(t, str) else "") + close
            n, rows = len(raw) // 4, []
            at, end = 0, n % capacity or capacity
            while at < n:
                ids = raw[4 * at:4 * end]
                row = {"piece": len(rows), "start": at, "length": end - at, "ids_crc32": zlib.crc32(ids)}
                rows.append(row | {"ids": ids} if keep_ids else row)
                at, end = end, end + capacity
            out.append(rows)
        return pd.Series(out)

    return run(text)


# -- the plan ---------------------------------------------------------------


@dataclass
class Block:
    """``times`` sequences filled alike: lengths in descending order."""
    lengths: tuple[int, ...]
    times: int


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the documents of ``b`` fit into those of ``a`` (first fit)."""
    room = sorted(a)
    for x in sorted(b, reverse=True):
        i = bisect.bisect_left(room, x)
        if i == len(room):
            return False
        left = room.pop(i) - x
        bisect.insort(room, left)
    return True


class Fillings:
    """Every filling of ``room`` from the documents ``left``, best fit first
    and longest documents first; one document of the size ``taken`` opened the
    sequence and is not there to fill with.  ``lowest[t]`` is how far the
    ascending ``sizes`` must go for a sum of ``t``, so no step is taken that
    does not end in a filling.

    A level of the search holds two short arrays, some 8 KB.  ``left`` is read
    as it is when the next filling is asked for: the search has then undone
    what it tried."""

    def __init__(self, left: dict[int, int], room: int, taken: int):
        self.left, self.room, self.taken = left, room, taken
        self.sizes = array("i", sorted(s for s in left if s <= room and self.free(s)))
        self.lowest = array("i", [len(self.sizes)]) * (room + 1)
        self.lowest[0] = -1
        whole, sums = (1 << room + 1) - 1, 1  # bit t: t is a sum of the sizes so far
        for j, s in enumerate(self.sizes):
            before, n, step = sums, min(self.free(s), room // s), 1
            while n:  # 1, 2, 4, ... documents at a time, as many as there are
                k = min(step, n)
                sums |= sums << k * s & whole
                n, step = n - k, 2 * step
            for t in _bits(sums & ~before):
                self.lowest[t] = j
            if sums == whole:
                break

    def free(self, size: int) -> int:
        return self.left[size] - (size == self.taken)

    def of_sum(self, total: int, top: int) -> Iterator[tuple[int, ...]]:
        """Fillings of exactly ``total`` from the ``top`` shortest sizes."""
        if not total:
            yield ()
            return
        for j in range(min(top, bisect.bisect_right(self.sizes, total)) - 1, self.lowest[total] - 1, -1):
            s = self.sizes[j]
            for k in range(min(self.free(s), total // s), 0, -1):
                if self.lowest[total - k * s] < j:
                    for rest in self.of_sum(total - k * s, j):
                        yield (s,) * k + rest

    def __iter__(self) -> Iterator[tuple[int, ...]]:
        for total in range(self.room, -1, -1):
            yield from self.of_sum(total, len(self.sizes))


def _bits(n: int) -> Iterator[int]:
    """Positions of the bits set in ``n``."""
    text = bin(n)[:1:-1]
    at = text.find("1")
    while at >= 0:
        yield at
        at = text.find("1", at + 1)


def plan(counts: dict[int, int], capacity: int = CAPACITY, max_nodes: int = 6_000, rounds: int = 600) -> list[Block]:
    """Blocks that pack ``counts[length]`` pieces of every length."""
    blocks = Counter()
    for b in searched(counts, capacity, max_nodes):
        blocks[b.lengths] += b.times
    bound = -(-sum(n * c for n, c in counts.items()) // capacity)
    rng, n = random.Random(5), blocks.total()
    for _ in range(rounds):
        if n <= bound:
            break
        # Wasted squares grow as waste is gathered in fewer sequences.
        waste = {f: capacity - sum(f) for f in blocks}
        loose = sorted((f for f in blocks if waste[f]), key=lambda f: (-waste[f], f))
        part = Counter()
        for f in loose[:1] + rng.sample(loose[1:], min(LOOSE - 1, len(loose) - 1)):
            part[f] += 1
        full = sorted(f for f in blocks if not waste[f])
        for f in rng.sample(full, min(FULL, len(full))):
            part[f] += 1
        pieces = Counter()
        for f, k in part.items():
            for s in f:
                pieces[s] += k
        made = Counter()
        for b in searched(pieces, capacity, PART_NODES):
            made[b.lengths] += b.times
        gathered = lambda p: sum((capacity - sum(f)) ** 2 * k for f, k in p.items())
        if (made.total(), -gathered(made)) < (part.total(), -gathered(part)):
            blocks = blocks - part + made
            n += made.total() - part.total()
    return [Block(f, k) for f, k in blocks.items()]


LOOSE, FULL, PART_NODES = 6, 6, 400


def searched(counts: dict[int, int], capacity: int, max_nodes: int) -> list[Block]:
    """The best plan that the search finds within ``max_nodes`` fillings."""
    total = sum(n * c for n, c in counts.items())
    if not total:
        return []
    bound = -(-total // capacity)
    best: list[Block] | None = None
    best_n = None
    left = {n: c for n, c in counts.items() if c}

    def frame(block: Block | None, lost: int, n: int) -> tuple:
        """What one more level needs: the block that led here, its fillings and those tried."""
        longest = max(left)
        return block, lost, n, longest, iter(Fillings(left, capacity - longest, longest)), []

    def apply(block: Block, sign: int) -> None:
        for s in block.lengths:
            left[s] = left.get(s, 0) - sign * block.times
            if not left[s]:
                del left[s]

    stack = [frame(None, 0, 0)]
    nodes = 0
    while stack and (best is None or nodes < max_nodes and best_n > bound):
        block, lost, n, longest, todo, tried = stack[-1]
        filling = next(todo, None)
        # What the sequences of a plan that saves one may still waste.
        spare = None if best is None else (best_n - 1) * capacity - total - lost
        waste = capacity - longest - sum(filling) if filling is not None else 0
        if filling is None or spare is not None and waste > spare:  # later fillings waste as much
            stack.pop()
            if block:
                apply(block, -1)
            continue
        nodes += best is not None  # the first dive is never cut short
        if any(dominates(k, filling) for k in tried):
            continue
        tried.append(filling)
        need = Counter((longest, *filling))
        most = min(left[s] // k for s, k in need.items())
        times = (most + 1) // 2  # the other half stays free to fit with others
        if spare is not None and waste:
            times = min(times, spare // waste)
        block = Block((longest, *filling), times)
        apply(block, 1)
        if left:
            stack.append(frame(block, lost + times * waste, n + times))
        else:
            if best is None or n + times < best_n:
                best_n, best = n + times, [f[0] for f in stack if f[0]] + [block]
            apply(block, -1)
    return best


def places(blocks: list[Block]) -> np.ndarray:
    """Rows ``(length, first rank, ranks, first sequence, per sequence, offset)``
    by length and rank: where the pieces of each length go."""
    rows, used, sequence = [], Counter(), 0
    for b in blocks:
        offset = 0
        for n, k in sorted(Counter(b.lengths).items(), reverse=True):
            rows.append((n, used[n], k * b.times, sequence, k, offset))
            used[n] += k * b.times
            offset += n * k
        sequence += b.times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def placed(length: Column, rank: Column, where: np.ndarray) -> Column:
    """Struct ``(sequence_id, offset)``; ``where`` has a row for each block and
    length, bounded by the capacity alone."""
    @F.pandas_udf("sequence_id bigint, offset bigint")
    def run(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        key = (where[:, 0] << 40) + where[:, 1]
        n, r = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        row = where[np.searchsorted(key, (n << 40) + r, side="right") - 1]
        j = r - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + j // row[:, 4], "offset": row[:, 5] + j % row[:, 4] * n})

    return run(length, rank)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         keep_ids: bool = False, max_nodes: int = 6_000) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])`` per
    piece.  Texts are tokenized once; what is written and shuffled afterwards
    are the pieces' numbers (and ids, if kept)."""
    made = docs.select(F.col(id_col).alias("doc_id"), F.explode(
        pieces_of(F.col(text_col), path, capacity, keep_ids)).alias("_p"))
    rows = materialize(made.select("doc_id", "_p.*", F.spark_partition_id().alias("_part")), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(plan(counts, capacity, max_nodes))
    order = ["doc_id", "piece", "ids_crc32"]
    ranked = rank_in_group(rows, ["length"], "_part", order, "_rank")
    out = ranked.withColumn("_w", placed(F.col("length"), F.col("_rank"), where))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "_w.sequence_id", "_w.offset",
                      *["ids"] * keep_ids)
