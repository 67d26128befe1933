"""Exact substring dedup by suffix arrays over content-routed shards.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is found, across all texts and within one.

* Anchors: of the byte grams of ``length - context`` bytes in any string of
  ``length`` bytes, the one with the least hash (the last of equals).  Two
  equal strings have equal anchors, so only texts around anchors that occur
  twice or more can hold a repeated string.
* Occurrences of an anchor with equal contexts (``context`` bytes on either
  side) form a class; a class of two or more is repeated as a whole.  An
  anchor with one class needs no more work.
* For anchors with several classes, one contracted string for each class
  (left context, three symbols for the anchor, right context) goes to the
  shard of its anchor.  Each shard is sorted by external induced sorting
  (``induced``) with common prefixes; a string of ``length`` bytes is
  repeated if it shares ``context + 3`` contracted symbols with a neighbour.

Copies meet in partial aggregations (counts of anchors, then of classes), so
a shard holds different contexts only; a shard beyond memory sorts on disk.

Edge cases: null texts count as empty; texts under ``length`` bytes keep all;
repeated rows repeat each other; an empty table gives an empty result.  The
input is read twice and must give the same rows in the same partitions each
time, as a table scan does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize, release
from lingotile.llm.hashing import mix
from lingotile.llm.induced import MEMORY_BYTES, Store, repeated

LENGTH, CONTEXT = 200, 48
# Contracted symbols: end mark, separator, bytes, anchor digits.
END, SEPARATOR, FIRST_BYTE, FIRST_DIGIT, DIGIT_BASE, DIGITS = 0, 1, 2, 258, 1024, 3
SYMBOLS = FIRST_DIGIT + DIGIT_BASE

_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(200).integers(0, 2 ** 64, 256, dtype=np.uint64, endpoint=False)
CHUNK = 1 << 16
# Contracted symbols a shard aims at, and the most shards of a job: beyond
# them shards grow and are sorted on disk.
SHARD_SYMBOLS, MAX_SHARDS = 2_000_000, 100_000


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_up, _down = (_powers(p, CHUNK) for p in (_ODD, pow(_ODD, -1, 2 ** 64)))


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each position (at most CHUNK bytes)."""
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_BYTE[data] * _up[:n])])
        return mix((sums[width:] - sums[:-width]) * _down[:n - width + 1])


def _slide(values: np.ndarray, window: int, least_or_most) -> np.ndarray:
    """``least_or_most`` (a numpy ufunc) of every ``window`` values."""
    width = 1
    while 2 * width <= window:
        values = least_or_most(values[:-width], values[width:])
        width *= 2
    shift = window - width
    return least_or_most(values[:-shift], values[shift:]) if shift else values


def window_minima(values: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least value of some window (all equals do): the
    greatest minimum of the windows around a position is its own value."""
    edge = np.zeros(window - 1, values.dtype)
    least = _slide(values, window, np.minimum)
    return np.flatnonzero(_slide(np.concatenate([edge, least, edge]), window, np.maximum) == values)


def anchors_in(data: bytes, length: int, context: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the anchors of one text, in blocks of CHUNK bytes."""
    gram, raw = length - context, np.frombuffer(data, np.uint8)
    hashes, found = [], []
    for lo in range(0, max(0, len(raw) - length + 1), CHUNK - length + 1):
        h = gram_hashes(raw[lo:lo + CHUNK], gram)
        at = window_minima(h, context + 1)
        hashes.append(h[at].view(np.int64))
        found.append(at + lo)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, first = np.unique(np.concatenate(found), return_index=True)
    return np.concatenate(hashes)[first], at


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "replace") if text else b""


def anchors(text: Column, length: int, context: int) -> Column:
    @F.pandas_udf("fp array<bigint>, pos array<bigint>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([anchors_in(_bytes(t), length, context) for t in texts], columns=["fp", "pos"])

    return run(text)


def class_ids(text: Column, pos: Column, length: int, context: int) -> Column:
    """For each anchor position a hash of both its contexts."""
    @F.pandas_udf("array<bigint>")
    def run(texts: pd.Series, lists: pd.Series) -> pd.Series:
        gram, out = length - context, []
        for t, at in zip(texts, lists):
            data = _bytes(t)
            out.append(np.array([int.from_bytes(hashlib.blake2b(
                data[max(0, p - context):p] + b"\xff" + data[p + gram:p + length], digest_size=8).digest(),
                "little", signed=True) for p in at.tolist()], np.int64))
        return pd.Series(out)

    return run(text, pos)


def contexts(text: Column, pos: Column, length: int, context: int) -> Column:
    """For each anchor position its left and right context."""
    @F.pandas_udf("left array<binary>, right array<binary>")
    def run(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        gram, rows = length - context, []
        for t, at in zip(texts, lists):
            data = _bytes(t)
            rows.append(([data[max(0, p - context):p] for p in at.tolist()],
                         [data[p + gram:p + length] for p in at.tolist()]))
        return pd.DataFrame(rows, columns=["left", "right"])

    return run(text, pos)


class ShardText:
    """The shard's contracted strings, kept on disk beyond ``MEMORY_BYTES``."""

    def __init__(self, store: Store):
        self.store, self.parts, self.n, self.held, self.file = store, [], 0, 0, None

    def add(self, symbols: np.ndarray) -> None:
        self.parts.append(symbols)
        self.n += len(symbols)
        self.held += symbols.nbytes
        if self.held > MEMORY_BYTES:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.store.array(MEMORY_BYTES + 1, np.uint8)  # makes the store's folder
            self.file = open(f"{self.store.folder}/text", "w+b")
        for p in self.parts:
            self.file.write(p.tobytes())
        self.parts, self.held = [], 0

    def whole(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate(self.parts)
        self._spill()
        self.file.flush()
        return np.memmap(self.file.name, np.int32, "r", shape=self.n)


def _contracted(left: bytes, rank: int, right: bytes) -> np.ndarray:
    out = np.empty(len(left) + DIGITS + len(right) + 1, np.int32)
    k = len(left)
    out[:k] = np.frombuffer(left, np.uint8)
    out[:k] += FIRST_BYTE
    for d in range(DIGITS):
        out[k + d] = FIRST_DIGIT + rank // DIGIT_BASE ** d % DIGIT_BASE
    out[k + DIGITS:-1] = np.frombuffer(right, np.uint8)
    out[k + DIGITS:-1] += FIRST_BYTE
    out[-1] = SEPARATOR
    return out


def runs(flags: np.ndarray) -> np.ndarray:
    """``[start, end)`` rows of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def sort_shard(length: int, context: int):
    """mapInPandas function over one shard, sorted by anchor."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with Store() as store:
            text, rows, rank, last, longest = ShardText(store), [], -1, None, 0
            for batch in batches:
                for fp, rid, pos, many, left, right in batch.itertuples(index=False):
                    if fp != last:
                        rank, last = rank + 1, fp
                    if not many:
                        rows.append((rid, pos, text.n, len(left), len(right)))
                    text.add(_contracted(left, rank, right))
            if not text.n:
                return
            text.add(np.array([END], np.int32))
            hit = repeated(text.whole(), SYMBOLS, context + DIGITS, store)
            for lo in range(0, len(rows), 10_000):
                found = []
                for rid, pos, start, n_left, n_right in rows[lo:lo + 10_000]:
                    # Strings that start o bytes before the anchor, longest o first.
                    most, least = min(context, n_left), max(0, context - n_right)
                    part = hit[start + n_left - most:start + n_left - least + 1] if most >= least else hit[:0]
                    spans = runs(part) + (pos - most)
                    spans[:, 1] += length - 1
                    found.append((rid, pos, spans.ravel()))
                yield pd.DataFrame(found, columns=["_rid", "pos", "spans"])

    return run


def covered_spans(n: int, pos: np.ndarray, part_pos, part_spans, length: int, context: int) -> np.ndarray:
    """Maximal removed runs of a text of ``n`` bytes: whole surroundings of its
    anchors but for those in ``part_pos``, which have spans of their own."""
    gram = length - context
    partial = dict(zip(part_pos, part_spans)) if part_pos is not None else {}
    edge = np.zeros(n + 1, np.int32)
    whole = np.array([p for p in pos.tolist() if p not in partial], np.int64)
    lo, hi = np.maximum(whole - context, 0), np.minimum(whole + gram + context, n)
    fits = hi - lo >= length
    np.add.at(edge, lo[fits], 1)
    np.add.at(edge, hi[fits], -1)
    for spans in partial.values():
        if spans is not None and len(spans):
            np.add.at(edge, np.asarray(spans)[0::2], 1)
            np.add.at(edge, np.asarray(spans)[1::2], -1)
    return runs(np.cumsum(edge[:n]) > 0)


def cut(data: bytes, spans: np.ndarray) -> bytes:
    at, kept = 0, []
    for s, e in spans.tolist():
        kept.append(data[at:s])
        at = e
    return b"".join(kept) + data[at:]


def _outcome(text: Column, pos: Column, part_pos: Column, part_spans: Column, length: int, context: int,
             keep_rest: bool) -> Column:
    """Struct of the figures or, with ``keep_rest``, of the remaining text:
    without the bytes of a cut character, null where nothing is removed."""
    fields = "kept string" if keep_rest else "n_removed bigint, n_spans bigint, kept_sha256 string"

    @F.pandas_udf(fields)
    def run(texts: pd.Series, lists: pd.Series, part: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, at, pp, ps in zip(texts, lists, part, spans):
            data = _bytes(t)
            gone = covered_spans(len(data), at, pp, ps, length, context)
            rest = cut(data, gone)
            if keep_rest:
                rows.append((rest.decode("utf-8", "ignore") if len(gone) else None,))
            else:
                rows.append((int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(rest).hexdigest()))
        return pd.DataFrame(rows, columns=["kept"] if keep_rest else ["n_removed", "n_spans", "kept_sha256"])

    return run(text, pos, part_pos, part_spans)


def numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_rid", F.monotonically_increasing_id())


def removals(texts: DataFrame, length: int = LENGTH, context: int = CONTEXT, keep_rest: bool = True) -> DataFrame:
    """``(_rid, n_removed, n_spans, kept_sha256)`` or, with ``keep_rest``,
    ``(_rid, kept)`` for the texts (``_rid, text``) that hold an anchor found
    twice or more; ``kept`` is null where nothing is removed."""
    made = texts.select("_rid", anchors(F.col("text"), length, context).alias("_a"))
    at = made.select("_rid", F.explode(F.arrays_zip("_a.fp", "_a.pos")).alias("_a")).select("_rid", "_a.fp", "_a.pos")
    twice = at.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    found = materialize(at.join(twice, "fp"), "anchors")
    by_text = found.groupBy("_rid").agg(F.collect_list("pos").alias("pos"), F.collect_list("fp").alias("fp"))
    involved = by_text.join(texts, "_rid").withColumn("cid", class_ids(F.col("text"), F.col("pos"), length, context))
    involved = materialize(involved, "involved")
    release(found)
    each = involved.select("_rid", F.explode(F.arrays_zip("pos", "fp", "cid")).alias("_a")).select("_rid", "_a.*")
    classes = materialize(each.groupBy("fp", "cid").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_rid", "pos")).alias("at")), "classes")
    several = classes.groupBy("fp").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("fp")
    chosen = materialize(classes.join(several, "fp").select("fp", (F.col("n") > 1).alias("many"), "at.*"), "chosen")
    release(classes)
    symbols = chosen.count() * (2 * context + DIGITS + 1)
    shards = min(MAX_SHARDS, symbols // SHARD_SYMBOLS + 1)
    wanted = chosen.groupBy("_rid").agg(F.collect_list("pos").alias("pos"), F.collect_list("fp").alias("fp"),
                                        F.collect_list("many").alias("many"))
    around = wanted.join(involved.select("_rid", "text"), "_rid").select(
        "_rid", "pos", "fp", "many", contexts(F.col("text"), F.col("pos"), length, context).alias("_c"))
    strings = around.select("_rid", F.explode(F.arrays_zip("fp", "pos", "many", "_c.left", "_c.right")).alias("_s")).select(
        "_s.fp", "_rid", "_s.pos", "_s.many", "_s.left", "_s.right")
    spans = materialize(strings.repartition(shards, "fp").sortWithinPartitions("fp").mapInPandas(
        sort_shard(length, context), "_rid bigint, pos bigint, spans array<bigint>"), "spans")
    release(chosen)
    partial = spans.groupBy("_rid").agg(F.collect_list("pos").alias("_pp"), F.collect_list("spans").alias("_ps"))
    done = involved.select("_rid", "text", "pos").join(partial, "_rid", "left").select(
        "_rid", _outcome(F.col("text"), F.col("pos"), F.col("_pp"), F.col("_ps"), length, context, keep_rest).alias("_o"))
    return done.select("_rid", "_o.*")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
           context: int = CONTEXT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row."""
    texts = numbered(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    gone = removals(texts.select("_rid", "text"), length, context, keep_rest=False)
    raw = F.encode("text", "UTF-8")
    plain = texts.select("_rid", "doc_id", F.octet_length(raw).cast("bigint").alias("n_bytes"),
                         F.sha2(raw, 256).alias("_sha"))
    return plain.join(gone, "_rid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, context: int = CONTEXT) -> DataFrame:
    """``docs`` with the repeated bytes cut from its texts (bytes of a cut
    character go too); all other columns and null texts stay."""
    rows = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    gone = removals(rows.select("_rid", F.coalesce(F.col("row")[text_col], F.lit("")).alias("text")), length, context)

    out = rows.join(gone, "_rid", "left")
    return out.select(*[(F.coalesce("kept", F.col("row")[c]) if c == text_col else F.col("row")[c]).alias(c)
                        for c in docs.columns])
