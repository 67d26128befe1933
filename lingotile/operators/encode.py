"""Encode / decode / pad / batch as dictionary joins and array expressions.

A list of tokens is looked up in Arrow batches and stays one row.  With a
broadcast vocabulary the only exchange moves one id array per document, never
the text or a row per token.  Small key columns named in ``keep``
travel with the rows; other columns are joined back only when asked for.

A vocabulary is broadcast if its measured bytes are within the session's
``spark.sql.autoBroadcastJoinThreshold``.  Beyond, lists are written once in
chunks, as numbers into their chunk's own distinct tokens (``coded_lists``): the
distinct (chunk, token) pairs meet the vocabulary (a token has one pair a chunk
there, however often it occurs), what they find is sent to the chunk, and the
lists are looked up there in Arrow batches (``lookup_coded``).  Shuffled are the
numbers, once, and the pairs, never texts or a row per token.  ``lookup`` is the
same for rows that are no lists, joined by (salt, key) beyond the broadcast limit.

Keys of a vocabulary must be unique; a repeated one raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingotile.functions.text import PAD, UNK
from lingotile.operators.ranking import broadcast_limit, measured
from lingotile.session import ship_package, written

SALTS_PER_PARTITION = 32
BLOCKS_PER_PARTITION = 4   # evens out the blocks that one partition gets
CHUNK_ELEMENTS = 1 << 20   # list elements that share a chunk's dictionary; a longer list is a chunk


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _carried(df: DataFrame, key: str, keep: list[str] | None) -> list[str]:
    return [c for c in (keep or []) if c != key]


def _attach(df: DataFrame, grouped: DataFrame, key: str, keep: list[str] | None) -> DataFrame:
    """``keep=None``: every input column is wanted, so join the result back
    (one shuffle of the input); otherwise the carried columns suffice."""
    if keep is None:
        return df.join(grouped, on=key, how="inner")
    return grouped


def _side(table: DataFrame, table_key: str, value: str, out: str) -> tuple[DataFrame, bool]:
    """The lookup table as ``(_k, out)``, and whether the session broadcasts it."""
    side = table.select(F.col(table_key).alias("_k"), F.col(value).alias(out))
    size, most = measured(side, "_k")
    if most > 1:
        raise ValueError(f"the lookup table holds a value of {table_key} {most} times")
    return side, size <= broadcast_limit(table)


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lookup(rows: DataFrame, rows_key: str, table: DataFrame, table_key: str, value: str,
           out: str, salt_by: str) -> DataFrame:
    """Left-join ``rows`` to ``table(table_key -> value)`` as column ``out``
    (null when absent); ``salt_by`` is a column that spreads a key's rows."""
    side, fits = _side(table, table_key, value, out)
    if fits:
        return rows.join(F.broadcast(side), rows[rows_key] == side["_k"], "left").drop("_k")
    salts = SALTS_PER_PARTITION * _shuffle_partitions(rows)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    pairs = salted.where(F.col(rows_key).isNotNull()).select(
        F.col("_salt").alias("_salt_of"), F.col(rows_key).alias("_probe")).distinct()
    found = pairs.join(side, pairs["_probe"] == side["_k"]).select("_salt_of", "_k", out)
    return salted.join(found, (salted["_salt"] == found["_salt_of"]) & (salted[rows_key] == found["_k"]), "left").drop(
        "_salt", "_salt_of", "_k")


def _looked(lists: pa.Array, known: pa.Table | None, kind: pa.DataType) -> pa.ListArray:
    """The values of ``known(_k, _v)`` for the elements of lists."""
    flat = lists.flatten()
    if known is not None:
        at = pc.index_in(flat, value_set=known["_k"].combine_chunks())
        values = known["_v"].combine_chunks().take(at)
    else:
        values = pa.nulls(len(flat), kind)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, values)


def _chunks(size: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Adjoining rows whose lists make up a chunk, by the lists' sizes."""
    of = (np.cumsum(size) - size) // most
    cuts = [int(c) for c in np.flatnonzero(np.diff(of)) + 1]
    return list(zip([0, *cuts], [*cuts, len(size)]))


def _elements(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def _coder(columns: list[str], split: Callable[[pa.Array], tuple[pa.Array, np.ndarray]], most: int):
    """mapInArrow function: a chunk's distinct elements with their codes, then
    its rows, the lists as codes.  Held is one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            flat, size = split(batch.column("_list"))
            ends = np.concatenate([[0], np.cumsum(size)])
            for a, b in _chunks(size, most) if len(size) else []:
                coded = pc.dictionary_encode(flat.slice(ends[a], ends[b] - ends[a]))
                part, known = batch.slice(a, b - a), coded.dictionary
                for n, code, probe, own, codes in (
                        (len(known), pa.array(np.arange(len(known), dtype=np.int32)), known,
                         [pa.nulls(len(known), part.schema.field(c).type) for c in columns], pa.nulls(len(known), pa.list_(pa.int32()))),
                        (b - a, pa.nulls(b - a, pa.int32()), pa.nulls(b - a, known.type), [part.column(c) for c in columns],
                         pa.ListArray.from_arrays(pa.array(ends[a:b + 1] - ends[a], pa.int32()), coded.indices))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)), code, probe, *own, codes],
                                                     names=["_chunk", "_code", "_probe", *columns, "_codes"])
                chunk += 1

    return run


def coded_lists(df: DataFrame, lists: Column, key: str, carry: list[str],
                split: Callable[[pa.Array], tuple[pa.Array, np.ndarray]] = _elements) -> DataFrame:
    """The written table of ``df``'s rows in chunks, ``(_chunk, _code, _probe,
    key, *carry, _codes)``: a row for each distinct element of a chunk (``_code``,
    ``_probe``), and the rows themselves (no ``_code``), their lists as codes.
    ``split`` makes of what ``lists`` holds the elements and each row's number of them."""
    ship_package(df.sparkSession)
    rows = df.select(key, *carry, lists.alias("_list"))
    kind = {f.name: f.dataType for f in rows.schema.fields}
    probe = kind["_list"].elementType if isinstance(kind["_list"], T.ArrayType) else kind["_list"]
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("_chunk", T.LongType()), ("_code", T.IntegerType()), ("_probe", probe), (key, kind[key]),
        *[(c, kind[c]) for c in carry], ("_codes", T.ArrayType(T.IntegerType()))]])
    return written(rows.mapInArrow(_coder([key, *carry], split, CHUNK_ELEMENTS), schema))


def coded_entries(coded: DataFrame) -> DataFrame:
    """``(_chunk, _code, _probe)``: the distinct elements of each chunk."""
    return coded.where(F.col("_code").isNotNull()).select("_chunk", "_code", "_probe")


def _flat_lists(values: pa.Array, ends: np.ndarray, levels: int) -> pa.ListArray:
    """Values as lists that end at ``ends``; lists of lists are put together ``levels`` times."""
    for _ in range(levels):
        size = pc.fill_null(pc.list_value_length(values), 0).to_numpy()
        ends, values = np.concatenate([[0], np.cumsum(size)])[ends], values.flatten()
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _chunk_lookup(columns: list[str], levels: int):
    """mapInArrow function over rows sorted by (chunk, kind): what a chunk's
    elements found (kind 0), then its rows (kind 1), whose codes are looked up.
    Held are one chunk's dictionary and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, found, place = None, [], None
        for batch in batches:
            chunks, kinds = batch.column("_chunk").to_numpy(), batch.column("_kind").to_numpy()
            cuts = [int(c) for c in np.flatnonzero((np.diff(chunks) != 0) | (np.diff(kinds) != 0)) + 1]
            for a, b in zip([0, *cuts], [*cuts, len(chunks)]):
                if a == b:
                    continue
                if chunks[a] != chunk:
                    chunk, found, place = chunks[a], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    found.append(part.select(["_code", "_v"]))
                    continue
                if place is None:
                    known = pa.Table.from_batches(found or [part.select(["_code", "_v"]).slice(0, 0)]).combine_chunks()
                    codes = known["_code"].to_numpy()
                    place = np.full(int(codes.max()) + 2 if len(codes) else 1, -1)   # the last: not found
                    place[codes] = np.arange(len(codes))
                    values = pa.concat_arrays(known["_v"].chunks) if len(codes) else pa.nulls(0, part.schema.field("_v").type)
                    found = []
                codes, size = _elements(part.column("_codes"))
                codes = pc.fill_null(codes, len(place) - 1).to_numpy()
                at = place[np.minimum(codes, len(place) - 1)]
                lists = _flat_lists(values.take(pa.array(at, mask=at < 0)), np.concatenate([[0], np.cumsum(size)]), levels)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], lists], names=[*columns, "_out"])

    return run


def lookup_coded(coded: DataFrame, side: DataFrame, key: str, carry: list[str], out: str, fields: dict[str, T.StructField],
                 flat: bool = False) -> DataFrame:
    """``(key, *carry, out)``: the values of ``side(_k, out)`` for the elements
    of lists that ``coded_lists`` has written, one row a key; ``fields`` are
    those of key and carry.  ``flat``: values are lists, and become one list."""
    parts = _shuffle_partitions(coded)
    kind = side.schema[out].dataType
    pairs = coded_entries(coded)
    found = pairs.join(side, pairs["_probe"] == side["_k"]).select(
        "_chunk", F.lit(0).alias("_kind"), "_code", F.col(out).alias("_v"))
    own = coded.where(F.col("_code").isNull())
    again = not own.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty()
    rows = own.select("_chunk", F.lit(1).alias("_kind"), key, *carry, "_codes").unionByName(found, allowMissingColumns=True)
    rows = rows.repartition(parts, "_chunk").sortWithinPartitions("_chunk", "_kind")
    # No null arrays: the Arrow writer goes over a batch's null lists again at every row.
    whole = [_no_null_list(c, coded.schema[c].dataType) for c in carry]
    rows = rows.select("_chunk", "_kind", "_code", _values(side, F.col("_v"), out).alias("_v"), key, *whole,
                       F.coalesce("_codes", F.array().cast("array<int>")).alias("_codes"))
    levels = 0 if not flat else 1 if again else isinstance(kind, T.ArrayType) + isinstance(getattr(kind, "elementType", None), T.ArrayType)
    made = kind if not levels else kind.elementType if levels == 1 else kind.elementType.elementType
    schema = T.StructType([fields[key], *[fields[c] for c in carry], T.StructField("_out", T.ArrayType(made))])
    looked = rows.mapInArrow(_chunk_lookup([key, *carry], levels), schema)
    if not again:
        return looked.withColumnRenamed("_out", out)
    merged = _one_row_a_key(looked.withColumnRenamed("_out", "_own"), key, carry, out)
    return merged.withColumn(out, F.flatten(out)) if flat and isinstance(made, T.ArrayType) else merged


def _no_null_list(c: str, kind: T.DataType) -> Column:
    # A row's own null list stays null; only rows that stand for an element get an empty one.
    return F.when(F.col("_kind") == 0, F.array().cast(kind)).otherwise(F.col(c)).alias(c) if isinstance(kind, T.ArrayType) else F.col(c)


def _one_row_a_key(rows: DataFrame, key: str, carry: list[str], out: str) -> DataFrame:
    """Rows of a key become one, the elements of ``_own`` by position, then value."""
    met = rows.groupBy(key).agg(F.collect_list("_own").alias("_all"), *[F.first(c).alias(c) for c in carry])
    placed = F.flatten(F.transform("_all", lambda own: F.transform(own, lambda v, p: F.struct(p.alias("p"), v.alias("v")))))
    merged = F.when(F.size("_all") == 1, F.col("_all")[0]).otherwise(F.transform(F.array_sort(placed), lambda x: x["v"]))
    return met.select(key, *carry, merged.alias(out))


def _none(df: DataFrame, lists: Column) -> Column:
    # No null arrays: the Arrow writer goes over a batch's null lists again at every row.
    return F.array().cast(df.select(lists.alias("_l")).schema["_l"].dataType)


def _values(side: DataFrame, value: Column, out: str) -> Column:
    kind = side.schema[out].dataType
    return F.coalesce(value, F.array().cast(kind)) if isinstance(kind, T.ArrayType) else value


def _broadcast_lookup(df: DataFrame, lists: Column, side: DataFrame, key: str, carry: list[str], out: str) -> DataFrame:
    """The table goes to every task, within the session's broadcast limit; a
    list is looked up and moved as one row.  Rows of a key become one, their
    elements by position, then value."""
    ship_package(df.sparkSession)
    known = side.where(F.col("_k").isNotNull()).select("_k", _values(side, F.col(out), out).alias("_v")).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as w:
        w.write_table(known)
    shared = df.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    @F.arrow_udf(T.ArrayType(side.schema[out].dataType))
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.ipc.open_stream(shared.value).read_all().combine_chunks()
        for batch in batches:
            yield _looked(batch, table, table.schema.field("_v").type)

    rows = df.select(key, *carry, found(F.coalesce(lists, _none(df, lists))).alias("_own"))
    return _one_row_a_key(rows, key, carry, out)


def lookup_lists(df: DataFrame, lists: Column, table: DataFrame, table_key: str, value: str, key: str,
                 carry: list[str], out: str) -> DataFrame:
    """``(key, *carry, out ARRAY)``: the values of ``table(table_key -> value)``
    for the elements of ``lists`` (null when absent), one row a key."""
    side, fits = _side(table, table_key, value, out)
    if not fits:
        coded = coded_lists(df, F.coalesce(lists, _none(df, lists)), key, carry)
        return lookup_coded(coded, side, key, carry, out, {f.name: f for f in df.schema.fields})
    return _broadcast_lookup(df, lists, side, key, carry, out)


# A vocabulary made from an alphabet in the program is an array literal,
# indexed by code point for encoding and by id for decoding: no explode, join
# or regroup.  ``vocab.char_vocab`` leaves its entries on the table it returns.
ENTRIES = "_alphabet_entries"
ID_RANGE = "_id_range"   # on what such an encode returns: column -> (least, greatest) id that it can hold


def _entries(vocab: DataFrame) -> list | None:
    return vocab.__dict__.get(ENTRIES)


def char_id_table(rows: list) -> tuple[list, dict]:
    """Dense code point -> id list for the single-character entries, plus the
    specials."""
    single = {t: i for i, t in rows if len(t) == 1}
    table = [None] * (max(map(ord, single), default=0) + 1)
    for t, i in single.items():
        table[ord(t)] = i
    return table, {t: i for i, t in rows if len(t) != 1}


def encode_with_table(tokens: Column, table: tuple[list, dict], unk_id: int = 1) -> Column:
    """Token -> id through literals: single characters by code point,
    multi-character tokens through the small map of such entries."""
    dense, multi = table
    arr = F.array(*[F.lit(v).cast("bigint") for v in dense])
    if multi:
        m = F.create_map(*[x for t, i in multi.items() for x in (F.lit(t), F.lit(i).cast("bigint"))])
    unk = F.lit(unk_id).cast("bigint")

    def id_of(c):
        one = F.try_element_at(arr, F.ascii(c) + 1)
        if not multi:
            return F.coalesce(F.when(F.length(c) == 1, one), unk)
        return F.coalesce(F.when(F.length(c) == 1, one).otherwise(F.element_at(m, c)), unk)

    return F.transform(F.coalesce(tokens, F.array().cast("array<string>")), id_of)


def decode_with_table(ids: Column, rows: list, unk_token: str | None, drop: list[str]) -> Column:
    """ids -> tokens through an id-indexed literal (unknown id -> unk_token,
    or dropped when ``unk_token`` is None); tokens in ``drop`` removed."""
    top = max(i for i, _ in rows)
    table = [None] * (top + 1)
    for i, t in rows:
        table[i] = t
    arr = F.array(*[F.lit(t).cast("string") for t in table])
    looked = F.transform(F.coalesce(ids, F.array().cast("array<bigint>")), lambda i: F.when((i >= 0) & (i <= top), F.try_element_at(arr, (i + 1).cast("int"))))
    if unk_token is not None:
        looked = F.transform(looked, lambda t: F.coalesce(t, F.lit(unk_token)))
    else:
        looked = F.filter(looked, lambda t: t.isNotNull())
    if drop:
        looked = F.filter(looked, lambda t: ~t.isin(*drop))
    return looked


def encode(df: DataFrame, tokens: Column | str, vocab: DataFrame, key: str = "doc_id",
           out: str = "ids", unk_id: int = 1, lowercase: bool = False,
           keep: list[str] | None = None) -> DataFrame:
    """Adds ``out ARRAY<BIGINT>``: token ids in order, unknown -> ``unk_id``.
    ``key`` must be unique per row; rows with no (or null) tokens get ``[]``.  The
    result has ``key``, the ``keep`` columns and ``out`` (``keep=None``:
    all input columns, joined back)."""
    toks = _col(tokens)
    if lowercase:
        toks = F.transform(toks, F.lower)
    entries = _entries(vocab)
    if entries is not None:
        res = df.withColumn(out, encode_with_table(toks, char_id_table(entries), unk_id))
        res = res if keep is None else res.select(key, *_carried(df, key, keep), out)
        every = [unk_id, *[i for i, _ in entries]]
        res._id_range = {out: (min(every), max(every))}
        return res
    looked = lookup_lists(df, toks, vocab, "token", "id", key, _carried(df, key, keep), out)
    unk = F.lit(unk_id).cast("bigint")
    return _attach(df, looked.withColumn(out, F.transform(out, lambda i: F.coalesce(i, unk))), key, keep)


def decode_tokens(df: DataFrame, ids: Column | str, vocab: DataFrame, key: str = "doc_id",
                  out: str = "tokens", unk_token: str = UNK, drop_pad: bool = False,
                  skip: list[str] | None = None, unknown_dropped: bool = False,
                  keep: list[str] | None = None) -> DataFrame:
    """Adds ``out ARRAY<STRING>``: ids mapped back through the vocabulary;
    unknown ids become ``unk_token`` (or are dropped), optionally the
    padding token and other listed tokens are dropped."""
    drop = list(skip or []) + ([PAD] if drop_pad else [])
    entries = _entries(vocab)
    if entries is not None:
        res = df.withColumn(out, decode_with_table(_col(ids), entries,
                                                   None if unknown_dropped else unk_token, drop))
        return res if keep is None else res.select(key, *_carried(df, key, keep), out)
    looked = lookup_lists(df, _col(ids), vocab, "id", "token", key, _carried(df, key, keep), out)
    empty = F.size(out) == 0
    tokens = F.col(out)
    if not unknown_dropped:
        tokens = F.transform(tokens, lambda t: F.coalesce(t, F.lit(unk_token)))
    if drop or unknown_dropped:
        tokens = F.filter(tokens, lambda t: (t.isNotNull() & ~t.isin(*drop)) if drop else t.isNotNull())
    looked = looked.withColumn("_n", empty).withColumn(out, tokens)
    return _attach(df, looked.where(F.col("_n") | (F.size(out) > 0)).drop("_n"), key, keep)


def decode(df: DataFrame, ids: Column | str, vocab: DataFrame, key: str = "doc_id",
           out: str = "decoded", sep: str = " ", unk_token: str = UNK,
           keep: list[str] | None = None) -> DataFrame:
    """Reference decoding: unknown id -> ``<unk>``, ``<pad>`` dropped, tokens
    joined with ``sep`` (``""`` for characters, ``" "`` for words/grams)."""
    t = decode_tokens(df, ids, vocab, key, "_dt", unk_token=unk_token, drop_pad=True, keep=keep)
    return t.withColumn(out, F.array_join("_dt", sep)).drop("_dt")


def add_bos_eos(ids: Column | str, bos_id: int = 2, eos_id: int = 3) -> Column:
    return F.concat(F.array(F.lit(bos_id).cast("bigint")), _col(ids),
                    F.array(F.lit(eos_id).cast("bigint")))


def pad_or_truncate(ids: Column | str, length: int, pad_id: int = 0) -> Column:
    """Fixed length: cut at ``length`` or right-pad with ``pad_id``."""
    return F.slice(F.concat(_col(ids), F.array_repeat(F.lit(pad_id).cast("bigint"), length)), 1, length)


def pad_to(ids: Column | str, length: Column | int, pad_id: int = 0) -> Column:
    """Right-pad to ``length``; never truncates."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.concat(_col(ids), F.array_repeat(F.lit(pad_id).cast("bigint"),
                                              F.greatest(n - F.size(_col(ids)), F.lit(0))))


def unk_rate(encoded: DataFrame, ids: str = "ids", group: str = "lang", unk_id: int = 1) -> DataFrame:
    """Share of unknown ids per group (token-weighted)."""
    per_doc = encoded.select(group, F.size(ids).alias("_n"),
                             F.size(F.filter(ids, lambda i: i == unk_id)).alias("_u"))
    return per_doc.groupBy(group).agg(
        F.sum("_n").cast("bigint").alias("n_tokens"),
        F.sum("_u").cast("bigint").alias("n_unk"),
        (F.sum("_u") / F.sum("_n")).cast("double").alias("unk_rate"))
