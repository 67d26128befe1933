"""CSV with quoted newlines, read by many tasks.

A record may hold newlines inside quotes, so where a record begins is not
known inside a file.  Whether a line begins inside quotes depends on all lines
before it, but only by one bit; each line, and so each run of lines, is a map
of that bit:

1. Every input split is scanned once without its texts: a row for each split
   says where its bit goes from either value, how many bytes its lines have,
   and where the last record begins that begins in it.
2. The rows of a file (one for each split) are folded in order: every split
   then knows its bit, its offset and the offset of the record it begins in.
3. A second scan cuts the records, split by split, with no shuffle.  Only
   records that cross a split's end leave their task, in parts: those meet by
   (file, offset).

A quote opens a field only at the field's start; doubled quotes inside a
quoted field are one quote.  Ids are (file, byte offset of the record), so
they do not depend on how the input is split.  Lines end with ``\\n`` or
``\\r\\n``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lingotile.operators.vocab import materialize
from lingotile.session import ship_package

OFFSET_BITS = 40  # a file has less than 1 TiB, a table less than 8 million files

# The cell texts that dataframe libraries read as missing by default.
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
             "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_OUT, _IN, _FIELD, _PLAIN, _QUOTED, _CLOSING = range(6)


def ends_inside(line: Column, inside: bool, sep: str = ",") -> Column:
    """Whether a line that begins inside quotes (or outside) ends inside.
    The text between two quotes decides what the next quote does."""
    def step(state: Column, text: Column) -> Column:
        def behind(empty: int) -> Column:
            return F.when(text == "", empty).when(F.endswith(text, F.lit(sep)), _FIELD).otherwise(_PLAIN)

        return (F.when((state == _IN) | (state == _FIELD) | (state == _CLOSING), _QUOTED)
                .when(state == _OUT, behind(_FIELD)).when(state == _PLAIN, behind(_PLAIN)).otherwise(behind(_CLOSING)))

    walked = F.aggregate(F.split(line, '"'), F.lit(_IN if inside else _OUT), step, lambda s: s == _QUOTED)
    return F.when(F.contains(line, F.lit('"')), walked).otherwise(inside)


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    line = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"), line.alias("line"), ends_inside(line, False, sep).alias("from_out"),
        ends_inside(line, True, sep).alias("from_in"), (F.octet_length(line) + 1).cast("bigint").alias("bytes"))


def _begins(from_out: np.ndarray, from_in: np.ndarray, start: bool) -> tuple[np.ndarray, bool]:
    """For lines in order: which of them begin inside quotes, and the bit behind the last."""
    fixed = from_out == from_in  # this line ends the same way, wherever it began
    turns = np.cumsum(~fixed & from_out)  # the others keep the bit, or turn it
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    base = np.where(last >= 0, from_out[last], start)
    after = base ^ ((turns - np.where(last >= 0, turns[last], 0)) % 2).astype(bool)
    return np.concatenate([[start], after[:-1]]).astype(bool), bool(after[-1])


def _runs(frame: pd.DataFrame) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """Consecutive lines of one split."""
    cuts = np.flatnonzero((frame["file"] != frame["file"].shift()) | (frame["split"] != frame["split"].shift()))
    for a, b in zip(cuts, [*cuts[1:], len(frame)]):
        yield frame["file"].iloc[a], int(frame["split"].iloc[a]), frame.iloc[a:b]


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per split: its map of the bit, bytes, and the last record's place from either bit (-1: none begins)."""
    key, state = None, None
    columns = ["file", "split", "end_out", "end_in", "bytes", "last_out", "last_in"]
    for batch in batches:
        out = []
        for file, split, part in _runs(batch):
            if (file, split) != key:
                if key is not None:
                    out.append((*key, *state))
                key, state = (file, split), (False, True, 0, -1, -1)
            done, size = state[2], part["bytes"].to_numpy()
            place = done + np.concatenate([[0], np.cumsum(size)[:-1]])
            ends, lasts = [], []
            for bit, last in zip(state[:2], state[3:]):
                inside, end = _begins(part["from_out"].to_numpy(bool), part["from_in"].to_numpy(bool), bit)
                at = np.flatnonzero(~inside)
                ends.append(end)
                lasts.append(int(place[at[-1]]) if len(at) else last)
            state = (*ends, done + int(size.sum()), *lasts)
        yield pd.DataFrame(out, columns=columns)
    if key is not None:
        yield pd.DataFrame([(*key, *state)], columns=columns)


def _fold(file: pd.DataFrame) -> pd.DataFrame:
    """The splits of one file in order: bit and offset before each, offset of the record it begins in."""
    inside, offset, open_at, out = False, 0, 0, []
    for s in file.sort_values("split").itertuples(index=False):
        out.append((s.file, s.split, inside, offset, open_at))
        last = s.last_in if inside else s.last_out
        open_at = offset + last if last >= 0 else open_at
        inside = bool(s.end_in if inside else s.end_out)
        offset += s.bytes
    if inside:
        raise ValueError(f"quotes are not closed at the end of {out[0][0]}")
    return pd.DataFrame(out, columns=["file", "split", "inside", "offset", "open_at"])


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records as (file, offset, split, whole, text).  ``held`` is the record
    that is open: its offset, the split it is in and its lines so far."""
    key, before, bit, offset = None, -1, False, 0
    at, lines = 0, []

    def flushed(whole: bool) -> list[tuple]:
        return [(key[0], at, key[1], whole, "\n".join(lines))] if lines else []

    started = True  # the open record began in this split
    for batch in batches:
        out = []
        for file, split, part in _runs(batch):
            if (file, split) != key:
                if key is not None:
                    out += flushed(started and not bit)
                key, bit, offset = (file, split), bool(part["inside"].iloc[0]), int(part["offset"].iloc[0])
                at, lines, started = int(part["open_at"].iloc[0]), [], not bit
            number = part["n"].to_numpy()
            if number[0] <= before or (np.diff(number) <= 0).any():
                raise RuntimeError("lines came out of order")
            before = int(number[-1])
            inside, bit = _begins(part["from_out"].to_numpy(bool), part["from_in"].to_numpy(bool), bit)
            place = offset + np.concatenate([[0], np.cumsum(part["bytes"].to_numpy())])
            offset = int(place[-1])
            for text, continues, where in zip(part["line"], inside.tolist(), place.tolist()):
                if continues:
                    lines.append(text)
                    continue
                out += flushed(started)
                at, lines, started = where, [text], True
        yield pd.DataFrame(out, columns=["file", "offset", "split", "whole", "text"])
    if key is not None:
        yield pd.DataFrame(flushed(started and not bit), columns=["file", "offset", "split", "whole", "text"])


def csv_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``(record_id, header, record)``: every record of the files, blank ones
    left out; ``record_id`` is the file's number (by path) and the record's
    byte offset.  The records are written once to the shared folder."""
    ship_package(spark)
    lines = _lines(spark, path, sep)
    summary = lines.select("file", "split", "from_out", "from_in", "bytes").mapInPandas(
        _summaries, "file string, split bigint, end_out boolean, end_in boolean, bytes bigint, last_out bigint, last_in bigint")
    # One row for each split: less than the plan of the scan itself holds.
    starts = materialize(summary.groupBy("file").applyInPandas(
        _fold, "file string, split bigint, inside boolean, offset bigint, open_at bigint"))
    cut = materialize(lines.join(F.broadcast(starts), ["file", "split"]).select(
        "file", "split", "n", "line", "from_out", "from_in", "bytes", "inside", "offset", "open_at").mapInPandas(
        _cut, "file string, offset bigint, split bigint, whole boolean, text string"))
    parts = cut.where(~F.col("whole")).groupBy("file", "offset").agg(
        F.array_sort(F.collect_list(F.struct("split", "text"))).alias("_p"))
    joined = parts.select("file", "offset", F.array_join(F.transform("_p", lambda p: p["text"]), "\n").alias("text"))
    records = cut.where("whole").select("file", "offset", "text").unionByName(joined)
    files = starts.select("file").distinct().withColumn("_f", F.row_number().over(Window.orderBy("file")) - 1)
    place = F.shiftleft(F.col("_f").cast("bigint"), OFFSET_BITS) + F.col("offset")
    return records.join(F.broadcast(files), "file").select(
        place.alias("record_id"), (F.col("offset") == 0).alias("header"),
        F.regexp_replace("text", "\r$", "").alias("record")).where("record != ''")


def read_csv(spark: SparkSession, path: str, sep: str = ",",
             na_values: tuple[str, ...] | None = None) -> tuple[DataFrame, list[str]]:
    """A CSV file or folder of files with headers: rows ``(record_id, cells)``,
    the cells a struct of strings by column, and the columns.  An empty cell
    is null; so are cells in ``na_values``, quoted or not."""
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    columns = spark.read.options(header=True, inferSchema=False, **options).csv(path).columns
    if not columns:
        return spark.createDataFrame([], "record_id bigint, cells struct<>"), []
    schema = ", ".join("`" + c.replace("`", "``") + "` string" for c in columns)
    rows = csv_records(spark, path, sep).where(~F.col("header")).select(
        "record_id", F.from_csv("record", schema, options).alias("cells"))
    if na_values is not None:
        cell = lambda c: F.col("cells").getField(c)
        rows = rows.withColumn("cells", F.struct(*[F.when(~cell(c).isin(*na_values), cell(c)).alias(c) for c in columns]))
    return rows, columns
