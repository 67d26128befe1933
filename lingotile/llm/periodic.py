"""Periodic runs of words: seeds on diagonals, extended once each.

A run is a maximal stretch of words with smallest period ``q``, at least
``LEAST`` words and ``POWER`` periods long.  Words ``q`` apart agree over
``max(LEAST - q, (POWER - 1) * q)`` positions at least, so two equal k-grams
lie ``q`` apart for every k up to that.  Lags fall into classes, 1 to 16 and
then one for each doubling, and each class has an index of k-grams of its
least guaranteed overlap.  As that k is no less than the class's longest lag,
no further occurrence of the k-gram lies between two that belong to a run one
period apart: neighbouring occurrences are all pairs that are needed, so a
k-gram that occurs m times gives m - 1 pairs, never m squared.

A pair (i, i + lag) is extended to both sides word by word.  For each lag a
table holds how far that diagonal is covered; pairs behind that mark are
skipped, so a diagonal's stretch is walked once.  Lags found this way are
smallest periods, since a shorter one would have put a nearer occurrence.

Each text is searched whole, in time near n log n, whatever its words.  Null,
blank and empty texts have no words and no runs; a null document id is left
as it is by the damage.  Rows are independent: repeated rows repeat, an empty
table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, POWER = 24, 3
NARROW = 16  # longest lag of the first class
STEP = 256  # words compared at once while a pair is extended


def guaranteed(low: int, high: int) -> int:
    """Least overlap of a run with itself one period on, over lags ``low..high``."""
    return min(max(LEAST - q, (POWER - 1) * q) for q in {low, high, min(max(low, LEAST // POWER), high)})


def lag_classes(n: int) -> list[tuple[int, int, int]]:
    """``(lowest lag, highest lag, k)`` of every class that a text of ``n`` words can hold a run of."""
    found, low, high = [], 1, NARROW
    while POWER * low <= n:
        found.append((low, high, guaranteed(low, high)))
        low, high = high + 1, 2 * high
    return found


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal pairs get equal numbers below their count: exact, no hashing."""
    return np.unique(left * np.int64(len(left) + int(right.max(initial=0)) + 1) + right, return_inverse=True)[1].astype(np.int64)


class Grams:
    """Names of the k-grams of one text, by doubling; equal names mean equal grams."""

    def __init__(self, ids: np.ndarray):
        self.width, self.names = 1, ids.astype(np.int64)

    def of(self, k: int) -> np.ndarray:
        """``k`` must not shrink from call to call."""
        while 2 * self.width <= k:
            w = self.width
            self.names = _named(self.names[:-w], self.names[w:]) if len(self.names) > w else self.names[:0]
            self.width = 2 * w
        shift = k - self.width
        if not shift:
            return self.names
        return _named(self.names[:-shift], self.names[shift:]) if len(self.names) > shift else self.names[:0]


def neighbours(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position, lag)`` of each occurrence and the next one of the same gram."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    at = order[:-1][same]
    return at, order[1:][same] - at


def _reach(ids: np.ndarray, i: int, lag: int, step: int) -> int:
    """Words from ``i`` on (``step`` 1) or before it (-1) that agree with those ``lag`` further."""
    done, room = 0, (len(ids) - lag - i if step > 0 else i)
    while done < room:
        m = min(STEP, room - done)
        a = i + done if step > 0 else i - done - m
        same = ids[a:a + m] == ids[a + lag:a + lag + m]
        if not same.all():
            return done + (int(np.argmin(same)) if step > 0 else m - 1 - int(np.flatnonzero(~same)[-1]))
        done += m
    return done


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a list of words, by start, then period."""
    n = len(words)
    if n < LEAST:
        return []
    # A text without any repeated k-gram of the first class has no run: equal
    # grams have equal hashes, so none is missed here.
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    k = guaranteed(1, NARROW)
    for w in (1, 2, 4, 8):
        h = h[:-w] * np.uint64(0x9E3779B97F4A7C15) + (h[w:] ^ (h[w:] >> np.uint64(29)))
    assert k == NARROW
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    grams, runs = Grams(ids), []
    for low, high, k in lag_classes(n):
        at, lag = neighbours(grams.of(k))
        if not len(at):
            break  # no gram of this length repeats, so no longer one does
        mine = (lag >= low) & (lag <= high)
        at, lag = at[mine], lag[mine]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        edges = np.flatnonzero(np.append(lag[1:] != lag[:-1], True)) + 1 if len(lag) else []
        first = 0
        for end in edges:  # one lag
            q, seeds, covered, j = int(lag[first]), at[first:end], -1, 0
            while j < len(seeds):
                i = int(seeds[j])
                start = i - _reach(ids, i, q, -1)
                covered = i + k + _reach(ids, i + k, q, 1)
                length = covered - start + q
                if length >= max(LEAST, POWER * q):
                    runs.append((start, length, q))
                j += int(np.searchsorted(seeds[j:], covered))  # seeds behind the mark lie on the walked stretch
            first = end
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when of each run only the first period does."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def damaged(words: list, doc_id: int | None) -> list:
    """The planted damage: one text in ten gets a periodic tail, its place,
    period and share fixed by the id's CRC-32."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def collapse(text: Column) -> Column:
    """The text column's words joined by one space, of each run only the first period; null stays null."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            words = split_words(text)
            kept = kept_words(len(words), find_runs(words))
            return None if text is None else b" ".join(w for w, k in zip(words, kept) if k).decode("utf-8", "replace")

        return texts.map(one)

    return run(text)


RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def runs_of(text: Column) -> Column:
    """Every run of a text column's words; empty for null."""
    @F.pandas_udf(RUN)
    def run(texts: pd.Series) -> pd.Series:
        names = ("start", "length", "period")
        return pd.Series([[dict(zip(names, r)) for r in find_runs(split_words(t))] for t in texts])

    return run(text)


def _row(doc_id: int | None, text: str | None) -> tuple:
    words = damaged(split_words(text), doc_id)
    runs = find_runs(words)
    best = None
    for r in runs:  # by start, then period: the first of equals stays
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = kept_words(len(words), runs)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    collapsed = b" ".join(words if not runs else [w for w, k in zip(words, kept) if k])
    return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def report(docs: DataFrame) -> DataFrame:
    """Per document, after the planted damage: its runs' count, the one of the
    greatest exponent (ties: smallest start, then period; nulls without runs)
    and digests of all runs and of the collapsed text."""
    schema = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'bigint'}" for c in COLUMNS)

    @F.pandas_udf(schema)
    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [_row(None if i is None else int(i), t) for i, t in zip(ids, texts)]
        made = pd.DataFrame(rows, columns=COLUMNS)
        return made.astype({c: "Int64" for c in COLUMNS[:5]})

    decimal = F.col("doc_id").cast("string")  # as text: a batch with a null would turn numbers into floats
    return docs.select("doc_id", run(decimal, F.col("text")).alias("_r")).select("doc_id", "_r.*")
