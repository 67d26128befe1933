"""Canonical decomposition with the nonspacing marks taken off, as a Column.

``unaccented`` equals, for every string of Unicode characters,

    "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")

The tables are made from ``unicodedata`` when the expression is built:

* characters whose decomposition leaves one character or none are one
  ``translate`` (marks themselves are deleted by it);
* Hangul syllables are taken apart by their arithmetic, the few other
  characters that leave several by a map, only in texts that hold one;
* the spacing marks that canonical ordering moves are put in order before the
  marks between them go, only in texts that hold one.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
LEADS, VOWELS, TAILS = 0x1100, 0x1161, 0x11A7       # first jamo of each kind (tail 0 is none)
N_LEADS, N_VOWELS, N_TAILS = 19, 21, 28


def stripped(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def _class(points) -> str:
    """A regular expression class of code points, as ranges."""
    spans: list[list[int]] = []
    for p in sorted(points):
        if spans and p == spans[-1][1] + 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" if b > a else rf"\x{{{a:x}}}" for a, b in spans)


@functools.cache
def _tables():
    single, gone, several, moved, marks = {}, [], {}, {}, []
    for p in range(0x80, sys.maxunicode + 1):
        if HANGUL_FIRST <= p <= HANGUL_LAST or 0xD800 <= p <= 0xDFFF:
            continue
        c = chr(p)
        left, order, mark = stripped(c), unicodedata.combining(c), unicodedata.category(c) == "Mn"
        if mark and order:
            marks.append(p)
        if order and not mark:
            moved.setdefault(order, []).append(p)
        if not left:
            gone.append(c)
        elif len(left) > 1:
            several[c] = left
        elif left != c:
            single[c] = left
    return single, gone, several, moved, marks


def _taken_apart(t: Column, several: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    hangul = rf"\x{{{HANGUL_FIRST:x}}}-\x{{{HANGUL_LAST:x}}}"
    alone = _class(map(ord, several))

    def jamo(first: int, n: int, k: Column) -> Column:
        return F.element_at(F.array(*[F.lit(chr(first + i)) for i in range(n)]), (k + 1).cast("int"))

    def apart(c: Column) -> Column:
        k = F.ascii(c) - HANGUL_FIRST
        tail = k % N_TAILS
        syllable = F.concat(jamo(LEADS, N_LEADS, F.floor(k / (N_VOWELS * N_TAILS))),
                            jamo(VOWELS, N_VOWELS, F.floor(k % (N_VOWELS * N_TAILS) / N_TAILS)),
                            F.when(tail == 0, F.lit("")).otherwise(jamo(TAILS, N_TAILS, tail)))
        return F.when(c.rlike(f"^[{hangul}]$"), syllable).otherwise(F.coalesce(F.element_at(known, c), c))

    parts = F.regexp_extract_all(t, F.lit(f"(?s)[{hangul}{alone}]|[^{hangul}{alone}]+"), F.lit(0))
    return F.when(t.rlike(f"[{hangul}{alone}]"), F.array_join(F.transform(parts, apart), "")).otherwise(t)


def _in_order(t: Column, moved: dict[int, list[int]], marks: list[int]) -> Column:
    every = _class(p for points in moved.values() for p in points)
    bare = F.regexp_replace(t, f"[{_class(marks)}]+", "")
    parts = F.regexp_extract_all(bare, F.lit(f"(?s)[{every}]+|[^{every}]+"), F.lit(0))

    def ordered(run: Column) -> Column:
        kept = [F.regexp_replace(run, f"[^{_class(moved[k])}]", "") for k in sorted(moved)]
        return F.when(run.rlike(f"^[{every}]"), F.concat(*kept)).otherwise(run)

    return F.when(t.rlike(f"[{every}]"), F.array_join(F.transform(parts, ordered), "")).otherwise(t)


def unaccented(text: Column | str) -> Column:
    """Canonical decomposition without nonspacing marks (null stays null)."""
    t = F.col(text) if isinstance(text, str) else text
    single, gone, several, moved, marks = _tables()
    whole = _in_order(_taken_apart(t, several), moved, marks)
    plain = F.translate(whole, "".join([*single, *gone]), "".join(single.values()))
    return F.when(t.rlike(r"[^\x{0}-\x{7f}]"), plain).otherwise(t)


def uncased(text: Column | str) -> Column:
    """Lower-cased and unaccented: the form an uncased vocabulary is made of."""
    t = F.col(text) if isinstance(text, str) else text
    return unaccented(F.lower(t))
