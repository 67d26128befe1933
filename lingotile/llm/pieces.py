"""SentencePiece-type BPE through a prefix table.

In BPE every prefix of a string has one last token.  The tokens ending at a
position come from an Aho-Corasick automaton over the vocabulary; the last
token of the prefix is the one whose predecessor (the last token of the
shorter prefix) is compatible with it, i.e. the two would stand side by side
unmerged.  Walking the table back from the end gives the ids.

Two facts of the model file shorten the work and are checked on loading: no
piece holds the space mark after another character, so a text is the
concatenation of its marked words and words are encoded once per worker
while they stay in a bounded cache; and pieces made of space marks only rank
below all others, so a run of marks is merged after its word.

Null texts count as empty.  Characters without a piece become byte pieces.
Texts are encoded whole, however long; repeated rows are encoded each; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import struct

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"
CACHE_WORDS = 1_000_000      # words kept per worker; a full cache is emptied
CACHE_WORD_LENGTH = 64     # longer words are encoded without being kept
CACHE_PAIRS = 600_000      # pair tests kept per worker; a full table is emptied
CACHE_RUN_LENGTH = 1000    # longer runs of spaces are merged without being kept
_INF = float("inf")


class PieceModel:
    """Vocabulary, merge ranks and pair tests read from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("a  b") != f"{MARK}a{MARK}{MARK}b" or sp.normalize("ﬁ") != MARK + "ﬁ":
            raise ValueError("only identity normalization with a space prefix is supported")
        n = sp.get_piece_size()
        self.surface = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = {int(self.surface[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.hidden = {i for i in range(n) if sp.is_control(i)}
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.id = {self.surface[i]: i for i in plain}
        self.rank = {p: -sp.get_score(i) for p, i in self.id.items()}
        spaces = [p for p in self.id if not p.strip(MARK)]
        words = [p for p in self.id if p.strip(MARK)]
        if any(MARK in p[1:] for p in words) or any(c not in self.id for p in words for c in p):
            raise ValueError("a piece crosses a word boundary or has a character without a piece")
        top = max((self.rank[p] for p in words), default=0)
        if any(self.rank[p] <= top for p in spaces if len(p) > 1):
            raise ValueError("runs of spaces must merge last")
        # Right and left edges of each reachable piece: its parts along the
        # edge from one character up, each with the rank that makes it.
        self.split: dict[str, tuple[str, str]] = {}
        self.usable = {}
        for p in words:
            if len(p) == 1 or self._reachable(p):
                self.usable[p] = self.id[p]
        if any(self.rank[q] >= self.rank[p] for p, parts in self.split.items() for q in parts if len(q) > 1):
            raise ValueError("merges must come in rank order")
        self.automaton = ahocorasick.Automaton()
        for p in (*self.usable, MARK):
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.runs: dict[int, list[int]] = {}
        self.spine: dict[tuple[str, int], list[tuple[str, float]]] = {}

    def merge(self, text: str, words_only: bool = True) -> list[str]:
        """Plain merging, best rank first, leftmost among equals.  Used on
        loading and for runs of space marks."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            p = parts[i] + parts[j]
            if (r := self.rank.get(p)) is not None and not (words_only and not p.strip(MARK)):
                heapq.heappush(heap, (r, i, j, p))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, p = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != p:
                continue
            self.last_split = (parts[i], parts[j])
            parts[i], parts[j], after[i] = p, None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def _reachable(self, piece: str) -> bool:
        if self.merge(piece) != [piece]:
            return False
        self.split[piece] = self.last_split
        return True

    def edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """``piece``'s parts on its left (0) or right (1) edge, smallest
        first, each with the rank of the merge that consumes it."""
        if (found := self.spine.get((piece, side))) is None:
            found, consumed, p = [], _INF, piece
            while True:
                found.append((p, consumed))
                if len(p) == 1:
                    break
                consumed, p = self.rank[p], self.split[p][side]
            found.reverse()
            self.spine[piece, side] = found
        return found

    def compatible(self, a: str, b: str) -> bool:
        """Whether ``a`` followed by ``b`` stay unmerged: replays in rank order
        what happens at their border while both are built up."""
        if (known := self.pairs.get((a, b))) is not None:
            return known
        left, right, i, j, rank = self.edge(a, 1), self.edge(b, 0), 0, 0, self.rank
        while True:
            (x, px), (y, py) = left[i], right[j]
            both = x + y
            m = rank.get(both, _INF) if both.strip(MARK) else _INF
            if m < px and m <= py:
                ok = False
                break
            if px == _INF and py == _INF:
                ok = True
                break
            if px <= py:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = ok
        return ok

    def pieces(self, word: str) -> list[str]:
        """Pieces of one marked word (a character without a piece stands alone)."""
        last: list[str | None] = [None] * (len(word) + 1)  # last[i]: last piece of word[:i]
        at_end: dict[int, list[str]] = {}
        for end, p in self.automaton.iter(word):
            at_end.setdefault(end + 1, []).append(p)
        for i in range(1, len(word) + 1):
            for p in at_end.get(i, ()):
                start = i - len(p)
                prev = last[start]
                if start == 0 or prev is not None and (prev not in self.usable and prev != MARK
                                                       or self.compatible(prev, p)):
                    last[i] = p
                    break
            else:
                # No token ends here compatibly: possible for unknown characters only.
                last[i] = word[i - 1] if i not in at_end else None
        out, i = [], len(word)
        while i:
            out.append(last[i])
            i -= len(last[i])
        out.reverse()
        return out

    def word_ids(self, word: str) -> list[int]:
        ids = []
        for p in self.pieces(word):
            if p in self.id:
                ids.append(self.id[p])
            else:
                ids.extend(self.bytes[b] for b in p.encode("utf-8", "replace"))
        return ids

    def run_ids(self, n: int) -> list[int]:
        """Ids of ``n`` space marks that no word has taken."""
        if (ids := self.runs.get(n)) is None:
            ids = [self.id[p] for p in self.merge(MARK * n, words_only=False)]
            if n <= CACHE_RUN_LENGTH:
                self.runs[n] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """Surface text of ids, space marks as spaces; byte pieces are joined."""
        out: list[str] = []
        for is_byte, group in itertools.groupby(ids, self.byte_of.__contains__):
            if is_byte:
                out.append(bytes(self.byte_of[i] for i in group).decode("utf-8", "replace"))
            else:
                out.extend(self.surface[i] for i in group if i not in self.hidden)
        return "".join(out).replace(MARK, " ")


class Codec:
    """Whole-text coding with a bounded cache of words."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.cache: dict[str, tuple[bytes, str]] = {}

    def _word(self, rest: str) -> tuple[bytes, str]:
        """(little-endian ids, decoded text) of the marked word ``MARK + rest``."""
        ids = self.model.word_ids(MARK + rest)
        made = struct.pack(f"<{len(ids)}I", *ids), self.model.decode(ids)
        if len(rest) <= CACHE_WORD_LENGTH:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[rest] = made
        return made

    def _run(self, n: int) -> tuple[bytes, str]:
        ids = self.model.run_ids(n)
        return struct.pack(f"<{len(ids)}I", *ids), self.model.decode(ids)

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids as bytes, decoded text) with begin and end ids."""
        model, cache = self.model, self.cache
        begin, end = struct.pack("<I", model.bos), struct.pack("<I", model.eos)
        if not text:
            return begin + end, ""
        rests = text.replace(" ", MARK).split(MARK)
        if "" not in rests:
            made = [cache.get(r) or self._word(r) for r in rests]
        else:
            made, marks, single = [], 0, struct.pack("<I", model.id[MARK])
            for r in rests:
                marks += 1
                if not r:
                    continue
                ids, surface = cache.get(r) or self._word(r)
                if marks > 1:
                    if ids.startswith(single):  # the word left its mark alone
                        made.append(self._run(marks))
                        ids, surface = ids[4:], surface[1:]
                    else:
                        made.append(self._run(marks - 1))
                made.append((ids, surface))
                marks = 0
            if marks:
                made.append(self._run(marks))
        # The first space is the prefix that encoding put there.
        return begin + b"".join([m[0] for m in made]) + end, "".join([m[1] for m in made])[1:]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process and model file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(text: Column, path: str) -> Column:
    """Array of ids of a text column, begin and end ids included."""
    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        c = codec(path)
        return texts.map(lambda t: list(struct.iter_unpack("<I", c.encode(t)[0]))).map(lambda r: [x[0] for x in r])

    return run(text)


def decoded(ids: Column, path: str) -> Column:
    """Text of an id array column (prefix space dropped)."""
    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        m = codec(path).model

        def one(x) -> str:
            out = m.decode([int(i) for i in x]) if x is not None else ""
            return out[1:] if out.startswith(" ") else out

        return lists.map(one)

    return run(ids)


def digests(text: Column, path: str) -> Column:
    """Struct ``(n_tokens, ids_sha256, decoded_sha256)`` of a text column."""
    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        c, rows = codec(path), []
        for t in texts:
            ids, back = c.encode(t)
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                         hashlib.sha256(back.encode("utf-8")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(text)
