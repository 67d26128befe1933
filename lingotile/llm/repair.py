"""Conversation structure repair: cheapest edits, least audit by prefix doubling.

Role initials of a repaired conversation read ``(s?(ua)+)?``.  Edits are Keep
(0), Rerole to user or assistant (2), Delete (3, required for blank and
repeated rows) and Insert of an empty user or assistant row (2); a truncated
row that stays adds 1.  An audit is the string of the edits' initials.

Nodes are (row, state of the pattern); the states are 0 (nothing yet), S
(after s), U (after u) and A (after a).  A backward DP gives each node its
cost to go; arcs that keep to it are the optimal ones.  Arcs of one node bear
different letters (where Rerole and Insert lead is fixed by the state, where
Keep leads by the row), so a node's least audit begins with its least letter.
Nodes are ranked by the first letter of their least audits, then by two, four,
eight letters: a rank of twice the length is the pair of a node's rank and the
rank of the node that its pointer reaches, and pointers double along.  The
ranks choose among arcs, the doubled pointers spell the least path out at all
its positions at once.

Rows of any number of conversations are dealt by a range over (conversation,
turn, ...), so a conversation of any size is shared among tasks, and cut into
pieces of at most ``PIECE`` rows; a piece holds one letter a row.  A piece's
costs between its two ends are a 4 x 4 (min, +) matrix.  Those of a
conversation are chained (16 numbers a piece) into costs to go behind every
piece; then each piece finds its least path from each state alone.  Only the
digest of a repaired conversation is sequential by its nature: its rows
stream once through one task, which holds one row at a time.

Defined results: null roles and texts are one space; rows come by turn (nulls
first), ties by role, the text's first 64 characters, its digest; a null
conversation id is a conversation of its own; repeated rows are rows (their
later copies duplicates); an empty table gives an empty result; other columns
are not read.  "Seen earlier" compares SHA-256 of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize

SPACES = "\t\n\x0b\x0c\r "
PIECE_BITS = 16
PIECE = 1 << PIECE_BITS  # rows of a piece at most, and rows ranked at once
START, S, U, A = range(4)
ACCEPTED = (START, A)
INITIALS = "sua"
AFTER = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
MADE = {START: U, S: U, U: A, A: U}  # where Rerole and Insert lead
ROLE = {U: "user", A: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = "DIKR"  # in ASCII order
CLEAN, CUT, BLANK, REPEATED = range(4)
NEVER = 1 << 40


def code(initial: Column, fault: Column) -> Column:
    """One letter a row: its fault and which of s, u, a (or none) its role begins with."""
    i = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char((F.lit(97) + 4 * fault + i).cast("bigint"))


class Table:
    """Backward steps of the cost DP, kept by (letter, costs less their least):
    few differ, since Inserts lead from any state to any later one."""

    def __init__(self):
        self.known: dict = {}
        self.end = self._closed([0 if s in ACCEPTED else NEVER for s in range(4)], [[] for _ in range(4)])

    @staticmethod
    def _closed(v: list[int], arcs: list[list]) -> tuple:
        """Adds Inserts; arcs are (cost, letter, rows consumed, state)."""
        for _ in range(3):
            v = [min(v[s], INSERT + v[MADE[s]]) for s in range(4)]
        for s in range(4):
            arcs[s].append((INSERT + v[MADE[s]], "I", 0, MADE[s]))
        return tuple(x if x < NEVER // 2 else NEVER for x in v), arcs

    def step(self, letter: str, after: tuple) -> tuple[tuple, int, list]:
        """``(costs, their least, optimal arcs by state)`` before a row."""
        key = letter, after
        if key not in self.known:
            fault, initial = divmod(ord(letter) - 97, 4)
            arcs: list[list] = [[(DELETE + after[s], "D", 1, s)] for s in range(4)]
            if fault in (CLEAN, CUT):
                more = TRUNCATED if fault == CUT else 0
                for s in range(4):
                    arcs[s].append((REROLE + more + after[MADE[s]], "R", 1, MADE[s]))
                    t = AFTER[s].get(INITIALS[initial]) if initial < 3 else None
                    if t is not None:
                        arcs[s].append((KEEP + more + after[t], "K", 1, t))
            v, arcs = self._closed([min(a[0] for a in x) for x in arcs], arcs)
            best = [[(LETTERS.index(x[1]) + 1, x[2], x[3]) for x in arcs[s] if x[0] == v[s] < NEVER] for s in range(4)]
            least = min(v)
            self.known[key] = tuple(x - least if x < NEVER else NEVER for x in v), least, best
        return self.known[key]


def matrix(codes: str, table: Table) -> list[int]:
    """Least cost from each state before a piece to each state behind its last row, row by row."""
    columns = []
    for t in range(4):
        v, total = tuple(0 if s == t else NEVER for s in range(4)), 0
        for letter in reversed(codes):
            v, least, _ = table.step(letter, v)
            total += least
        columns.append([min(x + total, NEVER) for x in v])
    return [columns[t][s] for s in range(4) for t in range(4)]


def chained(pieces: list[list[int]]) -> tuple[int, int, list[list[int]]]:
    """From a conversation's pieces in order (number, first and last role, 16
    costs): its cost, the illegal pairs between pieces, and for every piece
    (number, first?, last?, 4 costs to go behind it)."""
    after, out = list(Table().end[0]), []
    for k in range(len(pieces) - 1, -1, -1):
        number, m = int(pieces[k][0]), pieces[k][3:]
        out.append([number, int(k == 0), int(k == len(pieces) - 1), *after])
        after = [int(min(min(m[4 * s + t] + after[t] for t in range(4)), NEVER)) for s in range(4)]
    between = sum(not legal(p[2], q[1]) for p, q in zip(pieces, pieces[1:]))
    return after[START], between, out[::-1]


def legal(before: int, initial: int) -> bool:
    """Whether role initials su, ua or au follow each other (as their numbers in ``INITIALS``)."""
    return (before, initial) in ((0, 1), (1, 2), (2, 1))


def ranked(first: np.ndarray, pointer: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """``(rank of each node's whole audit, pointers of 1, 2, 4 ... letters,
    letters of the audit)`` of nodes with a first letter and the node behind it."""
    rank, length, jumps = first.astype(np.int64), (~ends).astype(np.int64), [pointer]
    while not ends[pointer].all():
        rank = np.unique(rank * np.int64(len(rank) + len(LETTERS) + 1) + rank[pointer], return_inverse=True)[1]
        length = length + length[pointer]
        pointer = pointer[pointer]
        jumps.append(pointer)
    return rank, jumps, length


def least_paths(codes: list[str], starts: list[bool], lasts: list[bool], after: list[list[int]],
                table: Table) -> list[tuple[list[str], list[int]]]:
    """For each piece its least audit from each state before it (the first
    piece: from state 0 alone) and the state that each leads to."""
    base = np.cumsum([0, *(4 * (len(c) + 1) for c in codes)])
    size = int(base[-1])
    letter = np.full((size, len(LETTERS)), len(LETTERS) + 1, np.int64)  # of each optimal arc
    target = np.tile(np.arange(size)[:, None], (1, len(LETTERS)))
    ends = np.zeros(size, bool)
    for c, last, behind, b in zip(codes, lasts, after, base):
        end = int(b) + 4 * len(c)
        if last:
            v, arcs = table.end
            ends[[end + s for s in ACCEPTED]] = True
            for s in range(4):
                if s not in ACCEPTED:
                    letter[end + s, 1], target[end + s, 1] = LETTERS.index("I") + 1, end + MADE[s]
        else:
            v = tuple(int(x) for x in behind)
            ends[end:end + 4] = True
        v = tuple(x - min(v) for x in v)
        for i in range(len(c) - 1, -1, -1):
            v, _, best = table.step(c[i], v)
            at = int(b) + 4 * i
            for s in range(4):
                for n, (x, rows, t) in enumerate(best[s]):
                    letter[at + s, n], target[at + s, n] = x, at + 4 * rows + t
    # Level 0: the letter of each arc; the least one's node is the pointer.
    pick = letter.argmin(axis=1)
    nodes = np.arange(size)
    first, pointer = np.where(ends, 0, letter[nodes, pick]), np.where(ends, nodes, target[nodes, pick])
    rank, jumps, length = ranked(first, pointer, ends)
    # The full ranks must choose the same arcs: letters of one node differ.
    again = (letter * np.int64(size + len(LETTERS) + 1) + rank[target]).argmin(axis=1)
    pointer = np.where(ends, nodes, target[nodes, again])
    assert (pointer == jumps[0]).all()
    entry = np.concatenate([b + np.arange(1 if first_piece else 4) for b, first_piece in zip(base[:-1], starts)])
    count = length[entry]
    offset = np.cumsum(np.append(0, count))
    step = np.arange(int(offset[-1])) - np.repeat(offset[:-1], count)
    at = np.repeat(entry, count)
    for k, jump in enumerate(jumps):
        at = np.where((step >> k) & 1, jump[at], at)
    text = np.frombuffer(b"\0" + LETTERS.encode(), np.uint8)[first[at]].tobytes().decode()
    leads = (jumps[-1][entry] % 4).tolist()
    out, j = [], 0
    for is_first in starts:
        n = 1 if is_first else 4
        out.append(([text[offset[x]:offset[x + 1]] for x in range(j, j + n)], leads[j:j + n]))
        j += n
    return out


def _summary(codes: Column) -> Column:
    """Per piece: counts of faults, illegal pairs, first and last role, cost matrix."""
    @F.pandas_udf("blank bigint, duplicate bigint, truncated bigint, illegal bigint, ends array<bigint>")
    def run(pieces: pd.Series) -> pd.DataFrame:
        table, rows = Table(), []
        for c in pieces:
            x = np.frombuffer(c.encode(), np.uint8) - 97
            fault, role = x // 4, (x % 4).tolist()
            rows.append((int((fault == BLANK).sum()), int((fault == REPEATED).sum()), int((fault == CUT).sum()),
                         sum(not legal(p, q) for p, q in zip(role, role[1:])),
                         [role[0], role[-1], *matrix(c, table)]))
        return pd.DataFrame(rows, columns=["blank", "duplicate", "truncated", "illegal", "ends"])

    return run(codes)


def _chain(ends: Column) -> Column:
    @F.pandas_udf("cost bigint, between bigint, pieces array<array<bigint>>")
    def run(conversations: pd.Series) -> pd.DataFrame:
        rows = [chained([[int(x) for x in p] for p in pieces]) for pieces in conversations]
        return pd.DataFrame(rows, columns=["cost", "between", "pieces"])

    return run(ends)


def _paths(codes: Column, piece: Column) -> Column:
    @F.pandas_udf("audits array<string>, leads array<bigint>")
    def run(codes: pd.Series, piece: pd.Series) -> pd.DataFrame:
        table, rows, lo = Table(), [], 0
        while lo < len(codes):
            hi, held = lo, 0
            while hi < len(codes) and (hi == lo or held + len(codes[hi]) <= PIECE):
                held += len(codes[hi])
                hi += 1
            chosen = [[int(x) for x in p] for p in piece[lo:hi]]
            rows += least_paths(list(codes[lo:hi]), [p[1] == 1 for p in chosen], [p[2] == 1 for p in chosen],
                                [p[3:] for p in chosen], table)
            lo = hi
        return pd.DataFrame(rows, columns=["audits", "leads"])

    return run(codes, piece)


def rows_of(conversations: DataFrame) -> DataFrame:
    """``_c`` (the id as text), turn, role, text; null roles and texts are one space."""
    c = conversations
    return c.select(c["conv_id"].cast("string").alias("_c"), c["turn"].alias("turn"),
                    F.coalesce(c["role"], F.lit(" ")).alias("role"), F.coalesce(c["text"], F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """The planted damage, by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes
    its role user."""
    key = F.concat(F.coalesce("_c", F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = rows.withColumn("_d", F.crc32(key.cast("binary")) % 20).where("_d <> 0")
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return d.select("_c", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_x")).drop("_x")


class Repair:
    """The repair of ``rows`` (``_c``, turn, role, text): tables made once."""

    def __init__(self, rows: DataFrame):
        digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
        keyed = rows.select("*", digest.alias("_d"), F.substring("text", 1, 64).alias("_t"),
                            F.monotonically_increasing_id().alias("_n"))
        order = ["_c", "turn", "role", "_t", "_d", "_n"]
        dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        number = F.monotonically_increasing_id()
        self.rows = materialize(dealt.select("_c", "turn", "role", "text", "_d", number.alias("_m")), "repair-rows")
        trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
        light = self.rows.select(
            "_c", "_m", "_d", F.substring("role", 1, 1).alias("_i"),
            F.when(trimmed == "", BLANK).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), CLEAN).otherwise(CUT).alias("_f"))
        # A row repeats an earlier one unless it is the first of its kind: the
        # firsts are counted by kind, then met by row number, which no key repeats.
        firsts = light.where(F.col("_f") != BLANK).groupBy("_c", "_d").agg(F.min("_m").alias("_m")).select("_m", F.lit(True).alias("_first"))
        fault = F.when((F.col("_f") != BLANK) & F.col("_first").isNull(), REPEATED).otherwise(F.col("_f"))
        coded = light.join(firsts, "_m", "left").select(
            "_c", "_m", F.shiftright("_m", PIECE_BITS).alias("_p"), code(F.col("_i"), fault).alias("_l"))
        letters = F.transform(F.array_sort(F.collect_list(F.struct("_m", "_l"))), lambda x: x["_l"])
        pieces = coded.groupBy("_c", "_p").agg(F.array_join(letters, "").alias("codes"))
        self.pieces = materialize(pieces, "repair-pieces")
        summed = self.pieces.select("_c", "_p", _summary(F.col("codes")).alias("_s")).select("_c", "_p", "_s.*")
        chain = summed.groupBy("_c").agg(
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
            F.array_sort(F.collect_list(F.concat(F.array("_p"), "ends"))).alias("_e"))
        chain = chain.withColumn("_r", _chain(F.col("_e")))
        self.chain = materialize(chain.select(
            "_c", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("_r.between")).alias("illegal"),
            F.col("_r.cost").alias("cost"), F.col("_r.pieces").alias("pieces")), "repair-chain")

    def counts(self) -> DataFrame:
        """``_c, blank, duplicate, truncated, illegal, cost`` and gaps of every conversation with rows."""
        turns = self.rows.select("_c", "turn").distinct().groupBy("_c").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
        return self.chain.drop("pieces").join(
            turns.withColumnRenamed("_c", "_g"), F.col("_c").eqNullSafe(F.col("_g"))).drop("_g")

    def _stream(self) -> DataFrame:
        """Each conversation's rows in order, each piece's paths before its rows."""
        ends = self.chain.select(F.col("_c").alias("_g"), F.explode("pieces").alias("_e"))
        paths = self.pieces.join(ends, F.col("_c").eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_e")[0]))
        paths = paths.select("_c", "_p", _paths(F.col("codes"), F.col("_e")).alias("_r"))
        none = F.lit(None)
        events = paths.select("_c", "_p", none.cast("bigint").alias("_m"), none.cast("string").alias("role"),
                              none.cast("string").alias("text"), "_r.audits", "_r.leads")
        rows = self.rows.select("_c", F.shiftright("_m", PIECE_BITS).alias("_p"), "_m", "role", "text",
                                none.cast("array<string>").alias("audits"), none.cast("array<bigint>").alias("leads"))
        return (events.unionByName(rows).repartition("_c").sortWithinPartitions("_c", "_p", F.asc_nulls_first("_m"))
                .select("_c", "role", "text", "audits", "leads"))

    def messages(self) -> DataFrame:
        """The repaired conversations: ``_c, position, role, text, edit`` (Keep, Rerole or Insert)."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, at = [], (None, -1)
            for c, letter, role, text, done in replayed(batches):
                if done:
                    at = (None, -1)
                elif role is not None:
                    at = (c, at[1] + 1)
                    held.append((c, at[1], role, text, letter))
                    if len(held) >= 256:
                        yield pd.DataFrame(held, columns=["_c", "position", "role", "text", "edit"])
                        held = []
            yield pd.DataFrame(held, columns=["_c", "position", "role", "text", "edit"])

        return self._stream().mapInPandas(run, "_c string, position bigint, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """``_c, audit, repaired_sha256``: letters of all edits, digest of the repaired rows."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            made, audit, sha, lines = [], [], hashlib.sha256(), 0
            for c, letter, role, text, done in replayed(batches):
                if done:
                    made.append((c, "".join(audit), sha.hexdigest()))
                    audit, sha, lines = [], hashlib.sha256(), 0
                    if len(made) >= 1024:
                        yield pd.DataFrame(made, columns=["_c", "audit", "repaired_sha256"])
                        made = []
                    continue
                audit.append(letter)
                if role is not None:
                    sha.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    lines += 1
            yield pd.DataFrame(made, columns=["_c", "audit", "repaired_sha256"])

        return self._stream().mapInPandas(run, "_c string, audit string, repaired_sha256 string")


def replayed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """``(conversation, letter, role, text, end?)`` of every edit; a Delete has
    no role; after a conversation's last edit one item with ``end`` true."""
    now, state, lead, letters, at = None, START, START, "", 0
    open_ = False

    def inserts():
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            state, at = MADE[state], at + 1
            yield now, "I", ROLE[state], "", False

    for batch in batches:
        for c, role, text, audits, leads in zip(*(batch[x] for x in ("_c", "role", "text", "audits", "leads"))):
            if audits is not None:
                if open_ and (c is None) == (now is None) and c == now:
                    state = lead
                else:
                    if open_:
                        yield from inserts()
                        yield now, None, None, None, True
                    now, state, open_ = c, START, True
                letters, lead, at = audits[state], int(leads[state]), 0
                continue
            yield from inserts()
            letter, at = letters[at], at + 1
            if letter == "D":
                yield now, "D", None, None, False
                continue
            if letter == "K":
                state = AFTER[state][role[0]]
            else:
                state = MADE[state]
                role = ROLE[state]
            yield now, letter, role, text, False
    if open_:
        yield from inserts()
        yield now, None, None, None, True


def report(conversations: DataFrame) -> DataFrame:
    """Every original conversation after the planted damage: gaps, counts of
    first faults, illegal pairs, cost, audit and digest of the repair."""
    made = Repair(damaged(rows_of(conversations)))
    ids = conversations.select("conv_id").distinct().withColumn("_c", F.col("conv_id").cast("string"))
    out = ids
    for n, part in enumerate((made.counts(), made.digests())):
        out = out.join(part.withColumnRenamed("_c", f"_{n}"), F.col("_c").eqNullSafe(F.col(f"_{n}")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
