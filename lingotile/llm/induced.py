"""External induced suffix sorting with common-prefix values.

Suffixes ending a descent (S*) are sorted by recursion on their named
substrings; all others are induced from them.  Induction runs off a priority
queue whose order is (first symbol, arrival): popping the smallest suffix
pushes its left neighbour.  Keys only grow, so the queue is kept as one
region per symbol, filled in order of arrival.  Entries are popped in blocks:
the longest run of queue entries none of which is preceded by what an earlier
one of the block pushes.  A pushed suffix's common prefix with its
predecessor in the region is one more than the least common prefix popped
since that predecessor's push, so these values travel through the queue with
the suffixes.

Text, queue and values are disk-backed arrays above ``MEMORY_BYTES``, read
and written in blocks; the folder belongs to the task and goes with it.
"""

from __future__ import annotations

import shutil
import tempfile

import numpy as np

BLOCK = 1 << 15
MEMORY_BYTES = 64 << 20
NONE = np.iinfo(np.int64).max


class Store:
    """Arrays in memory while small, in a private folder of the task beyond."""

    def __init__(self, memory_bytes: int = MEMORY_BYTES):
        self.memory_bytes, self.folder, self.n = memory_bytes, None, 0

    def array(self, n: int, dtype, value: int = 0) -> np.ndarray:
        dtype = np.dtype(dtype)
        if n * dtype.itemsize <= self.memory_bytes:
            return np.full(n, value, dtype)
        self.folder = self.folder or tempfile.mkdtemp(prefix="induced-")
        self.n += 1
        out = np.memmap(f"{self.folder}/{self.n}", dtype, "w+", shape=n)
        if value:
            for i in range(0, n, BLOCK):
                out[i:i + BLOCK] = value
        return out

    def __enter__(self) -> "Store":
        return self

    def __exit__(self, *_) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


def suffix_types(text: np.ndarray, store: Store) -> np.ndarray:
    """1 for suffixes smaller than their right neighbour (S), 0 for larger (L).
    The last symbol is a unique smallest end mark."""
    n = len(text)
    out = store.array(n, np.uint8)
    out[n - 1] = after = 1
    for hi in range(n - 1, 0, -BLOCK):
        lo = max(0, hi - BLOCK)
        step = np.sign(text[lo + 1:hi + 1].astype(np.int64) - text[lo:hi])
        # An equal symbol takes the type of the next unequal pair to its right.
        step[::-1] = _carried(step[::-1], 1 if after else -1)
        out[lo:hi] = step > 0
        after = out[lo]
    return out


def _carried(values: np.ndarray, first: int) -> np.ndarray:
    """Zeros replaced by the last non-zero value before them."""
    at = np.maximum.accumulate(np.where(values != 0, np.arange(len(values)), -1))
    return np.where(at >= 0, values[np.maximum(at, 0)], first)


class LeastOf:
    """Minima over index ranges of one block."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of values[lo:hi] for non-empty ranges."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.rows[0].dtype)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.rows[k][lo[m]], self.rows[k][hi[m] - (1 << int(k))])
        return out


def _run(text: np.ndarray, at: int, cap: int) -> int:
    part = np.asarray(text[at:at + cap])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def induce(text, counts, seeds, seed_lcp, cap: int, store: Store):
    """The suffixes that ``counts`` counts by first symbol, sorted by
    induction from the sorted ``seeds``; with ``seed_lcp`` also each one's
    common prefix (at most ``cap``) with the one before it in its region."""
    start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    fill, total, n_seeds = start[:-1].copy(), int(start[-1]), len(seeds)
    out = store.array(total, np.int64, -1)
    with_lcp = seed_lcp is not None
    lcp = store.array(total, np.int16) if with_lcp else None
    carry = np.full(len(counts), cap, np.int16) if with_lcp else None
    i = j = 0
    block = BLOCK  # follows how many entries can be popped at once
    last = (-1, -1, False)  # symbol, position and kind of the last popped suffix
    while i < total or j < n_seeds:
        a, b = np.asarray(out[i:i + block]), np.asarray(seeds[j:j + block])
        a = a[a >= 0]
        ca, cb = text[a].astype(np.int64), text[b].astype(np.int64)
        limit = min(int(np.searchsorted(start, i + block, "right")) - 1 if i + block < total else NONE,
                    int(text[seeds[j + block]]) if j + block < n_seeds else NONE)
        if not len(a) and not len(b):
            break  # what is left cannot be reached (the end mark)
        c = min(int(ca[0]) if len(ca) else NONE, int(cb[0]) if len(cb) else NONE)
        if c >= limit:  # one symbol fills the block: its queue entries first, then its seeds
            na, nb = int(np.searchsorted(ca, c, "right")), 0
            if not na:
                nb = int(np.searchsorted(cb, c, "right"))
        else:
            na, nb = int(np.searchsorted(ca, limit)), int(np.searchsorted(cb, limit))
        order = np.argsort(np.concatenate([2 * ca[:na], 2 * cb[:nb] + 1]), kind="stable")
        pos = np.concatenate([a[:na], b[:nb]])[order]
        ch = np.concatenate([ca[:na], cb[:nb]])[order]
        seed = order >= na
        before = np.where(pos > 0, text[pos - 1].astype(np.int64), -1)
        push = np.where(seed, before > ch, before >= ch)
        target = np.where(push, before, NONE)
        least = np.concatenate([[NONE], np.minimum.accumulate(target)[:-1]])
        bad = np.flatnonzero(np.where(seed, ch >= least, ch > least))
        n = int(bad[0]) if len(bad) else len(pos)
        pos, ch, seed = pos[:n], ch[:n], seed[:n]
        from_seed = int(seed.sum())
        at = np.flatnonzero(push[:n])
        x = target[at]
        by = np.argsort(x, kind="stable")
        x, at = x[by], at[by]
        if len(x):
            first = np.flatnonzero(np.diff(x, prepend=-1))
            size = np.diff(np.append(first, len(x)))
            slot = fill[x] + np.arange(len(x)) - np.repeat(first, size)
            out[slot] = pos[at] - 1
        if with_lcp:
            d = np.empty(n, np.int16)
            d[~seed] = lcp[i:i + n - from_seed]
            d[seed] = seed_lcp[j:j + from_seed]
            opens = seed & (np.concatenate([[last[0]], ch[:-1]]) == ch) & ~np.concatenate([[last[2]], seed[:-1]])
            fresh = seed & (np.concatenate([[last[0]], ch[:-1]]) != ch)
            d[fresh] = 0
            for t in np.flatnonzero(opens):
                p = int(pos[t - 1]) if t else last[1]
                d[t] = min(_run(text, p, cap), _run(text, int(pos[t]), cap))
            prefix = np.minimum.accumulate(d)
            if len(x):
                least_of = LeastOf(d)
                value = np.minimum(carry[x], prefix[at])
                inner = np.setdiff1d(np.arange(len(x)), first, assume_unique=True)
                value[inner] = least_of(at[inner - 1] + 1, at[inner] + 1)
                lcp[slot] = np.where(slot == start[x], 0, np.minimum(value + 1, cap))
            carry = np.minimum(carry, prefix[-1])
            if len(x):
                ends = at[first + size - 1]
                rest = np.full(len(ends), cap, np.int16)
                some = ends + 1 < n
                rest[some] = least_of(ends[some] + 1, np.full(int(some.sum()), n))
                carry[x[first]] = rest
        if len(x):
            fill[x[first]] += size
        last = (int(ch[-1]), int(pos[-1]), bool(seed[-1]))
        block = min(BLOCK, max(2, min(BLOCK, 256), 2 * n))
        i, j = i + n - from_seed, j + from_seed
    return out, lcp


def _packed(text, at, left, per: int, bits: int) -> np.ndarray:
    """``per`` symbols from each ``at`` in one integer; all ones past ``left``."""
    key, n = np.zeros(len(at), np.int64), len(text)
    for t in range(per):
        s = text[np.minimum(at + t, n - 1)].astype(np.int64)
        key = (key << bits) | np.where(t < left, s, (1 << bits) - 1)
    return key


def name_substrings(text, stars, sigma: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Order and names of the S* substrings (each up to the next S*, included).
    One that is a prefix of another is the larger of the two."""
    n = len(stars)
    length = np.append(np.diff(stars), 0) + 1
    bits = max(2, int(sigma + 1).bit_length())
    per = max(1, 62 // bits)
    order, group = np.arange(n), np.zeros(n, np.int64)  # group: by place in order
    active, done = np.arange(n), 0
    while len(active):
        ids = order[active]
        key = _packed(text, stars[ids] + done, length[ids] - done, per, bits)
        by = np.lexsort((key, group[active]))
        order[active] = ids[by]
        key, g = key[by], group[active]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (g[1:] != g[:-1])])
        group[active] = active[np.flatnonzero(new)][np.cumsum(new) - 1]
        done += per
        alone = new & np.append(new[1:], True)
        active = active[~alone & (length[order[active]] >= done)]  # one that just ended still differs from longer ones
    fresh = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, bool)
    names = np.empty(n, np.int64)
    names[order] = np.cumsum(fresh) - 1
    return order, names, int(fresh.sum())


def common_prefixes(text, sorted_at, cap: int, bits: int) -> np.ndarray:
    """Common prefix (at most ``cap``) of each sorted suffix with the one before."""
    n, out = len(text), np.zeros(len(sorted_at), np.int16)
    per = max(1, 62 // bits)
    active = np.arange(1, len(sorted_at))
    done = 0
    while len(active) and done < cap:
        p, q = sorted_at[active] + done, sorted_at[active - 1] + done
        a, b = (_packed(text, s, np.maximum(n - s, 0), per, bits) for s in (p, q))
        differ = a ^ b
        top = np.frexp((differ >> 31).astype(np.float64))[1] + 31
        low = np.frexp((differ & ((1 << 31) - 1)).astype(np.float64))[1]
        width = np.where(differ >> 31 > 0, top, low)  # bits of the difference
        same = (per * bits - width) // bits
        out[active] = np.minimum(done + np.where(differ == 0, per, same), cap)
        active = active[differ == 0]
        done += per
    return out


def _sorted_stars(text, types, sigma: int, store: Store) -> np.ndarray:
    stars = np.flatnonzero((types[1:] == 1) & (types[:-1] == 0)) + 1
    if len(stars) < 2:
        return stars
    order, names, distinct = name_substrings(text, stars, sigma)
    if distinct < len(stars):
        order = suffix_array(names, distinct, store)
    return stars[order]


def _parts(text, sigma: int, cap: int, store: Store):
    """Both kinds' counts, positions and (for ``cap`` > 0) common prefixes.  S
    suffixes come in descending order."""
    types = suffix_types(text, store)
    large = np.bincount(text[types == 0], minlength=sigma)
    small = np.bincount(text[types == 1], minlength=sigma)
    stars = _sorted_stars(text, types, sigma, store)
    star_lcp = common_prefixes(text, stars, cap, max(2, int(sigma + 1).bit_length())) if cap else None
    l_at, l_lcp = induce(text, large, stars, star_lcp, cap, store)
    # With symbols complemented the order is reversed, and S suffixes are
    # induced from L suffixes by the same rule.
    flipped = store.array(len(text), text.dtype)
    for i in range(0, len(text), BLOCK):
        flipped[i:i + BLOCK] = sigma - 1 - text[i:i + BLOCK]
    seed_lcp = None
    if cap:
        seed_lcp = np.concatenate([[0], l_lcp[:0:-1]]).astype(np.int16)
    s_at, s_lcp = induce(flipped, small[::-1], l_at[::-1], seed_lcp, cap, store)
    return large, small, l_at, l_lcp, s_at, s_lcp


def suffix_array(text: np.ndarray, sigma: int, store: Store) -> np.ndarray:
    """All suffixes of ``text`` (unique smallest last symbol 0) in order."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    large, small, l_at, _, s_at, _ = _parts(text, sigma, 0, store)
    s_at = s_at[::-1]
    s_at[0] = len(text) - 1  # the end mark: the one suffix that nothing induces
    start = np.concatenate([[0], np.cumsum(large + small)[:-1]])
    l_start, s_start = (np.concatenate([[0], np.cumsum(x)[:-1]]) for x in (large, small))
    out = store.array(len(text), np.int64)
    for at, begin, shift in ((l_at, l_start, 0), (s_at, s_start, large)):
        c = text[at]
        out[(start + shift - begin)[c] + np.arange(len(at))] = at
    return out


def repeated(text: np.ndarray, sigma: int, length: int, store: Store) -> np.ndarray:
    """1 where the ``length`` symbols from a position also start elsewhere: a
    neighbour in suffix order shares at least that many."""
    out = store.array(len(text), np.uint8)
    if len(text) < 2:
        return out
    large, small, l_at, l_lcp, s_at, s_lcp = _parts(text, sigma, length, store)
    for at, lcp in ((l_at, l_lcp), (s_at, s_lcp)):
        hit = np.asarray(lcp) >= length
        hit[:-1] |= hit[1:].copy()
        found = at[hit]
        out[found[found >= 0]] = 1
    # Where a symbol's L suffixes end and its S suffixes begin, only a run of it is shared.
    l_end, s_end = np.cumsum(large), np.cumsum(small[::-1])[::-1]
    for c in np.flatnonzero((large > 0) & (small > 0)):
        p, q = int(l_at[l_end[c] - 1]), int(s_at[s_end[c] - 1])
        if q >= 0 and min(_run(text, p, length), _run(text, q, length)) >= length:
            out[p] = out[q] = 1
    return out
