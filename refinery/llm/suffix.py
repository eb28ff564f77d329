"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array steps.

Suffixes are classified (S: smaller than the next, L: larger), the leftmost-smaller ones are sorted
by their substrings and, where these repeat, recursively; the others follow by two passes over the
buckets of first symbols. A pass moves many buckets at once, as long as none of them feeds another;
a run of one symbol, which feeds its own bucket, is moved as a whole. Where buckets are small, few of them
can be moved at once, and texts of up to ONE_BY_ONE symbols are passed over suffix by suffix.
"""

from __future__ import annotations

import numpy as np

#: Positions moved at once at most, unless one bucket has more; symbols compared at once.
MOST_AT_ONCE, CELLS = 1 << 15, 1 << 18
#: Symbols of a text whose suffixes may be moved one by one, which is faster where a bucket has no more of them than SMALL on average.
ONE_BY_ONE, SMALL = 1 << 20, 512


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)


def _types(t: np.ndarray) -> np.ndarray:
    """True: the suffix is smaller than the next one."""
    n = len(t)
    nxt = np.arange(n)
    nxt[:-1][t[:-1] == t[1:]] = n
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    out = np.zeros(n, bool)
    inner = nxt < n - 1
    out[inner] = t[nxt[inner]] < t[nxt[inner] + 1]
    return out


def _run_before(t: np.ndarray) -> np.ndarray:
    """How many equal symbols stand right before each position."""
    pos = np.arange(len(t))
    head = np.where(np.concatenate([[True], t[1:] != t[:-1]]), pos, 0)
    return pos - np.maximum.accumulate(head)


class _Buckets:
    """Positions filed under their symbols, in order of arrival, each bucket from its own start."""

    def __init__(self, t: np.ndarray, begin: np.ndarray) -> None:
        self.t, self.begin, self.fill = t, begin, begin[:-1].copy()
        self.of = np.empty(len(t), np.int64)

    def add(self, pos: np.ndarray) -> None:
        if not len(pos):
            return
        sym = self.t[pos]
        by = np.argsort(sym, kind="stable")
        sym = sym[by]
        first = np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]]))
        count = np.diff(np.append(first, len(sym)))
        self.of[np.arange(len(sym)) - np.repeat(first, count) + self.fill[sym]] = pos[by]
        self.fill[sym[first]] += count

    def counts(self, lo: int, hi: int) -> np.ndarray:
        return self.fill[lo:hi] - self.begin[lo:hi]

    def get(self, lo: int, hi: int) -> np.ndarray:
        if hi == lo + 1:
            return self.of[self.begin[lo] : self.fill[lo]]
        return self.of[ranges(self.begin[lo:hi], self.counts(lo, hi))]


def _pass(t: np.ndarray, begin: np.ndarray, run: np.ndarray, first: np.ndarray, after: np.ndarray, after_at: np.ndarray) -> _Buckets:
    """Buckets from the smallest on: each has what was filed so far, then its part of ``after``; the
    predecessors of all these with a greater symbol, and those of the filed ones with an equal one, are filed in that order."""
    k = len(begin) - 1
    filed = _Buckets(t, begin)
    filed.add(first)
    lo, room = 0, 1024
    while lo < k:
        hi = max(int(np.searchsorted(begin, begin[lo] + room, side="right")) - 1, lo + 1)
        cut = lo
        if hi > lo + 1:
            mine, more = filed.get(lo, hi), after[after_at[lo] : after_at[hi]]
            bucket = np.concatenate([np.repeat(np.arange(lo, hi), filed.counts(lo, hi)), np.repeat(np.arange(lo, hi), np.diff(after_at[lo : hi + 1]))])
            both = np.concatenate([mine, more])
            by = np.argsort(bucket, kind="stable")
            both, bucket, own = both[by], bucket[by], by < len(mine)
            some = both > 0
            before, bucket, own = both[some] - 1, bucket[some], own[some]
            sym = t[before]
            feeds = (sym > bucket) | ((sym == bucket) & own)
            before, bucket, sym = before[feeds], bucket[feeds], sym[feeds]
            inside = sym < hi
            # No bucket before the first one that is fed from within this part gets any more.
            cut = int(sym[inside].min()) if inside.any() else hi
            if cut > lo:
                filed.add(before[bucket < cut])
        if cut > lo:
            room = min(2 * max(int(begin[cut] - begin[lo]), 64) if cut < hi else 2 * room, MOST_AT_ONCE)
            lo = cut
            continue
        mine = filed.get(lo, lo + 1)
        again = run[mine]
        if again.any():
            # What precedes a filed position within its run of equal symbols, first predecessors first.
            turn = ranges(np.ones(len(mine), np.int64), again)
            chain = np.repeat(mine, again) - turn
            filed.add(chain[np.argsort(turn, kind="stable")])
            mine = filed.get(lo, lo + 1)
        both = np.concatenate([mine, after[after_at[lo] : after_at[lo + 1]]])
        before = both[both > 0] - 1
        filed.add(before[t[before] > lo])
        lo += 1
        room = max(room // 2, 64)
    return filed


def _one_by_one(t: np.ndarray, begin: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """As ``_induce``: larger suffixes go to the front of their buckets, then smaller ones to the back, as their successors are met."""
    n = len(t)
    symbols, smaller = t.tolist(), _types(t).tobytes()
    of = np.full(n, -1, np.int64)
    # The given suffixes stand at the ends of their buckets.
    last = np.searchsorted(t[lms], t[lms], side="right")
    of[begin[t[lms].astype(np.int64) + 1] - last + np.arange(len(lms))] = lms
    found, front, back = of.tolist(), begin[:-1].tolist(), begin[1:].tolist()
    found[front[symbols[-1]]] = n - 1
    front[symbols[-1]] += 1
    for i in range(n):
        at = found[i] - 1
        if at >= 0 and not smaller[at]:
            sym = symbols[at]
            found[front[sym]] = at
            front[sym] += 1
    for i in range(n - 1, -1, -1):
        at = found[i] - 1
        if at >= 0 and smaller[at]:
            sym = symbols[at]
            back[sym] -= 1
            found[back[sym]] = at
    return np.array(found, np.int64)


def _induce(t: np.ndarray, k: int, lms: np.ndarray) -> np.ndarray:
    """The suffixes of t in order, from its leftmost-smaller suffixes, given by symbol and in order within a symbol."""
    n = len(t)
    begin = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=k))])
    if n <= min(ONE_BY_ONE, SMALL * k):
        return _one_by_one(t, begin, lms)
    run = _run_before(t)
    symbols = np.arange(k + 1)
    large = _pass(t, begin, run, np.array([n - 1]), lms, np.searchsorted(t[lms], symbols))
    n_large = large.counts(0, k)
    large = large.get(0, k)
    # The pass downwards is the same over the turned alphabet.
    turned, turned_begin = (k - 1 - t).astype(t.dtype), n - begin[::-1]
    small = _pass(turned, turned_begin, run, np.array([], np.int64), large[::-1], np.concatenate([[0], np.cumsum(n_large[::-1])])).get(0, k)
    out = np.empty(n, np.int64)
    out[ranges(begin[:-1], n_large)] = large
    out[ranges(begin[:-1] + n_large, np.diff(begin) - n_large)] = small[::-1]
    return out


def _shared(t: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many symbols from a[i] and from b[i] on are equal, at most limit[i]."""
    out = np.zeros(len(a), np.int64)
    live, at, width = np.flatnonzero(limit > 0), 0, 4
    while len(live):
        width = max(min(width, CELLS // len(live), int(limit[live].max()) - at), 1)
        reach = np.arange(at, at + width)
        inside = reach < limit[live][:, None]
        x, y = t[np.where(inside, a[live][:, None] + reach, 0)], t[np.where(inside, b[live][:, None] + reach, 0)]
        equal = inside & (x == y)
        whole = equal.all(1)
        out[live] += np.where(whole, width, equal.argmin(1))
        live = live[whole]
        live = live[limit[live] > at + width]
        at, width = at + width, width * 2
    return out


def _names(t: np.ndarray, order: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of substrings in order (start, size): 0, 1, ... where equal ones share a name."""
    differ = np.ones(len(order), bool)
    same = np.flatnonzero(size[1:] == size[:-1]) + 1
    differ[same] = _shared(t, order[same - 1], order[same], size[same]) < size[same]
    return np.cumsum(differ) - 1


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of t (non-negative integers) in order; a suffix is smaller than what continues it."""
    t = np.asarray(t)
    n = len(t)
    if n < 2:
        return np.arange(n)
    k = int(t.max()) + 1
    if k > 2 * n + 512:
        values, t = np.unique(t, return_inverse=True)
        k = len(values)
    t = t.astype(np.uint16 if k <= 1 << 16 else np.int32)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) < 2:
        return _induce(t, k, lms)
    ends = np.append(lms[1:], n - 1)
    where = np.full(n, -1)
    where[lms] = np.arange(len(lms))
    rough = _induce(t, k, lms[np.argsort(t[lms], kind="stable")])
    by = where[rough]
    by = by[by >= 0]
    # The last one ends with the text: one symbol more than any equal one could have.
    size = ends - lms + 1
    size[-1] = -1
    names = _names(t, lms[by], size[by])
    order = by
    if names[-1] < len(lms) - 1:
        reduced = np.empty(len(lms), np.int64)
        reduced[by] = names
        order = suffix_array(reduced)
    return _induce(t, k, lms[order])


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place j > 0 of sa: symbols that suffixes sa[j - 1] and sa[j] share at their start (0 at place 0).

    By text position first: where the symbols before a suffix and its predecessor in order are equal,
    the length is one less than at the position before, so that only the others are compared.
    """
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    phi = np.full(n, -1)
    phi[sa[1:]] = sa[:-1]
    pos = np.arange(n)
    follows = (pos > 0) & (phi > 0)
    follows[follows] = t[pos[follows] - 1] == t[phi[follows] - 1]
    plcp = np.zeros(n, np.int64)
    heads = np.flatnonzero(~follows & (phi >= 0))
    plcp[heads] = _shared(t, heads, phi[heads], n - np.maximum(heads, phi[heads]))
    last = np.maximum.accumulate(np.where(~follows, pos, 0))
    plcp = np.maximum(plcp[last] - (pos - last), 0)
    return plcp[sa]
