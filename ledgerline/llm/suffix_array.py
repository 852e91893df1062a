"""Suffix array by induced sorting, and permuted common prefixes, of one shard.

``suffix_array`` classifies suffixes (smaller or larger than the next one),
sorts the substrings between leftmost-smaller positions (of bytes by inducing,
of names by their characters), names them, sorts the shorter string of names the same way (recursively, until the
names differ), and induces the whole order from the sorted leftmost-smaller
suffixes.  Inducing goes over the buckets of first characters.  Where buckets
are long (bytes) a bucket is taken in numpy waves: all its suffixes that are
known induce their predecessors at once, those that fall into the same bucket
are the next wave.  Where there are many short buckets (names) a plain scan is
used; both give the same array in linear time.

``common_prefixes`` fills the permuted array: a position whose predecessor in
the text continues the same match has one less than the position before it, so
only the others (a sum of at most 2 n log n characters) are compared, eight
characters at a time.
"""

from __future__ import annotations

import numpy as np

LONG_BUCKETS = 400


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """The suffix array of ``s`` (int64 characters under ``k``), which ends
    with its only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    if n == 2:
        return np.array([1, 0], np.int64)
    smaller = _smaller(s)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(s, minlength=k)
    ends = np.cumsum(sizes)
    if n > LONG_BUCKETS * k:
        induce = _Waves(s, smaller, ends - sizes, ends)
        # leftmost-smaller substrings in order: any order of their first positions by bucket, then induced
        order = induce(leftmost[np.argsort(s[leftmost], kind="stable")])
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        names = _names(s, order[is_leftmost[order]], leftmost)
    else:
        induce = _Scan(s, smaller, ends - sizes, ends)
        names = _names_of_short(s, leftmost, k)
    many = int(names.max()) + 1
    rank = suffix_array(names, many) if many < len(leftmost) else np.argsort(names)
    return induce(leftmost[rank])


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one: told by the next differing character."""
    n = len(s)
    rises = np.ones(n, bool)
    step = s[1:] - s[:-1]
    where = np.where(step != 0, np.arange(n - 1), n - 1)
    where = np.minimum.accumulate(where[::-1])[::-1]
    known = where < n - 1
    rises[:-1][known] = step[where[known]] > 0
    rises[:-1][~known] = False
    return rises


def _names_of_short(s: np.ndarray, leftmost: np.ndarray, k: int) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings in text order, sorted by three
    characters at a time among those still equal.  A substring that ends is
    greater than its continuations: its last character starts a smaller suffix."""
    last = np.append(leftmost[1:], leftmost[-1])
    padded = np.append(s, [k] * 3)
    rank, open_, d = np.zeros(len(leftmost), np.int64), np.arange(len(leftmost)), 0
    while len(open_):
        key = np.zeros(len(open_), np.int64)
        for t in range(d, d + 3):
            at = leftmost[open_] + t
            key = key * (k + 1) + np.where(at <= last[open_], padded[np.minimum(at, len(s))], k)
        order = np.lexsort((key, rank[open_]))
        open_, key = open_[order], key[order]
        own = rank[open_]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])])
        # a rank is the number of substrings before: those of the group, then those before in it
        group = np.maximum.accumulate(np.where(np.concatenate([[True], own[1:] != own[:-1]]), np.arange(len(open_)), 0))
        first = np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))
        rank[open_] = own + first - group
        d += 3
        several = np.bincount(first, minlength=len(open_))[first] > 1
        open_ = open_[several & (leftmost[open_] + d - 1 <= last[open_])]          # none of an equal group has ended
    used = np.zeros(len(leftmost), np.int64)
    used[rank] = 1
    return (np.cumsum(used) - 1)[rank]


def _names(s: np.ndarray, by_substring: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, given in order, in text order (equal ones share one)."""
    at = np.zeros(len(s), np.int64)
    at[leftmost] = np.append(np.diff(leftmost), 0)          # the last one is the end mark alone
    length = at[by_substring]
    a, b = by_substring[:-1], by_substring[1:]
    same = length[:-1] == length[1:]
    open_ = np.flatnonzero(same)
    d = 0
    while len(open_):
        equal = s[a[open_] + d] == s[b[open_] + d]
        same[open_[~equal]] = False
        open_ = open_[equal]
        d += 1
        open_ = open_[length[open_] >= d]
    rank = np.concatenate([[0], np.cumsum(~same)])
    at[by_substring] = rank
    return at[leftmost]


class _Waves:
    """Induced sorting with one numpy step per bucket and wave."""

    def __init__(self, s, smaller, starts, ends):
        self.s, self.smaller, self.starts, self.ends = s, smaller, starts, ends
        self.small = s.astype(np.uint8 if len(ends) <= 1 << 8 else np.uint16 if len(ends) <= 1 << 16 else np.int64)   # sorted by radix
        self.k = len(ends)
        self.used = np.flatnonzero(ends > starts).tolist()

    def __call__(self, leftmost: np.ndarray) -> np.ndarray:
        n, k = len(self.s), self.k
        sa, leftmost = np.zeros(n, np.int32), leftmost.astype(np.int32)
        sizes = np.bincount(self.s[leftmost], minlength=k)
        cut = np.cumsum(sizes)
        head = self.starts.copy()
        # larger suffixes, buckets ascending
        for c in self.used:
            low = int(self.starts[c])
            while low < head[c]:
                high = int(head[c])
                self._place(sa, sa[low:high] - 1, head, False)
                low = high
            self._place(sa, leftmost[cut[c] - sizes[c]:cut[c]] - 1, head, False)
        # smaller suffixes, buckets descending, from their ends
        tail = self.ends.copy()
        for c in reversed(self.used):
            high = int(self.ends[c])
            while high > tail[c]:
                low = int(tail[c])
                self._place(sa, sa[low:high][::-1] - 1, tail, True)
                high = low
            if c == 0:
                break
            self._place(sa, sa[int(self.starts[c]):int(head[c])][::-1] - 1, tail, True)
        sa[0] = n - 1
        return sa.astype(np.int64)

    def _place(self, sa: np.ndarray, before: np.ndarray, edge: np.ndarray, smaller: bool) -> None:
        before = before[before >= 0]
        before = before[self.smaller[before] == smaller]
        if not len(before):
            return
        c = self.small[before]
        order = np.argsort(c, kind="stable")
        before, c = before[order], c[order]
        counts = np.bincount(c, minlength=self.k)
        nth = np.arange(len(before))
        if smaller:
            sa[(edge - 1 + np.cumsum(counts) - counts)[c] - nth] = before
            edge -= counts
        else:
            sa[(edge - np.cumsum(counts) + counts)[c] + nth] = before
            edge += counts


class _Scan:
    """Induced sorting by a scan.  The lists hold the character of the larger
    (smaller) suffixes and -1 for the others."""

    def __init__(self, s, smaller, starts, ends):
        self.s, self.n, self.starts, self.ends = s, len(s), starts, ends
        self.larger_c, self.smaller_c = np.where(smaller, -1, s).tolist(), np.where(smaller, s, -1).tolist()

    def __call__(self, leftmost: np.ndarray) -> np.ndarray:
        c = self.s[leftmost]
        counts = np.bincount(c, minlength=len(self.ends))
        placed = np.zeros(self.n, np.int64)
        placed[(self.ends - np.cumsum(counts))[c] + np.arange(len(c))] = leftmost
        sa, chars, head = placed.tolist(), self.larger_c, self.starts.tolist()
        for i in sa:                # sees the suffixes that it places ahead
            if i:
                i -= 1
                c = chars[i]
                if c >= 0:
                    sa[head[c]] = i
                    head[c] += 1
        chars, tail = self.smaller_c, self.ends.tolist()
        for i in reversed(sa):
            if i:
                i -= 1
                c = chars[i]
                if c >= 0:
                    c_at = tail[c] - 1
                    sa[c_at] = i
                    tail[c] = c_at
        sa[0] = self.n - 1
        return np.array(sa, np.int64)


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For every position of ``text`` (uint8, as in ``sa``): how many characters its suffix
    shares with the suffix before it in the suffix array."""
    n = len(text)
    before = np.full(n, n, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view("<u8")[:, 0]
    carried = np.zeros(n, bool)
    inner = before[1:] < n
    carried[1:] = inner & (before[1:] > 0)
    k = np.flatnonzero(carried)
    carried[k] = text[k - 1] == text[before[k] - 1]
    found = np.zeros(n, np.int64)
    own = np.flatnonzero(~carried & (before < n))
    a, b, done = own, before[own], 0
    while len(own):
        differ = eight[np.minimum(a + done, n)] ^ eight[np.minimum(b + done, n)]
        equal = differ == 0
        # the lowest byte that differs ends the match
        low = differ[~equal]
        found[own[~equal]] = done + _zero_bytes(low)
        own, a, b = own[equal], a[equal], b[equal]
        done += 8
    at = np.maximum.accumulate(np.where(carried, 0, np.arange(n)))
    return found[at] - (np.arange(n) - at)


def _zero_bytes(x: np.ndarray) -> np.ndarray:
    lowest = x & (~x + np.uint64(1))
    return (np.log2(lowest.astype(np.float64)).astype(np.int64)) >> 3
