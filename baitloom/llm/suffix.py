"""Suffix arrays by induced sorting, and permuted common prefixes, over a shard's texts.

The passes of induced sorting go through the array in order. Where symbols are
few they run bucket by bucket: all suffixes that stand in a bucket already induce
at once, and again those that they put into the same bucket, so each step is one
array operation. Where symbols are many, as in the strings of names that the
recursion sorts, they run suffix by suffix. Both are linear and give the same.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor. The last counts as smaller."""
    n = len(s)
    rise = np.empty(n, np.int8)
    rise[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    rise[-1] = 1
    # an equal symbol takes the type of what follows
    at = np.where(rise != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return rise[following] > 0


def _push(sa: np.ndarray, edge: np.ndarray, symbols: np.ndarray, items: np.ndarray, step: int) -> None:
    """Puts items at the edges of their buckets, keeping their order."""
    if len(items) == 1:
        c = symbols[0]
        sa[edge[c]] = items[0]
        edge[c] += step
        return
    by = np.argsort(symbols, kind="stable")
    c = symbols[by]
    new = np.flatnonzero(np.diff(c, prepend=c[0] - 1))
    counts = np.diff(np.append(new, len(c)))
    rank = np.arange(len(c)) - np.repeat(new, counts)
    sa[edge[c] + step * rank] = items[by]
    edge[c[new]] += step * counts


def _induce(s: np.ndarray, small: np.ndarray, sorted_lms: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    symbols = s[sorted_lms]
    start = np.searchsorted(symbols, np.arange(len(heads) + 1))
    edge = heads.copy()
    for c in range(len(heads)):  # larger suffixes, from the left
        at = heads[c]
        while at < edge[c]:
            end = edge[c]
            j = sa[at:end] - 1
            at = end
            j = j[j >= 0]
            j = j[~small[j]]
            if len(j):
                _push(sa, edge, s[j], j, 1)
        j = sorted_lms[start[c] : start[c + 1]] - 1
        j = j[j >= 0]
        if len(j):  # what comes before a leftmost-smaller suffix is larger
            _push(sa, edge, s[j], j, 1)
    larger_end = edge
    edge = tails.copy() - 1
    for c in range(len(heads) - 1, -1, -1):  # smaller suffixes, from the right
        at = tails[c] - 1
        while at > edge[c]:
            end = edge[c]
            j = sa[end + 1 : at + 1][::-1] - 1
            at = end
            j = j[j >= 0]
            j = j[small[j]]
            if len(j):
                _push(sa, edge, s[j], j, -1)
        j = sa[heads[c] : larger_end[c]][::-1] - 1
        j = j[j >= 0]
        j = j[small[j]]
        if len(j):
            _push(sa, edge, s[j], j, -1)
    sa[0] = n - 1  # nothing follows the last suffix that could have put it here
    return sa


def _induce_each(s: np.ndarray, small: np.ndarray, sorted_lms: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """The same, suffix by suffix."""
    sa, edge, symbol = [-1] * len(s), tails.tolist(), s.tolist()
    for j in reversed(sorted_lms.tolist()):
        c = symbol[j]
        edge[c] -= 1
        sa[edge[c]] = j
    # the symbol before each place, if the suffix from there is larger, or smaller; -1 else, and for an empty cell
    larger, smaller = np.full(len(s) + 1, -1), np.full(len(s) + 1, -1)
    larger[1:-1], smaller[1:-1] = np.where(small[:-1], -1, s[:-1]), np.where(small[:-1], s[:-1], -1)
    before, edge = larger.tolist(), heads.tolist()
    for i in sa:  # cells that are filled meanwhile are read, too
        c = before[i]
        if c >= 0:
            at = edge[c]
            sa[at] = i - 1
            edge[c] = at + 1
    before, edge = smaller.tolist(), tails.tolist()
    for i in reversed(sa):
        c = before[i]
        if c >= 0:
            edge[c] = at = edge[c] - 1
            sa[at] = i - 1
    sa[0] = len(s) - 1  # as in _induce
    return np.array(sa, np.int32)


def _equal_substrings(s: np.ndarray, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the n_a symbols from a on are the n_b symbols from b on, symbol by symbol."""
    same = n_a == n_b
    left, d = np.flatnonzero(same), 0
    while len(left):
        agree = s[a[left] + d] == s[b[left] + d]
        same[left[~agree]] = False
        d += 1
        left = left[agree & (n_a[left] > d)]
    return same


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of suffixes of s in order, where symbol 0 ends each text, none of them empty, and s."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _types(s)
    counts = np.bincount(s)
    tails = np.cumsum(counts)
    heads = tails - counts
    induce = _induce if 64 * len(heads) < n else _induce_each
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        sa = induce(s, small, lms[np.argsort(s[lms], kind="stable")], heads, tails)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        place = np.full(n, -1, np.int64)
        place[lms] = np.arange(len(lms))
        order = place[sa[is_lms[sa]]]  # by substring
        size = np.append(lms[1:] + 1, n) - lms
        new = np.ones(len(order), bool)
        new[1:] = ~_equal_substrings(s, lms[order[1:]], lms[order[:-1]], size[order[1:]], size[order[:-1]])
        names = np.empty(len(order), np.int64)
        names[order] = np.cumsum(new)
        if new.all():
            lms = lms[order]
        else:  # the string of names, sorted in the same way
            lms = lms[suffix_array(np.append(names, 0))[1:]]
    return induce(s, small, lms, heads, tails)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """In text order, how far each suffix agrees with the one before it in the array, up to its text's end.

    Where the symbols before the two agree, a suffix agrees one symbol less far
    than its left neighbour does; the others are compared symbol by symbol.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.where(s == 0, np.arange(n), n)
    left = np.minimum.accumulate(at[::-1])[::-1] - np.arange(n)
    own = np.ones(n, bool)
    own[1:] = (before[1:] < 1) | (s[:-1] == 0) | (s[:-1] != s[np.maximum(before[1:] - 1, 0)])
    i = np.flatnonzero(own)
    j = before[i]
    room = np.where(j >= 0, np.minimum(left[i], left[j]), 0)
    length = np.zeros(len(i), np.int64)
    open_, d = np.flatnonzero(room > 0), 0
    while len(open_):
        agree = s[i[open_] + d] == s[j[open_] + d]
        d += 1
        open_ = open_[agree]
        length[open_] = d
        open_ = open_[room[open_] > d]
    which = np.cumsum(own) - 1
    return length[which] - (np.arange(n) - i[which])
