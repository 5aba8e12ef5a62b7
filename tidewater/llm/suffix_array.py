"""Suffix arrays by induced sorting and permuted common prefixes, vectorised with numpy.

Induced sorting walks the buckets of first symbols in order; within a bucket all entries that are
known induce their left neighbours at once, so a bucket takes as many numpy rounds as its longest
run of equal symbols. The reduced string of a level is written in two symbols per name (a
smaller alphabet keeps the number of buckets low), and solved by the same function; from the third level on, a reduced
string short enough is ordered directly by doubling ranks.
"""

from __future__ import annotations

import numpy as np

_SMALL = 48
_WIDE = 1024  # alphabets above this are written as two symbols
_DIRECT = 1 << 20  # symbols of a reduced string that are ordered directly, from this level on:
_DIRECT_LEVEL = 2


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour (S); the last one is not (the end sorts first)."""
    n = len(t)
    nxt = np.empty(n, dtype=np.int8)
    nxt[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1])
    nxt[-1] = -1
    known = np.where(nxt != 0, np.arange(n), n - 1)
    return nxt[np.minimum.accumulate(known[::-1])[::-1]] > 0


def _scatter(sa: np.ndarray, at: np.ndarray, pos: np.ndarray, sym: np.ndarray, step: int) -> None:
    """Append ``pos`` to the buckets of ``sym`` in the given order; at: where each bucket goes on, moved by ``step``."""
    order = np.argsort(sym, kind="stable")
    s = sym[order]
    new = np.empty(len(s), dtype=bool)
    new[0] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    begin = np.flatnonzero(new)
    count = np.diff(begin, append=len(s))
    rank = np.arange(len(s)) - np.repeat(begin, count)
    sa[at[s] + step * rank] = pos[order]
    at[s[begin]] += step * count


def _induce(t: np.ndarray, size: np.ndarray, lms: np.ndarray, sa: np.ndarray) -> None:
    """Fill ``sa`` from the leftmost-smaller suffixes in ``lms`` (their order): first L from the left, then S from the right."""
    n = len(t)
    end = np.cumsum(size)
    begin = end - size
    used = np.flatnonzero(size).tolist()
    lms = lms[np.argsort(t[lms], kind="stable")]
    lms_end = np.cumsum(np.bincount(t[lms], minlength=len(size))).tolist()
    head = begin.copy()
    sa[head[t[-1]]] = n - 1
    head[t[-1]] += 1
    for c in used:
        lo, hi = int(begin[c]), int(head[c])
        while lo < hi:
            p = sa[lo:hi] - 1
            p = p[p >= 0]
            s = t[p]
            same = p[s == c]
            sa[hi : hi + len(same)] = same
            lo, hi = hi, hi + len(same)
            more = s > c
            if more.any():
                _scatter(sa, head, p[more], s[more], 1)
        head[c] = hi
        own = lms[lms_end[c - 1] if c else 0 : lms_end[c]]
        if len(own):
            p = own - 1
            _scatter(sa, head, p, t[p], 1)
    l_end = head.tolist()
    tail = end - 1
    for c in reversed(used):
        hi, lo = int(end[c]) - 1, int(tail[c])  # S entries so far stand in (lo, hi], the largest first
        while hi > lo:
            p = sa[hi:lo:-1] - 1 if lo >= 0 else sa[hi::-1] - 1
            p = p[p >= 0]
            s = t[p]
            same = p[s == c]
            sa[lo - len(same) + 1 : lo + 1] = same[::-1]
            hi, lo = lo, lo - len(same)
            less = s < c
            if less.any():
                _scatter(sa, tail, p[less], s[less], -1)
        tail[c] = lo
        p = sa[int(begin[c]) : l_end[c]][::-1] - 1
        p = p[p >= 0]
        s = t[p]
        less = s < c
        if less.any():
            _scatter(sa, tail, p[less], s[less], -1)


def _differ(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether t[a:a+length] and t[b:b+length] differ, for arrays of places."""
    out = np.zeros(len(a), dtype=bool)
    live, off = np.arange(len(a)), 0
    while len(live):
        ne = t[a[live] + off] != t[b[live] + off]
        out[live[ne]] = True
        off += 1
        live = live[~ne]
        live = live[length[live] > off]
    return out


def _by_doubling(t: np.ndarray) -> np.ndarray:
    """The suffix order from ranks of 1, 2, 4, ... symbols; only places whose rank is still shared are sorted again."""
    n = len(t)
    order = np.argsort(t, kind="stable").astype(np.int64)
    rank = np.empty(n, dtype=np.int64)
    place, keys, length = np.arange(n), t[order].astype(np.int64), 1
    while True:
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        rank[order[place]] = np.maximum.accumulate(np.where(new, place, 0))
        alone = new & np.concatenate((new[1:], [True]))
        place = place[~alone]
        if not len(place):
            return order.astype(np.int32)
        i = order[place]
        far = np.minimum(i + length, n - 1)
        keys = rank[i] * (n + 1) + np.where(i + length < n, rank[far] + 1, 0)
        by = np.argsort(keys, kind="stable")
        order[place], keys, length = i[by], keys[by], 2 * length


def suffix_array(t: np.ndarray, alphabet: int, level: int = 0) -> np.ndarray:
    """Starts of the suffixes of ``t`` (symbols below ``alphabet``) in order; a suffix sorts before what it is a prefix of."""
    n = len(t)
    if level >= _DIRECT_LEVEL and n <= _DIRECT:
        return _by_doubling(t)
    if n <= _SMALL:
        seq = t.tolist()
        return np.array(sorted(range(n), key=lambda i: seq[i:]), dtype=np.int32)
    is_s = _types(t)
    size = np.bincount(t, minlength=alphabet)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    sa = np.empty(n, dtype=np.int32)
    if not len(lms):
        _induce(t, size, lms, sa)
        return sa
    _induce(t, size, lms, sa)  # sorts the leftmost-smaller substrings
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    by_sub = sa[is_lms[sa]]
    span = np.zeros(n, dtype=np.int32)  # symbols of each substring, its closing one included
    span[lms[:-1]] = np.diff(lms) + 1
    span[lms[-1]] = n - lms[-1] + 1  # runs into the end: like no other
    a, b = by_sub[:-1], by_sub[1:]
    new = (span[a] != span[b]) | (a == lms[-1]) | (b == lms[-1])
    equal_span = np.flatnonzero(~new)
    new[equal_span] = _differ(t, a[equal_span], b[equal_span], span[a[equal_span]])
    names = np.empty(n, dtype=np.int32)
    names[by_sub] = np.concatenate(([0], np.cumsum(new)))
    reduced = names[lms]
    kinds = int(new.sum()) + 1
    if kinds < len(lms):
        root = int(np.ceil(np.sqrt(kinds)))
        if kinds > _WIDE and 2 * len(lms) < 0.9 * n:
            pairs = np.empty(2 * len(lms), dtype=np.int32)
            pairs[0::2], pairs[1::2] = reduced // root, reduced % root
            order = suffix_array(pairs, root + 1, level + 1)
            order = order[order % 2 == 0] // 2
        else:
            order = suffix_array(reduced, kinds, level + 1)
        by_suffix = lms[order]
    else:
        by_suffix = by_sub
    _induce(t, size, by_suffix, sa)
    return sa


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place i of the bytes ``t``: the place before it in suffix order (-1: none), and the length of their common prefix.

    Only irreducible places (whose left symbols differ) are compared, eight bytes at a time; elsewhere the
    length is that of the place before, less one."""
    n = len(t)
    before = np.empty(n, dtype=np.int32)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    left = np.concatenate(([-1], t[:-1].astype(np.int16)))
    irreducible = (before <= 0) | (i == 0) | (left != left[np.maximum(before, 0)])
    at = i[irreducible]
    with_ = before[irreducible]
    lcp = np.zeros(len(at), dtype=np.int64)
    padded = np.concatenate((t, np.zeros(16, dtype=np.uint8)))
    words = np.ndarray(n + 8, dtype="<u8", buffer=padded.data, strides=(1,))
    limit = n - np.maximum(at, with_)
    live = np.flatnonzero(with_ >= 0)
    while len(live):
        off = lcp[live]
        x = words[at[live] + off] ^ words[with_[live] + off]
        equal = x == 0
        low = (x & (~x + np.uint64(1))).astype(np.float64)  # lowest differing bit
        lcp[live] += np.where(equal, 8, (np.frexp(np.where(equal, 1.0, low))[1] - 1) // 8)
        lcp[live] = np.minimum(lcp[live], limit[live])
        live = live[equal & (lcp[live] < limit[live])]
    full = np.zeros(n, dtype=np.int64)
    full[at] = lcp + at
    source = np.maximum.accumulate(np.where(irreducible, i, 0))
    return before, np.maximum(full[source] - i, 0)
