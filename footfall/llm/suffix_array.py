"""Suffix arrays by induced sorting, and permuted common prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers from 0) in order; the end counts as smallest.

    Suffixes are classed as smaller (S) or larger (L) than the next one. The leftmost S of each run
    starts a substring. Induced sorting of these substrings names them; the string of names, at most
    half as long, is sorted recursively, or by doubling if it has many symbols; its order induces all the rest.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    work = np.append(text.astype(np.int64) + 1, 0)
    return _sais(work, int(work.max()) + 1)[1:]


def _types(text: np.ndarray) -> np.ndarray:
    """True for S. A symbol that equals the next one has the type of the next."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    smaller = np.append(text[differs] < text[differs + 1], True)
    return np.append(np.repeat(smaller, np.diff(differs, prepend=-1, append=n - 2)), True)


def _sais(text: np.ndarray, symbols: int) -> np.ndarray:
    """``text`` ends with its only 0."""
    if symbols > 300:
        return _doubled(text)
    n = len(text)
    small = _types(text)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    ends = np.cumsum(np.bincount(text, minlength=symbols))
    order = _induce_buckets(text, small, lms[np.argsort(text[lms], kind="stable")], ends)
    ranked = order[is_lms[order]]
    names = _names(text, small, is_lms, lms, ranked)
    where = np.searchsorted(lms, ranked)
    string = np.empty(len(lms), dtype=np.int64)
    string[where] = names
    if names[-1] + 1 < len(lms):
        ranked = lms[_sais(string, int(names[-1]) + 1)]
    return _induce_buckets(text, small, ranked, ends)


def _names(text, small, is_lms, lms, ranked) -> np.ndarray:
    """Names of the substrings in their order, equal ones alike."""
    length = np.zeros(len(text), dtype=np.int64)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = ranked[:-1], ranked[1:]
    same = length[a] == length[b]
    open_ = np.flatnonzero(same)
    at = 0
    while len(open_):
        x, y = a[open_] + at, b[open_] + at
        equal = (text[x] == text[y]) & (small[x] == small[y])
        same[open_[~equal]] = False
        at += 1
        open_ = open_[equal & (at < length[a[open_]])]
    return np.concatenate(([0], np.cumsum(~same)))


def _induce_buckets(text, small, lms, ends) -> np.ndarray:
    """Places the given substring starts at the ends of their buckets; then L from the left, S from the right.

    Bucket by bucket, all entries at once: what an entry of a bucket induces stands in its own
    bucket, behind it, or in a later one, and keeps its order. So a bucket is done in waves.
    """
    n, symbols = len(text), len(ends)
    starts = np.concatenate(([0], ends[:-1]))
    order = np.full(n, -1, dtype=np.int64)
    groups = np.searchsorted(text[lms], np.arange(symbols + 1)) if len(lms) else np.zeros(symbols + 1, dtype=np.int64)
    key = text.astype(np.uint16)
    head = starts.copy()
    for c in range(symbols):
        if ends[c] == starts[c]:
            continue
        at = starts[c]
        while at < head[c]:
            wave = order[at : head[c]]
            at = head[c]
            _put(wave, key, small, False, order, head, 1)
        wave = lms[groups[c] : groups[c + 1]]
        if len(wave):
            _put(wave, key, small, False, order, head, 1)
    tail = ends.copy()
    order_s = order
    for c in range(symbols - 1, -1, -1):
        if ends[c] == starts[c]:
            continue
        at = ends[c]
        while at > tail[c]:
            wave = order_s[tail[c] : at][::-1]
            at = tail[c]
            _put(wave, key, small, True, order_s, tail, -1)
        if head[c] > starts[c]:
            _put(order_s[starts[c] : head[c]][::-1], key, small, True, order_s, tail, -1)
    order_s[0] = n - 1
    return order_s


def _put(wave, key, small, kind, order, pointer, step) -> None:
    """The predecessors of ``wave`` that have the type, in its order, to the pointers of their buckets."""
    before = wave[wave > 0] - 1
    before = before[small[before] == kind]
    if not len(before):
        return
    symbol = key[before]
    by = np.argsort(symbol, kind="stable")
    before, symbol = before[by], symbol[by]
    first = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
    count = np.diff(np.append(first, len(symbol)))
    which = symbol[first]
    offset = np.arange(len(symbol)) - np.repeat(first, count)
    if step > 0:
        order[np.repeat(pointer[which], count) + offset] = before
    else:
        order[np.repeat(pointer[which], count) - 1 - offset] = before
    pointer[which] += step * count


def _doubled(text: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a large alphabet, whose buckets hold few entries. ``text`` ends with its only 0.

    A suffix's rank is the first place of those that share its first symbols. Its rank and that of the suffix behind
    these symbols tell twice as many; only suffixes that still share a rank are sorted again.
    """
    n = len(text)
    order, open_, rank = np.arange(n), np.arange(n), np.empty(n, dtype=np.int64)
    key, width = text, 1
    while len(open_):
        by = np.argsort(key)
        order[open_], key = order[open_][by], key[by]
        fresh = np.concatenate(([True], key[1:] != key[:-1], [True]))
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(fresh[:-1], np.arange(len(open_)), 0))]
        open_ = open_[~(fresh[:-1] & fresh[1:])]
        starts = order[open_]
        key, width = rank[starts] * n + rank[starts + width], 2 * width
    return order


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, end: int) -> np.ndarray:
    """For each start, the symbols its suffix shares with the suffix before it in ``order``.

    ``end`` ends a stretch and equals nothing, not even itself. A suffix whose predecessor in the
    text equals that of its neighbour shares one symbol less than the suffix before it; only the
    others are compared.
    """
    n = len(text)
    neighbour = np.full(n, -1, dtype=np.int64)
    neighbour[order[1:]] = order[:-1]
    here = np.arange(n)
    reducible = (here > 0) & (neighbour > 0)
    i = here[reducible]
    reducible[i] = (text[i - 1] == text[neighbour[i] - 1]) & (text[i - 1] != end)
    # The neighbour of the suffix one before must be the one before the neighbour.
    i = here[reducible]
    reducible[i] = neighbour[i - 1] == neighbour[i] - 1
    shared = np.zeros(n, dtype=np.int64)
    open_ = np.flatnonzero(~reducible & (neighbour >= 0))
    at = 0
    while len(open_):
        x, y = open_ + at, neighbour[open_] + at
        fits = (x < n) & (y < n)
        open_, x, y = open_[fits], x[fits], y[fits]
        equal = (text[x] == text[y]) & (text[x] != end)
        open_ = open_[equal]
        at += 1
        shared[open_] = at
    base = np.where(reducible, 0, shared + here)
    return np.where(reducible, np.maximum(np.maximum.accumulate(base) - here, 0), shared)
