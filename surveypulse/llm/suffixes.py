"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller or larger than the next one. The leftmost smaller ones (LMS) are
sorted by the substrings between them, recursively where those repeat, and the order of all others
is induced from theirs, first the larger by ascending first letter, then the smaller by descending.
With few letters each bucket is induced as whole arrays; with many (the names of a recursion), entry
by entry. Either way the work is linear.
"""

from __future__ import annotations

import numpy as np

FEW = 600


def smaller(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next; the last letter is the only 0."""
    n = len(s)
    up = np.zeros(n, np.int8)
    up[:-1] = np.sign(s[1:] - s[:-1])
    up[-1] = 1
    at = np.where(up != 0, np.arange(n), n)
    return up[np.minimum.accumulate(at[::-1])[::-1]] > 0


def induced(s: np.ndarray, small: np.ndarray, lms: np.ndarray, top: int) -> np.ndarray:
    """All suffixes in the order that the order of ``lms`` gives; letters are 0..top."""
    n, nothing = len(s), np.zeros(0, np.int64)
    ends = np.searchsorted(s[lms], np.arange(top + 2)) if (np.diff(s[lms]) >= 0).all() else None
    if ends is None:
        lms = lms[np.argsort(s[lms], kind="stable")]
        ends = np.searchsorted(s[lms], np.arange(top + 2))
    letter = s.astype(np.uint16)
    waits: list[list[np.ndarray]] = [[] for _ in range(top + 1)]

    def hand_on(j: np.ndarray) -> None:
        """To each letter's bucket its suffixes, in this order."""
        if not len(j):
            return
        c = letter[j]
        order = np.argsort(c, kind="stable")
        c, j = c[order], j[order]
        cut = np.append(np.flatnonzero(np.diff(c)) + 1, len(c)).tolist()
        a = 0
        for b in cut:
            waits[c[a]].append(j[a:b])
            a = b

    larger = []
    for c in range(top + 1):
        got = []
        while waits[c]:
            held = np.concatenate(waits[c])
            waits[c] = []
            got.append(held)
            j = held[held > 0] - 1
            hand_on(j[~small[j]])
        larger.append(np.concatenate(got) if got else nothing)
        first = lms[ends[c] : ends[c + 1]]
        hand_on(first[first > 0] - 1)
    parts = []
    waits = [[] for _ in range(top + 1)]
    waits[0].append(np.array([n - 1]))
    for c in range(top, -1, -1):
        got = []
        while waits[c]:
            held = np.concatenate(waits[c])
            waits[c] = []
            got.append(held)
            j = held[held > 0] - 1
            hand_on(j[small[j]])
        held = larger[c][::-1]
        j = held[held > 0] - 1
        hand_on(j[small[j]])
        # Within a bucket the larger come first; the smaller were found from the last backwards.
        parts += [*got, larger[c][::-1]]
    return np.concatenate(parts)[::-1]


def induced_singly(s: np.ndarray, small: np.ndarray, lms: np.ndarray, top: int) -> np.ndarray:
    """The same, entry by entry."""
    n = len(s)
    count = np.bincount(s, minlength=top + 1)
    tails = np.cumsum(count)
    head, tail = (tails - count).tolist(), tails.tolist()
    letters, less = s.tolist(), small.tolist()
    out = [-1] * n
    for i in reversed(lms.tolist()):
        c = letters[i]
        tail[c] -= 1
        out[tail[c]] = i
    for k in range(n):
        j = out[k] - 1
        if j >= 0 and not less[j]:
            c = letters[j]
            out[head[c]] = j
            head[c] += 1
    tail = tails.tolist()
    for k in range(n - 1, -1, -1):
        j = out[k] - 1
        if j >= 0 and less[j]:
            c = letters[j]
            tail[c] -= 1
            out[tail[c]] = j
    out[0] = n - 1
    return np.array(out, np.int64)


def suffix_array(s: np.ndarray, top: int) -> np.ndarray:
    """The order of the suffixes of ``s``, whose letters are 0..top and whose last is the only 0."""
    s = s.astype(np.int64)
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    small = smaller(s)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms)
    induce = induced if top <= FEW else induced_singly
    order = induce(s, small, lms, top)
    order = order[is_lms[order]]
    # Name the substrings from each LMS position to the next, equal ones alike.
    reach = np.zeros(n, np.int64)
    reach[lms] = np.append(np.diff(lms) + 1, 1)
    same = np.zeros(len(order), bool)
    near = np.flatnonzero(reach[order[1:]] == reach[order[:-1]]) + 1
    a, b, size, step = order[near], order[near - 1], reach[order[near]], 0
    while len(near):
        good = s[a + step] == s[b + step]
        step += 1
        same[near[good & (size == step)]] = True
        good &= size > step
        near, a, b, size = near[good], a[good], b[good], size[good]
    name = np.empty(n, np.int64)
    name[order] = np.cumsum(~same) - 1
    names = name[lms]
    if same.any():
        lms = lms[suffix_array(names, int(names.max()))]
    else:
        lms = order
    return induce(s, small, lms, top)


def common_prefixes(s: np.ndarray, order: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the suffix before it in the order (-1: none) and the length of the prefix
    they share, counted up to ``end`` of the position, in text order. Only where the letters before
    both differ, or ``end`` changes, is anything compared; elsewhere it is one less than before."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    fresh = np.ones(n, bool)
    i = np.flatnonzero((before[1:] > 0) & (before[:-1] >= 0)) + 1
    fresh[i] = (s[i - 1] != s[before[i] - 1]) | (end[i] != end[i - 1]) | (before[i - 1] != before[i] - 1)
    start = np.flatnonzero(fresh & (before >= 0))
    data = np.concatenate([s.astype(np.uint8), np.zeros(16, np.uint8)])
    word = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel()
    length = np.zeros(n, np.int64)
    a, b, at = start, before[start], start
    last = len(word) - 1
    while len(a):
        good = (word[np.minimum(a, last)] == word[np.minimum(b, last)]) & (a < end[at])
        length[at[good]] += 8
        a, b, at = a[good] + 8, b[good] + 8, at[good]
    a, b, at = start + length[start], before[start] + length[start], start
    edge = len(data) - 1
    while len(a):
        good = (data[np.minimum(a, edge)] == data[np.minimum(b, edge)]) & (a < end[at])
        length[at[good]] += 1
        a, b, at = a[good] + 1, b[good] + 1, at[good]
    length[start] = np.minimum(length[start], end[start] - start)
    where = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    length = np.maximum(length[where] - (np.arange(n) - where), 0)
    length[before < 0] = 0
    return before, length
