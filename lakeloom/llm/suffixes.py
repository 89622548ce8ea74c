"""Suffix arrays and common prefixes of many short texts at once, in numpy."""

from __future__ import annotations

import numpy as np

STEP = 7  # symbols of 9 bits in one 63-bit key


def keys_of(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The first seven symbols of every suffix as a number; 0 stands for the end of its text."""
    key = np.zeros(len(data), np.uint64)
    for k in range(STEP):
        key <<= np.uint64(9)
        part = data[k:].astype(np.uint64) + np.uint64(1)
        part[left[:len(part)] <= k] = 0
        key[:len(part)] |= part
    return key


def suffix_array(data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, equal ones by position, and the sort keys of the first seven symbols.

    ``left`` is how many symbols each suffix has to the end of its own text.
    Larsson and Sadakane: after a first sort, each round doubles the sorted
    depth by the rank of the suffix that stands that much further on, and only
    groups that are still tied take part.
    """
    n = len(data)
    key = keys_of(data, left)
    sa = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[sa[1:]] != key[sa[:-1]]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    h = STEP
    slots = np.arange(n)
    while True:
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        slots = slots[~alone & (left[sa[slots]] >= h)]  # shorter ones are equal to their ends
        if not len(slots):
            return sa, key
        s = sa[slots]
        pair = (rank[s] << 32) | np.where(left[s] > h, rank[np.minimum(s + h, n - 1)] + 1, 0)
        order = np.argsort(pair, kind="stable")
        s, pair = s[order], pair[order]
        sa[slots] = s
        fresh = np.ones(len(s), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        rank[s] = np.maximum.accumulate(np.where(fresh, slots, 0))
        h *= 2


def common_prefixes(sa: np.ndarray, key: np.ndarray, left: np.ndarray, starts: np.ndarray, counts: np.ndarray,
                    limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For the first ``counts`` suffixes of each text: the suffix before it in order, and what both share up to ``limit``.

    Kasai's walk in text order, where a suffix shares at least one symbol less
    than the suffix one further left did; all texts walk in step.
    """
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int32)
    by = np.argsort(-counts, kind="stable")
    starts, counts = starts[by], counts[by]
    h = np.zeros(len(starts), np.int64)
    for t in range(int(counts[0]) if len(counts) else 0):
        live = int(np.searchsorted(-counts, -t, "left"))
        i = starts[:live] + t
        j = before[i]
        h = np.maximum(h[:live] - 1, 0)
        h[j < 0] = 0
        most = np.minimum(np.minimum(left[i], left[j]), limit)
        go = np.flatnonzero((j >= 0) & (h < most))
        while len(go):
            x = key[i[go] + h[go]] ^ key[j[go] + h[go]]
            same = np.zeros(len(go), np.int64)
            for bit in range(54, -1, -9):
                same += x < np.uint64(1 << bit)
            h[go] = np.minimum(h[go] + same, most[go])
            go = go[(same == STEP) & (h[go] < most[go])]
        shared[i] = h
    return before, shared
