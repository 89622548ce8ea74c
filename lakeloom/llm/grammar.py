"""Recompression: a run-length grammar of a sequence, and common extensions of its places read off the grammar."""

from __future__ import annotations

import numpy as np

from lakeloom.llm.common import GOLD, mix


class Grammar:
    """Levels of alternate block and pair compression of a sequence of numbers.

    Block compression makes every run of one symbol a symbol. Pair compression
    divides the symbols in two sides, by a hash of symbol and level, and makes
    every neighbouring pair of a left and a right one a symbol. Equal stretches
    are therefore cut alike but for their two ends, at every level.

    Negative numbers are fences: each must occur once; nothing is merged with
    one or across it, so sequences between fences are compressed apart. The
    sequence must begin and end with a fence.

    ``symbols[h]`` are the symbols of level h, ``starts[h]`` the first child of
    each symbol of level h + 1 (and one more, the end), ``parents[h]`` the
    parent of each symbol of level h. Odd levels come from blocks.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        now = np.asarray(sequence, np.int64)
        self.symbols, self.starts, self.parents = [now], [], []
        fences = int((now < 0).sum())
        fresh = int(now.max(initial=0)) + 1
        while len(now) > fences + int(np.count_nonzero((now[1:] >= 0) & (now[:-1] < 0))):
            blocks = len(self.starts) % 2 == 0
            first = self._block_starts(now) if blocks else self._pair_starts(now)
            size = np.diff(np.append(first, len(now)))
            new = now[first].copy()
            many = np.flatnonzero(size > 1)
            if len(many):
                told = size[many] if blocks else now[first[many] + 1]
                rule, name = np.unique(_codes(new[many], told), return_inverse=True)
                new[many] = fresh + name.ravel()
                fresh += len(rule)
            parent = np.zeros(len(now), np.int32)
            parent[first[1:]] = 1
            self.starts.append(np.append(first, len(now)).astype(np.int32))
            self.parents.append(np.cumsum(parent, dtype=np.int32))
            self.symbols.append(new)
            now = new

    @staticmethod
    def _block_starts(now: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, now[1:] != now[:-1]))

    def _pair_starts(self, now: np.ndarray) -> np.ndarray:
        real = (now[1:] >= 0) & (now[:-1] >= 0)
        best, wanted = None, np.count_nonzero(real) // 5
        for salt in range(8):  # of a few symbols all may fall on one side
            key = (8 * len(self.starts) + salt) * int(GOLD) % 2**64
            side = (mix(now.view(np.uint64) + np.uint64(key)) >> np.uint64(63)).astype(bool)
            both = real & (side[:-1] != side[1:])
            rising = both & side[1:]
            pair = rising if 2 * np.count_nonzero(rising) >= np.count_nonzero(both) else both & side[:-1]
            count = np.count_nonzero(pair)
            if best is None or count > best[0]:
                best = count, pair
            if count >= wanted:
                break
        pair = best[1]
        return np.flatnonzero(np.append(True, ~pair))

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols are equal from places i and j on, or before them if ``back``.

        Places of a pair must differ and not be the first. Up the levels, a
        place that is not at the near end of its parent takes one step (in a
        block: as far as the shorter rest goes); then either the symbols differ
        or both places are at the near end of their parents. Down again from
        the first difference, each level takes one step at most.
        """
        step = -1 if back else 1
        i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
        a, b = (i - 1, j - 1) if back else (i, j)
        live = np.arange(len(a))
        stuck: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for h, (symbol, start, parent) in enumerate(zip(self.symbols, self.starts, self.parents)):
            same = symbol[a] == symbol[b]
            stuck.append((live[~same], a[~same], b[~same]))
            live, a, b = live[same], a[same], b[same]
            rest_a, rest_b = _rest(start, parent, a, back), _rest(start, parent, b, back)
            if h % 2 == 0:  # to blocks: of equal rests both places leave their block, whole blocks are left to the level above
                near = _whole(start, parent, a, rest_a) & _whole(start, parent, b, rest_b)
                go = np.where(near, 0, np.minimum(rest_a, rest_b))
                a, b = a + step * go, b + step * go
                apart = ~near & (rest_a != rest_b)
                stuck.append((live[apart], a[apart], b[apart]))
                live, a, b = live[~apart], a[~apart], b[~apart]
            else:
                near = _whole(start, parent, a, rest_a) & _whole(start, parent, b, rest_b)
                a, b = np.where(near, a, a + step), np.where(near, b, b + step)
            a, b = parent[a].astype(np.int64), parent[b].astype(np.int64)
        stuck_at = {h: [] for h in range(len(self.symbols))}
        at = 0
        for h in range(len(self.starts)):
            for _ in range(2 if h % 2 == 0 else 1):
                stuck_at[h].append(stuck[at])
                at += 1
        stuck_at[len(self.starts)].append((live, a, b))
        who, a, b = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for h in range(len(self.symbols) - 1, -1, -1):
            if len(who):
                symbol, start, parent = self.symbols[h], self.starts[h], self.parents[h]
                a, b = (start[a + 1] - 1, start[b + 1] - 1) if back else (start[a], start[b])
                a, b = a.astype(np.int64), b.astype(np.int64)
                go = np.minimum(_rest(start, parent, a, back), _rest(start, parent, b, back)) if h % 2 == 0 else 1
                go = np.where(symbol[a] == symbol[b], go, 0)
                a, b = a + step * go, b + step * go
            who = np.concatenate([who, *(s[0] for s in stuck_at[h])])
            a = np.concatenate([a, *(s[1] for s in stuck_at[h])])
            b = np.concatenate([b, *(s[2] for s in stuck_at[h])])
        out = np.zeros(len(i), np.int64)
        out[who] = (i[who] - 1 - a) if back else (a - i[who])
        return out


def _codes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers below 2**31."""
    return (x << 31) | y


def _rest(start: np.ndarray, parent: np.ndarray, at: np.ndarray, back: bool) -> np.ndarray:
    """Symbols from a place to the far end of its parent, itself included."""
    own = parent[at]
    return (at - start[own] + 1) if back else (start[own + 1] - at)


def _whole(start: np.ndarray, parent: np.ndarray, at: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Whether the place is at the near end of its parent."""
    own = parent[at]
    return rest == start[own + 1] - start[own]


def cubic_runs(sequence: np.ndarray, owner: np.ndarray, longest: int, least: int, repeats: int, batch: int = 1 << 18) -> np.ndarray:
    """All maximal stretches between fences with smallest period q and length of at least ``least`` and ``repeats`` * q.

    Rows of (start, end, period), sorted. ``owner`` numbers the sequence that a
    place belongs to, ``longest`` is the length of the longest one.

    Such a stretch holds at least ``repeats`` neighbouring multiples of q, all
    with one symbol, so all places of the harmonic grid (q, 2q, 3q, ... for
    every q) are looked at, n log n in all. Where the symbols agree, exact
    extensions of the two first places give the whole stretch; of equal
    stretches that with the smallest period stays (longer than two periods, a
    stretch has its smallest period as a divisor of the others).
    """
    if repeats < 3:
        raise ValueError("grid candidates need three repeats at least")
    grammar = None
    found: list[np.ndarray] = []
    held: list[np.ndarray] = []
    waiting = 0

    def settle() -> None:
        nonlocal grammar, waiting
        if not waiting:
            return
        grammar = grammar or Grammar(sequence)
        place, period = np.concatenate(held, axis=1)
        held.clear()
        waiting = 0
        for k in range(0, len(place), batch):
            p, q = place[k:k + batch], period[k:k + batch]
            start = p - grammar.extend(p, p + q, back=True)
            end = p + q + grammar.extend(p, p + q)
            good = end - start >= np.maximum(least, repeats * q)
            found.append(np.unique(np.stack([start[good], end[good], q[good]], 1), axis=0))

    for q in range(1, longest // repeats + 1):
        grid = sequence[::q]
        m = len(grid) - repeats + 1
        if m < 1:
            break
        same = grid[:-1] == grid[1:]
        k = np.flatnonzero(same[:m] & same[1:m + 1])
        if not len(k):
            continue
        p = k * q
        middle = q // 2
        p = p[(owner[p] == owner[p + 2 * q]) & (sequence[p + middle] == sequence[p + q + middle])]
        if len(p):
            held.append(np.stack([p, np.full(len(p), q)]))
            waiting += len(p)
            if waiting >= batch:
                settle()
    settle()
    found = [f for f in found if len(f)]
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))
    rows = rows[first]
    return rows[np.lexsort([rows[:, 2], rows[:, 0]])]
