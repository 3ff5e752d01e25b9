"""Score-ordered agenda of adjacent symbol pairs.

A symbol is a number; the lowest rank is merged first and the leftmost of equal ranks before the others.
``merge`` keeps the agenda of one word in a heap. ``merge_many`` keeps the agendas of many words of one
length as a matrix of ranks, takes the best entry of each row at every step, and renews the entries on
both sides of the merged symbol. Both give the same symbols.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np

BITS = 21
NONE = np.iinfo(np.int32).max
LONG = 40
FACTOR = 0x9E3779B97F4A7C15


class Pairs:
    """Pairs of symbols that merge: ``(left, right) -> (rank, merged)``. ``find`` looks many pairs up in a
    hash table without collisions: the keys of one bucket are shifted together to free places."""

    def __init__(self, entries: dict[tuple[int, int], tuple[int, int]]):
        self.of = entries
        keys = np.array([a << BITS | b for a, b in entries], dtype=np.uint64)
        size = max(6, (4 * len(keys)).bit_length())  # bits of a place; four less tell the bucket
        self.mask, self.high, self.low = np.uint64((1 << size) - 1), np.uint64(68 - size), np.uint64(68 - 2 * size)
        factor = FACTOR
        while (shift := self.placed(keys, factor)) is None:
            factor = (factor * FACTOR + 2) % (1 << 64) | 1
        self.factor, self.shift = np.uint64(factor), shift
        at = self.places(keys)
        self.keys = np.full(1 << size, np.iinfo(np.uint64).max)
        self.rank, self.merged = (np.full(1 << size, NONE, np.int32) for _ in range(2))
        self.keys[at] = keys
        values = np.array([*entries.values()], dtype=np.int32).reshape(-1, 2)
        self.rank[at], self.merged[at] = values[:, 0], values[:, 1]

    def placed(self, keys: np.ndarray, factor: int) -> np.ndarray | None:
        """The shift of each bucket; none if two keys of a bucket fall on one place."""
        mixed = keys * np.uint64(factor)
        bucket, home = mixed >> self.high, mixed >> self.low & self.mask
        if len(np.unique(bucket << np.uint64(32) | home)) < len(keys):
            return None
        size = int(self.mask) + 1
        shift, taken = np.zeros(size >> 4, np.uint64), bytearray(size)
        order = np.argsort(bucket, kind="stable")
        of, first = np.unique(bucket[order], return_index=True)
        homes = np.split(home[order], first[1:])
        for k in sorted(range(len(of)), key=lambda k: -len(homes[k])):
            own = homes[k].tolist()
            move = next(d for d in range(size) if not any(taken[h + d & size - 1] for h in own))
            shift[of[k]] = move
            for h in own:
                taken[h + move & size - 1] = 1
        return shift

    def places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * self.factor
        return ((mixed >> self.low) + self.shift[mixed >> self.high] & self.mask).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left.astype(np.uint64) << np.uint64(BITS) | right.astype(np.uint64)
        at = self.places(wanted)
        return np.where(self.keys[at] == wanted, self.rank[at], NONE), self.merged[at]


def merge(symbols: list[int], pairs: Pairs) -> list[int]:
    n, find = len(symbols), pairs.of.get
    state: list[tuple | None] = [None] * n  # the entry that now holds at each left symbol
    agenda: list[tuple] = []

    def enter(i: int, j: int) -> None:
        found = find((symbols[i], symbols[j]))
        state[i] = entry = found and (found[0], i, found[1])
        if entry:
            heappush(agenda, entry)

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    for i in range(n - 1):
        enter(i, i + 1)
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        i = entry[1]
        if state[i] is not entry:
            continue
        symbols[i] = entry[2]
        j = after[i]
        k = after[i] = after[j]
        state[i], state[j], symbols[j] = None, None, -1
        if k < n:
            before[k] = i
            enter(i, k)
        if before[i] >= 0:
            enter(before[i], i)
    return [s for s in symbols if s >= 0]


def merge_many(symbols: np.ndarray, pairs: Pairs) -> list[tuple[np.ndarray, np.ndarray]]:
    """``symbols``: a row for each word. Gives (rows, their merged symbols) for each final length."""
    live, out = np.arange(len(symbols)), []
    rank, merged = pairs.find(symbols[:, :-1], symbols[:, 1:])
    while len(live):
        width = symbols.shape[1]
        best = rank.argmin(1) if width > 1 else np.zeros(len(live), np.int64)
        at = np.arange(len(live))
        going = rank[at, best] < NONE if width > 1 else np.zeros(len(live), bool)
        if not going.all():
            out.append((live[~going], symbols[~going]))
            live, symbols, rank, merged, best = live[going], symbols[going], rank[going], merged[going], best[going]
            at = np.arange(len(live))
        if not len(live):
            break
        symbols[at, best] = merged[at, best]
        drop = np.ones(symbols.shape, bool)
        drop[at, best + 1] = False
        symbols = symbols[drop].reshape(len(live), width - 1)
        if width == 2:
            out.append((live, symbols))
            break
        drop = np.ones(rank.shape, bool)
        drop[at, np.minimum(best, width - 2)] = False
        rank, merged = rank[drop].reshape(len(live), width - 2), merged[drop].reshape(len(live), width - 2)
        after, before = best < width - 2, best > 0
        rows, left = np.append(at[after], at[before]), np.append(best[after], best[before] - 1)
        rank[rows, left], merged[rows, left] = pairs.find(symbols[rows, left], symbols[rows, left + 1])
    return out


class Memo(dict):
    """What ``make`` gives for words, a list at a time. Kept for up to ``limit`` words of the present and of
    the last generation, so that a worker's memory is bounded and frequent words stay."""

    def __init__(self, make: Callable[[list], list], limit: int = 200_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def learn(self, words: Iterable) -> None:
        """Afterwards all of ``words`` are there."""
        asked = set(words)
        new = asked.difference(self)
        if len(self) + len(new) > self.limit:
            self.old = dict(self)
            self.clear()
            new = asked
        again = [w for w in new if w in self.old]
        self.update((w, self.old[w]) for w in again)
        unseen = list(new.difference(again))
        self.update(zip(unseen, self.make(unseen), strict=True))

    def forget(self) -> None:
        """A worker outlives its task: what the next one does there needs the memory."""
        self.clear()
        self.old = {}


def merged_rows(flat: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge words given as symbols in a row; gives (numbers of words, their equally long merged symbols)."""
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        which = np.flatnonzero(lengths == n)
        if n > LONG:
            for w in which:
                yield np.array([w]), np.array([merge(flat[starts[w] : starts[w] + n].tolist(), pairs)])
            continue
        for rows, ids in merge_many(flat[starts[which][:, None] + np.arange(n)], pairs):
            yield which[rows], ids


def merged_words(flat: np.ndarray, lengths: np.ndarray, pairs: Pairs, finish: Callable[[np.ndarray], list]) -> list:
    """Merge words given as symbols in a row; ``finish`` turns equally long rows of ids into values."""
    out: list = [None] * len(lengths)
    for which, ids in merged_rows(flat, lengths, pairs):
        for w, value in zip(which, finish(ids), strict=True):
            out[w] = value
    return out
