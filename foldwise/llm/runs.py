r"""Operator 12: periodic runs of words, by a suffix automaton whose link tree is accessed like a link-cut tree.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words and ``times`` periods
long, that no neighbouring word extends. For each text the suffix automaton of its words is built; its link
tree holds every repeated stretch of words, and the states on the way from a prefix to the root are the
suffixes of that prefix. The prefixes are then accessed in order. All states of a preferred path have the same
last end; accessing prefix i meets the paths above it one after the other, and one whose last end is p and
whose lowest state on the way is l words long says that the last l words stood at distance d = i - p before.
With l >= (times - 1) * d that is a run of period d up to here, which begins l + d words back: l is the longest such match, so
the beginning is exact, and the last end is the nearest, so the period is the smallest. The last prefix that
reports a beginning and a period is the run's end. The whole way then becomes one path with last end i. Paths are
splay trees: all accesses of n words take O(n log n) steps.

Words of a run lie in windows of ``window`` words that occur twice in the text (16 for 24 words and 3 periods), so
automata are built only for stretches of such words: a filter that loses nothing, as every run lies in one
stretch. Words are told apart by their bytes, not by hashes. A text is worked on in one task, and takes memory in
proportion to its longest stretch of repeated words.

Words are maximal runs without the bytes 0x20 and 0x09-0x0D; null and empty texts have none, and no run. Ties
for the run with the greatest exponent go to the smallest start, then period. Repeated rows, and rows with a
null id, are texts of their own. Other columns play no part. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foldwise.llm.common import slices

LEAST, TIMES = 24, 3


def window(least: int, times: int) -> int:
    """The shortest match that any run leaves at the distance of its period."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: for each state its length and link (0: the root), and the state of each prefix."""
    length, link, step, prefix = [0], [-1], [{}], []
    last = 0
    for i, w in enumerate(words, 1):
        state = len(length)
        length.append(i)
        link.append(0)
        step.append({})
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = state
            p = link[p]
        if p >= 0:
            q = step[p][w]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                step.append(dict(step[q]))
                while p >= 0 and step[p].get(w) == q:
                    step[p][w] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
        prefix.append(state)
    return length, link, prefix


def repeats(words: Sequence[int], least: int, times: int) -> dict[tuple[int, int], int]:
    """Runs of ``words`` as {(start, period): length}.

    ``up`` is a state's parent in its splay tree, or, at the top of one, the state its path hangs on;
    ``low`` and ``high`` are its children, nearer to and farther from the root of the link tree."""
    length, up, prefix = automaton(words)
    size = len(length)
    low, high, seen = [0] * size, [0] * size, [-1] * size  # 0, the root, is never a child: it means none
    up[0] = 0
    out: dict[tuple[int, int], int] = {}

    def to_top(x: int) -> None:
        """Splay ``x`` to the top of its tree, which keeps the last end at its top."""
        while True:
            p = up[x]
            if not p or (low[p] != x and high[p] != x):
                return
            g = up[p]
            inner = g and (low[g] == p or high[g] == p)
            for y in ((p if (low[g] == p) == (low[p] == x) else x), x) if inner else (x,):
                z = up[y]  # turn y over its parent z
                above = up[z]
                if low[z] == y:
                    inside = low[z] = high[y]
                    high[y] = z
                else:
                    inside = high[z] = low[y]
                    low[y] = z
                if inside:
                    up[inside] = z
                if low[above] == z:
                    if above:
                        low[above] = y
                elif high[above] == z and above:
                    high[above] = y
                else:
                    seen[y] = seen[z]  # z was the top
                up[y] = above
                up[z] = y

    for i, state in enumerate(prefix):
        x, below = state, 0
        while x:
            to_top(x)
            p = seen[x]
            if p >= 0:
                d, long = i - p, length[x]
                if long >= (times - 1) * d and long + d >= least:
                    out[i - long - d + 1, d] = long + d
            if high[x]:
                seen[high[x]] = p
            high[x] = below
            below, x = x, up[x]
        seen[below] = i
    return out


def stretches(ids: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal stretches of words inside windows of ``size`` words that occur more than once."""
    if len(ids) < size + 1:
        return []
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    keys = np.zeros(len(ids) - size + 1, dtype=np.uint64)
    for k in range(size):
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + mixed[k : len(ids) - size + 1 + k]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + size, -1)
    inside = np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]])
    turns = np.diff(inside)
    return list(zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist(), strict=True))


def find_runs(words: Sequence, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start and period."""
    if len(words) < least:
        return []
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return []
    out = []
    for a, b in stretches(ids, window(least, times)):
        if b - a >= least:
            out += [(a + start, long, period) for (start, period), long in repeats(ids[a:b].tolist(), least, times).items()]
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapsed(words: Sequence, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return list(words)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, long, period in runs:
        gone[start + period] += 1
        gone[start + long] -= 1
    return [w for w, n in zip(words, np.cumsum(gone)[:-1].tolist(), strict=True) if not n]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's own input: every tenth document repeats one stretch from some word to its end."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


SHAPE = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def digests(docs: DataFrame, least: int = LEAST, times: int = TIMES, rewrite: Callable[[int | None, list[bytes]], list[bytes]] = planted) -> DataFrame:
    """A row for each document: its runs and what is left without their repetitions, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = None
        for part in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = rewrite(doc_id, (text or "").encode().split())  # bytes split at 0x20 and 0x09-0x0D
                runs = find_runs(words, least, times)
                start, long, period = strongest(runs) or (None, None, None)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                left = b" ".join(collapsed(words, runs) if runs else words)
                rows.append((doc_id, len(runs), start, long, period, 1000 * long // period if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()))
            shape = shape or pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in SHAPE.split(", ")])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types, strict=True)], schema=shape)

    return docs.select("doc_id", "text").mapInArrow(run, SHAPE)
