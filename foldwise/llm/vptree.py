"""Operator 9: approximate nearest neighbours by vantage-point trees, one for each shard.

The measure is the largest inner product. A shard is scaled to a largest norm of 1, each of its vectors gets
one more component, sqrt(1 - |x|**2), and queries are scaled to a norm of 1, so that all have one length and
the order by inner product is the order by Euclidean distance, which a vantage-point tree can prune by the
triangle inequality. A node holds a vantage point and the median distance to it; a query first goes to its
own side, with the far side left out if ``factor`` times its distance from the border exceeds the query's
k-th best distance. A factor of 1 leaves out only what cannot hold a nearer vector, which is exact.

Each tree is built once and written to the shared folder; blocks of queries then meet the stored trees. Unless a
factor is given, each tree learns its own when it is built: ``SAMPLE`` of its rows ask it, and the largest of
``FACTORS`` that finds ``RECALL`` of the neighbours that a scan of the shard finds is kept, 1 if none does. So a shard
whose norms are uneven, where pruning by distance misleads, is searched exactly, and one whose distances hardly differ
is compared nearly whole. Every row is indexed. Leaves are compared by matrix products; scores are then taken anew on the
original vectors in double precision, each in one fixed order of summation.

Vectors that are null, zero, or hold null or non-finite components take no part; vectors of another length than
most have raise an error that names it. Of repeated ids the smallest vector stands. Equal scores go to the smaller id. Other
columns play no part. An empty table gives no rows. Vectors that coincide (a border of distance 0 on both sides) end in one
leaf, which is compared whole, in blocks.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import kept
from foldwise.llm.topk import BLOCK_ROWS, matrix, merged, of_one_length, usable

SHARD_ROWS, LEAF, CELLS = 8192, 128, 2_000_000
SAMPLE, RECALL = 64, 0.95
FACTORS = (1.25, 1.6, 2.0, 2.5, 3.2, 4.0, 5.0, 6.3, 8.0, 10.0, 12.5, 16.0)
SLACK = 1e-9  # of squared distances between vectors of length 1, far above their rounding


class Tree:
    """Rows are sorted so that each node owns a stretch of them."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf, self.compared = points, leaf, 0
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (start, stop, vantage, border, inner, outer); vantage -1: a leaf
        if len(points):
            self.build(0, len(points))

    def build(self, start: int, stop: int) -> int:
        at = len(self.nodes)
        self.nodes.append((start, stop, -1, 0.0, -1, -1))
        if stop - start <= self.leaf:
            return at
        own = self.order[start:stop]
        # the farthest row from the first one stands at the rim, where medians cut best
        far = np.linalg.norm(self.points[own] - self.points[own[0]], axis=1)
        vantage = own[int(np.argmax(far))]
        d = np.linalg.norm(self.points[own] - self.points[vantage], axis=1)
        border = float(np.median(d))
        inside = d < border
        if not inside.any():  # half or more lie on the border: cut behind it
            inside = d <= border
        if inside.all():
            return at
        self.order[start:stop] = np.concatenate([own[inside], own[~inside]])
        middle = start + int(inside.sum())
        border = (float(d[inside].max()), float(d[~inside].min()))
        inner = self.build(start, middle)
        outer = self.build(middle, stop)
        self.nodes[at] = (start, stop, vantage, border, inner, outer)
        return at

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> list[np.ndarray]:
        """For each query the rows of at least its k nearest found; ``own`` is the row of the query itself or -1."""
        n = len(queries)
        self.queries, self.own, self.k, self.factor = queries, own, k, factor
        self.squares = (self.points**2).sum(1)
        self.limit = np.full(n, np.inf)
        self.near = np.full((n, k), np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # queries, rows, squared distances
        if self.nodes and n:
            self.visit(0, np.arange(n))
        if not self.found:
            return [np.zeros(0, int)] * n
        who, rows, d = (np.concatenate(x) for x in zip(*self.found, strict=True))
        near = np.flatnonzero(d <= self.near.max(1)[who] + SLACK)
        near = near[np.argsort(who[near], kind="stable")]
        return np.split(rows[near], np.searchsorted(who[near], np.arange(1, n)))

    def visit(self, at: int, who: np.ndarray) -> None:
        start, stop, vantage, border, inner, outer = self.nodes[at]
        if vantage < 0:
            self.compare(self.order[start:stop], who)
            return
        d = np.linalg.norm(self.queries[who] - self.points[vantage], axis=1)
        low, high = border
        first_in = d - low <= high - d
        for child, some in ((inner, first_in), (outer, ~first_in)):
            if some.any():
                self.visit(child, who[some])
        for child, gap, some in ((outer, high - d, first_in), (inner, d - low, ~first_in)):
            some = some & (self.factor * gap <= self.limit[who])
            if some.any():
                self.visit(child, who[some])

    def compare(self, rows: np.ndarray, who: np.ndarray) -> None:
        step = max(1, CELLS // max(len(who), 1))
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            self.compared += len(part) * len(who)
            q = self.queries[who]
            d = (q**2).sum(1)[:, None] + self.squares[part] - 2 * (q @ self.points[part].T)
            d[self.own[who][:, None] == part] = np.inf
            nearest = np.partition(np.hstack([self.near[who], d]), self.k - 1, axis=1)[:, : self.k]
            self.near[who] = nearest
            bound = nearest.max(1) + SLACK  # rounding hides no tie
            self.limit[who] = np.sqrt(np.maximum(bound, 0))
            i, j = np.nonzero((d <= bound[:, None]) & np.isfinite(d))
            self.found.append((who[i], part[j], d[i, j]))


def scaled(v: np.ndarray, by_row: bool) -> np.ndarray:
    """Divided by the norm of each row, or by the largest; neither overflows nor vanishes on the way."""
    v = v / np.abs(v).max(axis=1 if by_row else None, keepdims=True)
    norm = np.sqrt((v**2).sum(1))
    return v / (norm[:, None] if by_row else norm.max())


def longer(v: np.ndarray) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(1 - (v**2).sum(1), 0))[:, None]])


def learned(tree: Tree, base: np.ndarray, k: int) -> float:
    """The largest factor with which the shard's own sample finds its neighbours; of a recall that falls with the
    factor, so the first that fails ends the search."""
    asked = np.linspace(0, len(base) - 1, min(SAMPLE, len(base))).astype(int)
    queries = np.hstack([scaled(base[asked], True), np.zeros((len(asked), 1))])
    scores = queries @ tree.points.T
    scores[np.arange(len(asked)), asked] = -np.inf
    right = [set(x.tolist()) for x in np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(base) - 1)]]
    total = sum(map(len, right))
    found_all = 1.0
    for factor in FACTORS if total else ():
        hits = 0
        for i, some in enumerate(tree.search(queries, asked, k, factor)):
            top = some[np.argsort(-scores[i, some], kind="stable")[:k]]
            hits += len(right[i] & set(top.tolist()))
        if hits < RECALL * total:
            break
        found_all = factor
    return found_all


def grown(shard: pd.DataFrame, k: int, factor: float | None) -> bytes:
    """A shard's tree with its ids and vectors, as bytes."""
    shard = shard.sort_values("id")
    base = matrix(shard["v"])
    tree = Tree(longer(scaled(base, False)))
    used = learned(tree, base, k) if factor is None else factor
    out = io.BytesIO()
    np.savez(out, ids=shard["id"].to_numpy(), base=base, order=tree.order, nodes=np.array([(s, e, v, i, o) for s, e, v, _, i, o in tree.nodes]), borders=np.array([b if v >= 0 else (0.0, 0.0) for _, _, v, b, _, _ in tree.nodes]), factor=used)
    return out.getvalue()


def planted(stored: bytes) -> tuple[Tree, np.ndarray, np.ndarray, float]:
    """The tree, its ids, its vectors and its factor."""
    x = np.load(io.BytesIO(stored))
    tree = Tree(np.zeros((0, 1)))
    tree.points, tree.order = longer(scaled(x["base"], False)), x["order"]
    tree.nodes = [(s, e, v, tuple(b), i, o) for (s, e, v, i, o), b in zip(x["nodes"].tolist(), x["borders"].tolist(), strict=True)]
    return tree, x["ids"], x["base"], float(x["factor"])


def tile(queries: pd.DataFrame, stored: bytes, k: int) -> pd.DataFrame:
    queries = queries.sort_values("id")
    tree, ids, base, factor = planted(stored)
    asked, q = queries["id"].to_numpy(), matrix(queries["v"])
    place = np.searchsorted(ids, asked)
    own = np.where((place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == asked), place, -1)
    found = tree.search(np.hstack([scaled(q, True), np.zeros((len(q), 1))]), own, k, factor)
    out = []
    for i, some in enumerate(found):
        some = np.sort(some)
        scores = (base[some] * q[i]).sum(1)
        top = np.argsort(-scores, kind="stable")[:k]
        out.append((np.full(len(top), asked[i]), ids[some[top]], scores[top], np.full(len(top), tree.compared / max(1, len(ids) * len(found)))))
    query_id, vec_id, score, share = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score, "share": share})


def forest(whole: DataFrame, shards: int, k: int, factor: float | None) -> DataFrame:
    """``shard``, ``tree``: written once."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "tree": [grown(rows, k, factor)]})

    dealt = whole.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(shards)).cast("int"))
    return kept(dealt.groupBy("shard").applyInPandas(run, "shard int, tree binary"), "trees")


def search(vectors: DataFrame, is_query: Column, k: int = 20, factor: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``, and ``share``, the part of its shard that the query's block was
    compared with; ``is_query`` speaks of the column ``id``. Without a ``factor`` each tree learns its own."""
    whole = usable(vectors, id_col, vector_col).filter(F.exists("v", lambda x: x != 0))
    facts = whole.agg(F.count("*").alias("n"), F.count_if(is_query).alias("asked"), *of_one_length()).first()
    of_one_length(facts)
    shards, blocks = max(1, -(-facts["n"] // SHARD_ROWS)), max(1, -(-facts["asked"] // BLOCK_ROWS))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = whole.filter(is_query).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("shard", each(shards))
    right = forest(whole, shards, k, factor).withColumn("block", each(blocks))

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "share": [], "shard": []})
        return tile(a, b["tree"].iloc[0], k).assign(shard=key[1])

    tiles = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(run, "query_id long, vec_id long, score double, share double, shard long")
    return merged(tiles, k, shards).select("query_id", "rank", "vec_id", "score", "share")
