"""Random forests and boosted trees of two classes, fitted for all folds at once on rows put into bins beforehand.

The algorithms are those of Spark ML's ``RandomForestClassifier`` and ``GBTClassifier``: at most ``BINS`` bins a feature with
the same thresholds (from the same number of sampled training rows of each fold), trees grown level by level on histograms, best gain
(gini or entropy; variance of the log loss's gradients), leaves where nothing is gained, sibling leaves of one class put together in
forests, a Poisson bag of all training rows for each tree of a forest and about the square root of the features for each of its nodes. Boosted
trees hold no chance and equal Spark's; forests draw other bags.

Spark keeps an object of each row for each fit, and one job for each fold and level. Here a row is put into bins once for a search, one byte for
each feature and fold, in blocks of ``BLOCK`` rows that trials and folds share. A level of all folds and trees is one job, from which the
driver gets histograms (or several jobs, so that a task's histograms stay under ``HISTOGRAM_BYTES``).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS, BLOCK, SAMPLED, DEEPEST, HISTOGRAM_BYTES, SCORES = 32, 16_384, 10_000, 8, 16 << 20, 500_000
TAKES = {"rf": {"maxDepth", "numTrees", "impurity", "seed"}, "gbt": {"maxDepth", "maxIter", "stepSize", "seed"}}
USUAL = {"rf": {"maxDepth": 5, "numTrees": 20, "impurity": "gini", "seed": 42}, "gbt": {"maxDepth": 5, "maxIter": 20, "stepSize": 0.1, "seed": 42}}
STAY = 255  # the threshold of a leaf: all rows go on to its left child, which stands for it


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Spark ML's split points of a feature: between all distinct values, or where the counts come next to equal shares."""
    level, count = np.unique(values[np.isfinite(values)], return_counts=True)
    between = (level[:-1] + level[1:]) / 2.0
    if len(between) > bins - 1:
        stride = len(values) / bins
        target, kept, total = stride, [], int(count[0])
        for i in range(1, len(level)):
            before, total = total, total + int(count[i])
            if abs(before - target) < abs(total - target):
                kept.append(between[i - 1])
                target += stride
        between = np.array(kept)
    return between


class Tree:
    """A whole binary tree by levels: of each inner place a feature and the last bin that goes left; a value for each leaf."""

    def __init__(self, depth: int):
        self.depth = depth
        self.feature = np.zeros((1 << depth) - 1, dtype=np.int64)
        self.cut = np.full((1 << depth) - 1, STAY, dtype=np.uint8)
        self.value = np.zeros(1 << depth)

    def place(self, x: np.ndarray, levels: int) -> np.ndarray:
        """Of each row (a column of ``x``) its place in a level."""
        n = x.shape[1]
        at, over, here = np.zeros(n, dtype=np.uint8), np.empty(n, dtype=bool), np.empty(n, dtype=bool)
        for level in range(levels):
            start, wide = (1 << level) - 1, 1 << level
            feature, cut = self.feature[start : start + wide], self.cut[start : start + wide]
            splits = np.flatnonzero(cut != STAY).tolist()
            if len(splits) <= 12:
                go = np.zeros(n, dtype=bool)
                for j in splits:
                    np.greater(x[feature[j]], cut[j], out=over)
                    if level:
                        np.equal(at, j, out=here)
                        np.logical_and(over, here, out=over)
                    np.logical_or(go, over, out=go)
            else:
                go = x.ravel().take((feature * n).take(at) + np.arange(n)) > cut.take(at)
            np.left_shift(at, 1, out=at)
            np.bitwise_or(at, go.view(np.uint8), out=at)
        return at

    def values(self, x: np.ndarray) -> np.ndarray:
        return self.value.take(self.place(x, self.depth))


def _margin(trees: list[Tree], step: float, x: np.ndarray) -> np.ndarray:
    out = trees[0].values(x) if trees else np.zeros(x.shape[1])
    for t in trees[1:]:
        out += step * t.values(x)
    return out


BAGGED = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.uint8)


def _bag(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """Poisson(1) weights of a block's rows for one tree, the same in each pass and for all folds."""
    return BAGGED.take(np.random.default_rng([seed, tree, block]).integers(0, 1 << 16, n, dtype=np.uint16))


def _without(rows: np.ndarray, own: slice) -> np.ndarray:
    return np.concatenate([rows[..., : own.start], rows[..., own.stop :]], axis=-1)


def _impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    share = counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1e-300)
    if kind == "gini":
        return 1.0 - (share * share).sum(axis=-1)
    return -(share * np.log2(np.where(share > 0, share, 1.0))).sum(axis=-1)


def _best(stats: np.ndarray, kind: str, allowed: np.ndarray) -> tuple:
    """Of each node (nodes, features, bins, statistics): feature and bin of the best split, its gain, the statistics of both sides.
    Statistics are rows of each class, or rows and the sum of their gradients."""
    left = np.cumsum(stats, axis=2)[:, :, :-1]
    total = stats.sum(axis=2)[:, :, None]
    right = total - left
    size = (lambda s: s[..., 0]) if kind == "variance" else (lambda s: s.sum(axis=-1))
    n, nl, nr = size(total), size(left), size(right)
    with np.errstate(invalid="ignore", divide="ignore"):
        if kind == "variance":
            gain = (left[..., 1] ** 2 / nl + right[..., 1] ** 2 / nr - total[..., 1] ** 2 / n) / n
        else:
            gain = _impurity(total, kind) - nl / n * _impurity(left, kind) - nr / n * _impurity(right, kind)
    gain = np.where((nl > 0) & (nr > 0) & allowed[:, :, None], gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    feature, cut = np.divmod(at, gain.shape[2])
    node = np.arange(len(gain))
    return feature, cut, flat[node, at], left[node, feature, cut], right[node, feature, cut]


class BinnedRows:
    """The rows of a search in bins, and the fits on them. ``data``: ``features``, a label of 0 and 1, a fold."""

    def __init__(self, data: DataFrame, label: str, fold_col: str, k: int, cuts: list[list[np.ndarray]]):
        self.label, self.fold_col, self.k, self.cuts = label, fold_col, k, cuts
        self.spark, self.fold_type, self.width = data.sparkSession, data.schema[fold_col].dataType.simpleString(), len(cuts[0])
        wide = self.width

        def put(batches):
            from pyspark import TaskContext

            block, held, count = TaskContext.get().partitionId() << 32, [], 0
            for batch in batches:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)
                if not np.isfinite(x).all():
                    raise ValueError("Vector values MUST NOT be NaN or Infinity")  # Spark ML refuses them, too
                held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), x))
                count += len(x)
                while count >= BLOCK:
                    fold, y, x = (np.concatenate(c) for c in zip(*held, strict=True))
                    yield _packed(block, fold[:BLOCK], y[:BLOCK], x[:BLOCK], cuts)
                    held, count, block = [(fold[BLOCK:], y[BLOCK:], x[BLOCK:])], count - BLOCK, block + 1
            if count:
                yield _packed(block, *(np.concatenate(c) for c in zip(*held, strict=True)), cuts)

        own = F.when(F.col(fold_col).between(0, k - 1), F.col(fold_col)).otherwise(k).cast("int")  # k: a fold that trains and is not scored
        rows = data.where(F.col(fold_col).isNotNull()).select(own.alias("fold"), F.col(label).cast("int").alias("y"), vector_to_array("features").alias("x"))
        self.blocks = rows.mapInArrow(put, "block long, n int, bytes binary").persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks.count()  # filled once, before trials run together

    def unpersist(self):
        self.blocks.unpersist()

    def takes(self, kind: str, params: dict) -> bool:
        p = {**USUAL.get(kind, {}), **params}
        return kind in TAKES and set(params) <= TAKES[kind] and 1 <= p["maxDepth"] <= DEEPEST and p.get("impurity", "gini") in ("gini", "entropy") and p.get("maxIter", 1) >= 1 and p.get("numTrees", 2) >= 2

    def _mapped(self, work, shape: str, schema: pa.Schema) -> DataFrame:
        """``work(blocks)`` yields tables; ``blocks`` are (number, the rows of each fold, labels, bins of (fold, feature, row))."""
        k, wide = self.k, self.width

        def run(batches):
            def opened():
                for batch in batches:
                    for block, n, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                        raw = np.frombuffer(held.as_buffer(), dtype=np.uint8)
                        ends = np.searchsorted(raw[:n], np.arange(k + 1)).tolist()
                        yield block, [slice(*e) for e in zip(ends, ends[1:], strict=False)], raw[n : 2 * n], raw[2 * n :].reshape(k, wide, n)

            for out in work(opened()):
                yield from pa.table(out, schema=schema).to_batches()

        tasks = max(1, 2 * self.spark.sparkContext.defaultParallelism)
        return self.blocks.coalesce(tasks).mapInArrow(run, shape)

    def _histograms(self, pieces: list[tuple], per_piece: int, add) -> list[np.ndarray]:
        """One histogram (flat) for each piece, summed over all rows: ``add(piece, block, y, x, memo, out)`` adds a block's training rows."""
        pieces_a_job, found = max(1, HISTOGRAM_BYTES // (8 * per_piece)), []
        for lo in range(0, len(pieces), pieces_a_job):
            some = pieces[lo : lo + pieces_a_job]

            def work(blocks, some=some):
                sums = np.zeros((len(some), per_piece))
                for block, folds, y, x in blocks:
                    at, bags = None, {}
                    for i, piece in enumerate(some):  # pieces come by folds
                        if piece[0] != at:
                            at, memo = piece[0], {}
                            own_y, own_x = _without(y, folds[at]), _without(x[at], folds[at])
                        if len(own_y):
                            add(piece, (block, len(y), folds[at], bags), own_y, own_x, memo, sums[i])
                yield {"bytes": [sums.tobytes()]}

            total = np.zeros((len(some), per_piece))
            for row in self._mapped(work, "bytes binary", pa.schema([("bytes", pa.binary())])).collect():  # a row for each task
                total += np.frombuffer(row["bytes"]).reshape(total.shape)
            found.extend(total)
        return found

    def oof(self, kind: str, params: dict) -> DataFrame:
        """Out-of-fold probabilities, rows alike put together: fold, label, ``probs`` and ``_rows``, how many rows have them."""
        p = {**USUAL[kind], **params}
        trees = self._forests(p) if kind == "rf" else self._boosted(p)
        k, step = self.k, p.get("stepSize")

        def work(blocks):
            held: dict[tuple, list] = {}

            def told():
                for (f, c), parts in held.items():
                    score, at = np.unique(np.concatenate([s for s, _ in parts]), return_inverse=True)
                    n = np.bincount(at, weights=np.concatenate([m for _, m in parts]), minlength=len(score)).astype(np.int64)
                    yield {"fold": np.full(len(score), f), "y": np.full(len(score), c), "p1": score, "n": n}
                held.clear()

            waiting = 0
            for _, folds, y, x in blocks:
                for f, own in enumerate(folds):
                    if own.stop > own.start:
                        at = np.ascontiguousarray(x[f][:, own])
                        if kind == "rf":
                            score = sum(t.values(at) for t in trees[f]) / len(trees[f])
                        else:
                            score = 1.0 / (1.0 + np.exp(-2.0 * _margin(trees[f], step, at)))
                        for c in (0, 1):
                            part, n = np.unique(score[y[own] == c], return_counts=True)
                            held.setdefault((f, c), []).append((part, n))
                            waiting += len(part)
                if waiting > SCORES:
                    yield from told()
                    waiting = 0
            yield from told()

        schema = pa.schema([("fold", pa.int64()), ("y", pa.int64()), ("p1", pa.float64()), ("n", pa.int64())])
        found = self._mapped(work, "fold long, y long, p1 double, n long", schema)
        return found.select(F.col("fold").cast(self.fold_type).alias(self.fold_col), F.col("y").cast("double").alias(self.label), F.array(1 - F.col("p1"), F.col("p1")).alias("probs"), F.col("n").alias("_rows"))

    def _forests(self, p: dict) -> list[list[Tree]]:
        depth, many, seed, wide = p["maxDepth"], p["numTrees"], p["seed"] % (1 << 63), self.width
        trees = [[Tree(depth) for _ in range(many)] for _ in range(self.k)]
        counts = [[np.zeros(((2 << depth) - 1, 2)) for _ in range(many)] for _ in range(self.k)]
        subset = max(1, math.ceil(math.sqrt(wide)))
        open_ = {(f, t): np.array([True]) for f in range(self.k) for t in range(many)}
        for level in range(depth):
            nodes, start = 1 << level, (1 << level) - 1
            pieces = [key for key in open_ if open_[key].any()]

            def add(piece, where, y, x, memo, out, level=level, nodes=nodes):
                block, n, own, bags = where
                if piece[1] not in bags:
                    bags[piece[1]] = _bag(seed, piece[1], block, n)
                base = trees[piece[0]][piece[1]].place(x, level).astype(np.int64)
                base *= BINS * 2
                base += y
                weight, each = _without(bags[piece[1]], own).astype(np.float64), nodes * BINS * 2
                for j in range(wide):
                    out[j * each : (j + 1) * each] += np.bincount(base + memo.setdefault(j, x[j].astype(np.int64) * 2), weights=weight, minlength=each)

            for (f, t), flat in zip(pieces, self._histograms(pieces, wide * nodes * BINS * 2, add), strict=True):
                stats = flat.reshape(wide, nodes, BINS, 2).transpose(1, 0, 2, 3)
                if level == 0:
                    counts[f][t][0] = stats[0, 0].sum(axis=0)
                rng = [np.random.default_rng([seed, t, start + i]) for i in range(nodes)]
                allowed = np.zeros((nodes, wide), dtype=bool)
                for i in range(nodes):
                    allowed[i, rng[i].choice(wide, subset, replace=False)] = True
                feature, cut, gain, left, right = _best(stats, p["impurity"], allowed)
                splits = open_[f, t] & (gain > 0)
                below = np.zeros(2 * nodes, dtype=bool)
                for i in range(nodes):
                    at = start + i
                    counts[f][t][2 * at + 1] = counts[f][t][at]
                    if splits[i]:
                        trees[f][t].feature[at], trees[f][t].cut[at] = feature[i], cut[i]
                        counts[f][t][2 * at + 1], counts[f][t][2 * at + 2] = left[i], right[i]
                        below[2 * i] = below[2 * i + 1] = True
                open_[f, t] = below
            for key in set(open_) - set(pieces):
                for at in range(start, start + nodes):
                    counts[key[0]][key[1]][2 * at + 1] = counts[key[0]][key[1]][at]
                open_[key] = np.zeros(2 * nodes, dtype=bool)
        for f in range(self.k):
            for tree, count in zip(trees[f], counts[f], strict=True):
                _joined(tree, count)
        return trees

    def _boosted(self, p: dict) -> list[list[Tree]]:
        depth, step, wide, k = p["maxDepth"], p["stepSize"], self.width, self.k
        trees: list[list[Tree]] = [[] for _ in range(k)]
        for _ in range(p["maxIter"]):
            fresh, sums = [Tree(depth) for _ in range(k)], [np.zeros(((2 << depth) - 1, 2)) for _ in range(k)]
            open_ = [np.array([True]) for _ in range(k)]
            for level in range(depth):
                nodes, start = 1 << level, (1 << level) - 1

                def add(piece, where, y, x, memo, out, level=level, nodes=nodes, fresh=fresh):
                    f, sign = piece[0], 2.0 * y - 1.0
                    each = nodes * BINS
                    gradient = 4.0 * sign / (1.0 + np.exp(2.0 * sign * _margin(trees[f], step, x))) if trees[f] else sign  # the first tree is of the labels
                    base = fresh[f].place(x, level).astype(np.int64) * BINS
                    for j in range(wide):
                        at = base + x[j]
                        out[2 * j * each : (2 * j + 1) * each] += np.bincount(at, minlength=each)
                        out[(2 * j + 1) * each : (2 * j + 2) * each] += np.bincount(at, weights=gradient, minlength=each)

                pieces = [(f,) for f in range(k) if open_[f].any()]
                for (f,), flat in zip(pieces, self._histograms(pieces, wide * nodes * BINS * 2, add), strict=True):
                    stats = flat.reshape(wide, 2, nodes, BINS).transpose(2, 0, 3, 1)
                    if level == 0:
                        sums[f][0] = stats[0, 0].sum(axis=0)
                    feature, cut, gain, left, right = _best(stats, "variance", np.ones((nodes, wide), dtype=bool))
                    splits = open_[f] & (gain > 0)
                    open_[f] = np.repeat(splits, 2)
                    for i in range(nodes):
                        at = start + i
                        sums[f][2 * at + 1] = sums[f][at]
                        if splits[i]:
                            fresh[f].feature[at], fresh[f].cut[at] = feature[i], cut[i]
                            sums[f][2 * at + 1], sums[f][2 * at + 2] = left[i], right[i]
                for f in set(range(k)) - {f for f, in pieces}:
                    for at in range(start, start + nodes):
                        sums[f][2 * at + 1] = sums[f][at]
            for f in range(k):
                last = sums[f][(1 << depth) - 1 :]
                fresh[f].value = last[:, 1] / np.maximum(last[:, 0], 1.0)
                trees[f].append(fresh[f])
        return trees


def _joined(tree: Tree, count: np.ndarray) -> None:
    """Sibling leaves of the same class become one leaf, from below; then the leaves get their shares of class 1."""
    inner = len(tree.cut)
    leaf = np.ones(2 * inner + 1, dtype=bool)
    for at in range(inner - 1, -1, -1):
        if tree.cut[at] != STAY:
            a, b = 2 * at + 1, 2 * at + 2
            leaf[at] = leaf[a] and leaf[b] and count[a].argmax() == count[b].argmax()
            if leaf[at]:
                tree.cut[at] = STAY
    for at in range(inner):
        if tree.cut[at] == STAY:
            count[2 * at + 1] = count[at]
    last = count[inner:]
    tree.value = last[:, 1] / np.maximum(last.sum(axis=1), 1.0)


def _packed(block: int, fold: np.ndarray, y: np.ndarray, x: np.ndarray, cuts: list) -> pa.RecordBatch:
    """Fold, label, and for each fold the bins of each feature, a byte each; rows in order of their folds."""
    order = np.argsort(fold, kind="stable")
    fold, y, x = fold[order], y[order], x[order]
    parts = [fold.astype(np.uint8), y.astype(np.uint8)]
    parts += [np.searchsorted(c, x[:, j], side="left").astype(np.uint8) for own in cuts for j, c in enumerate(own)]
    held = np.concatenate(parts).tobytes()
    return pa.record_batch([pa.array([block], pa.int64()), pa.array([len(y)], pa.int32()), pa.array([held], pa.binary())], names=["block", "n", "bytes"])


def binned(data: DataFrame, label: str, fold_col: str, k: int, seed: int = 42) -> BinnedRows | None:
    """The rows in bins; nothing where they are no case for two classes of whole labels 0 and 1 and folds that all have training rows."""
    known = F.col(label).isin(0, 1)
    sizes = data.where(F.col(fold_col).isNotNull()).groupBy(F.col(fold_col).alias("f")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(known, F.lit(False))).alias("sound")).collect()  # a row for each fold
    rows = {r["f"]: r["n"] for r in sizes}
    train = [sum(rows.values()) - rows.get(f, 0) for f in range(k)]
    if k > 250 or not rows or min(train) == 0 or any(r["n"] != r["sound"] for r in sizes) or not all(isinstance(f, int) for f in rows):
        return None
    share = min(1.0, max(max(BINS * BINS, SAMPLED) / n for n in train))
    some = data.where(F.col(fold_col).isNotNull()).select(F.col(fold_col).alias("f"), vector_to_array("features").alias("x"))
    some = (some if share >= 1 else some.sample(False, share, seed)).toPandas()  # some ten thousand rows for each fold
    fold, x = some["f"].to_numpy(), np.stack(some["x"].to_numpy()).astype(np.float64)
    cuts = [[thresholds(x[fold != f, j], min(BINS, train[f])) for j in range(x.shape[1])] for f in range(k)]
    return BinnedRows(data, label, fold_col, k, cuts)
