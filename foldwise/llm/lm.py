"""Operator 6: language-model scores by deleted interpolation.

The probability of a word after two others is a mixture of maximum-likelihood estimates: of the triple, of
the pair, of the word, and a uniform share for what was never seen. The mixture depends on the bucket of
the context's count: of the two words before, or of the one before where those two were never seen
together. Counts up to 8 are buckets of their own, larger ones share half a power of two. An order whose
context was never seen has weight 0, so the shares of all words and of the unseen always make 1. The weights
come from expectation-maximisation: one part of the training texts is deleted from the counts, and its
tokens are what the weights are fitted to; a bucket of few tokens leans on all buckets of its order.

How counts meet texts at scale: texts are packed into blocks of a few megabytes, written once. Each
block's distinct n-grams (64-bit hashes, sorted, with the counts of the block) are cut into parts by hash
range. Each part adds up its share of all blocks, so an n-gram is one entry for each block however often
it occurs, and sends each block the totals in the block's own order. A block then holds the counts of
exactly its own n-grams. Parts and blocks are of bounded size, and their number grows with the corpus.

A block cuts its n-grams at most 2**FAN ways. Where more parts are needed, the exchange has levels: at
each level a group of askers that share a hash range is merged into one, whose n-grams are cut by the next
bits; the answers come back the same way. Groups are as many as parts at every level, so the cells grow
with the corpus and not with blocks times parts. Up to about 2**FAN million tokens there is one level.

Of a word's hash at least 48 bits are carried beside those that name the part, of a pair's or triple's 40;
more text has more parts and so a longer hash. Two that collide share their counts: V words of T tokens hold
about V * V / (2**29 * T) such pairs, which is far below one for a corpus of any language.

The fit goes to the driver as a histogram over (bucket, triple, pair and word estimate) on a fixed
logarithmic grid, which is what bounds it.

Words are runs without the bytes 0x20 and 0x09-0x0D, with A-Z lower-cased; each text ends with one more
token, which is counted as a word. Nulls count as empty texts, which have the end alone. Repeated rows
count and are scored each; other columns play no part. Without training texts all counts are 0, and every
token is the unseen word with probability 1.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import kept, slices
from foldwise.llm.words import U, mix, text_bytes, word_hashes

END, BEGIN = U(0x1B873593CC9E2D51), U(0x85EBCA6BE6546B64)
BLOCK_BYTES, PART_TOKENS = 2 << 20, 1_000_000
KINDS, FAN = 3, 10  # words, pairs, triples; bits by which one cut splits a hash range
GRID, ROUNDS, PRIOR = 2.0, 60, 20.0
EXACT, SIDE = 8, 64  # counts with a bucket of their own; buckets of one kind of context
ORDERS = ("triple", "pair", "word")
FLOOR = 1e-6
SQUEEZE, EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
CELL = "kind int, owner long, part long, keys binary, n int, total binary, deleted binary"
ANSWER = "kind int, owner long, part long, n int, total binary, deleted binary, types long"


def packed(docs: DataFrame, train: Column, deleted: Column, id_col: str, text_col: str) -> DataFrame:
    """Blocks: their ids, flags, text ends and compressed texts; a block's name is drawn when it is written."""
    schema = "block long, ids array<long>, train binary, deleted binary, ends binary, texts binary, tokens long, trained long, n_train long, n_deleted long, t_deleted long"

    def run(batches):
        for batch in slices(batches, text_col, BLOCK_BYTES):
            buf, ends = text_bytes(batch.column(text_col))
            _, words = word_hashes(batch.column(text_col))
            n = np.diff(words) + 1
            t, d = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("train", "deleted"))
            name = int(np.random.default_rng().integers(1 << 62))
            row = [name, batch.column("id").to_pylist(), t.tobytes(), d.tobytes(), ends.tobytes(), zstandard.compress(buf.tobytes(), 3), n.sum(), n[t].sum(), t.sum(), d.sum(), n[d].sum()]
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([v if isinstance(v, (list, bytes)) else int(v)], k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    flags = [F.coalesce(c, F.lit(False)).alias(n) for c, n in ((train, "train"), (train & deleted, "deleted"))]
    return docs.select(F.col(id_col).cast("long").alias("id"), text_col, *flags).mapInArrow(run, schema)


def small(x: np.ndarray) -> bytes:
    """Counts as compressed bytes, each as wide as the largest needs: all low bytes, then all next ones, since
    the high bytes of counts are mostly 0."""
    x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    return SQUEEZE.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes())


def wide(raw: bytes, n: int) -> np.ndarray:
    cut = np.frombuffer(EXPAND.decompress(raw), np.uint8).reshape(-1, n).T
    return np.ascontiguousarray(cut).view(f"<u{cut.shape[1]}").reshape(-1).astype(np.uint64)


def width(kind: int, left: int) -> int:
    """Bytes of a key in a cell whose range will be cut by ``left`` more bits."""
    return min(8, (6 if kind == 0 else 5) + -(-left // 8))


def cut_keys(keys: np.ndarray, size: int) -> bytes:
    """The first ``size`` bytes of sorted keys, byte by byte: first bytes of neighbours are alike and compress."""
    return SQUEEZE.compress(keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes())


def whole_keys(raw: bytes, n: int) -> np.ndarray:
    cut = np.frombuffer(EXPAND.decompress(raw), np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(cut)] = cut.T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def split(kind: int, owner: int, part: int, keys: np.ndarray, counts: tuple, step: int, left: int) -> list[tuple]:
    """Cells of the non-empty ranges that the first ``step`` bits of sorted keys name. The bits go from
    the keys into the part; ``left`` more will follow."""
    names = keys >> U(64 - step)
    begins = np.flatnonzero(np.diff(names, prepend=names[:1] + U(1))) if len(keys) else np.zeros(0, int)
    rest, size = keys << U(step), width(kind, left)
    return [
        (kind, owner, (part << step) | int(names[a]), cut_keys(rest[a:b], size), int(b - a), *(small(c[a:b]) for c in counts))
        for a, b in zip(begins, [*begins[1:], len(keys)], strict=True)
    ]


class Block:
    """Tokens of a block's texts, and its distinct words, pairs and triples."""

    def __init__(self, row: dict, kinds: tuple = tuple(range(KINDS))):
        ends = np.frombuffer(row["ends"], dtype=np.int64)
        raw = zstandard.decompress(row["texts"], max_output_size=max(1, int(ends[-1])))
        texts = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(raw))
        words, offsets = word_hashes(texts)
        self.n = np.diff(offsets) + 1
        self.train, self.deleted = (np.frombuffer(row[c], dtype=bool) for c in ("train", "deleted"))
        stops = np.cumsum(self.n)
        tokens = np.empty(int(stops[-1]) if len(stops) else 0, dtype=np.uint64)
        at_end = np.zeros(len(tokens), bool)
        at_end[stops - 1] = True
        tokens[at_end], tokens[~at_end] = END, words
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        self.starts = stops - self.n
        before[self.starts] = BEGIN
        earlier = np.empty_like(tokens)
        earlier[1:] = before[:-1]
        earlier[self.starts] = BEGIN
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.keys, self.at = {}, {}
        for kind in kinds:
            grams = (tokens, before * U(3) + tokens, mix(earlier * U(3) + before) * U(5) + tokens)[kind]
            self.keys[kind], self.at[kind] = np.unique(mix(grams) if kind else grams, return_inverse=True)

    def counts(self, kind: int, which: np.ndarray) -> np.ndarray:
        return np.bincount(self.at[kind][which[self.doc]], minlength=len(self.keys[kind])).astype(np.uint32)


def cells(blocks: DataFrame, kind: int, step: int, left: int) -> DataFrame:
    """For each block and part (the first ``step`` bits of the hash): keys of a kind (0: words, 1: pairs,
    2: triples), and their counts in training and in the deleted part."""
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
    names = [x.split()[0] for x in CELL.split(", ")]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                own = Block(row, (kind,))
                counts = own.counts(kind, own.train), own.counts(kind, own.deleted)
                if out := split(kind, row["block"], 0, own.keys[kind], counts, step, left):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return blocks.select("block", "ends", "texts", "train", "deleted").mapInArrow(run, CELL)


def merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Cells of one range as one: distinct keys, where each cell's keys are among them, where cells end,
    and the summed counts."""
    keys, at = np.unique(np.concatenate([whole_keys(x, n) for x, n in zip(pdf["keys"], pdf["n"], strict=True)]), return_inverse=True)
    read = (np.concatenate([wide(x, n) for x, n in zip(pdf[c], pdf["n"], strict=True)]) for c in ("total", "deleted"))
    return keys, at, np.cumsum(pdf["n"].to_numpy())[:-1], [np.bincount(at, weights=x, minlength=len(keys)).astype(np.uint64) for x in read]


def handed(pdf: pd.DataFrame, at: np.ndarray, ends: np.ndarray, sums: list[np.ndarray], types: int) -> pd.DataFrame:
    """The answer to each cell: the sums in the order of its own keys."""
    out = pdf[["kind", "owner", "part", "n"]].copy()
    for c, x in zip(("total", "deleted"), sums, strict=True):
        out[c] = [small(one) for one in np.split(x[at], ends)]
    return out.assign(types=types)


def exchanged(asked: DataFrame, bits: int, used: int) -> tuple[DataFrame, int]:
    """Each cell with the counts of all blocks, and the number of distinct words seen in training.
    ``used``: how many of the ``bits`` that name a part the cells were cut by."""
    left = bits - used
    asked = asked.withColumn("part_of", F.pmod(F.xxhash64("owner"), F.lit(1 << left)))
    at_once = ("kind", "part", "part_of")
    if not left:
        def summed(pdf: pd.DataFrame) -> pd.DataFrame:
            _, at, ends, sums = merged(pdf)
            return handed(pdf, at, ends, sums, int((sums[0] > 0).sum()))

        found = kept(asked.groupBy(*at_once).applyInPandas(summed, ANSWER), "answers")
        by_part = found.filter("kind = 0").groupBy("part").agg(F.max("types").alias("types"))
        return found, by_part.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]

    asked, step = kept(asked, "cells"), min(FAN, left)

    def passed_on(key, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, _, _, sums = merged(pdf)
        kind, part, group = (int(k) for k in key)
        return pd.DataFrame(split(kind, group, part, keys, tuple(sums), step, left - step), columns=[x.split()[0] for x in CELL.split(", ")])

    def handed_back(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        _, at, ends, _ = merged(pdf)
        answers = answers.sort_values("inner")
        sums = [np.concatenate([wide(x, n) for x, n in zip(answers[c], answers["n"], strict=True)]) for c in ("total", "deleted")]
        return handed(pdf, at, ends, sums, 0)

    found, types = exchanged(asked.groupBy(*at_once).applyInPandas(passed_on, CELL), bits, used + step)
    back = found.select("kind", F.shiftright("part", step).alias("part"), F.col("owner").alias("part_of"), F.col("part").alias("inner"), "n", "total", "deleted")
    out = asked.groupBy(*at_once).cogroup(back.groupBy(*at_once)).applyInPandas(handed_back, ANSWER)
    return kept(out, "answers"), types


def bucket_of(count: np.ndarray) -> np.ndarray:
    tail = EXACT + 1 + np.floor(2 * np.log2(np.maximum(count, EXACT + 1) / (EXACT + 1)))
    return np.where(count <= EXACT, count, tail).astype(int).clip(0, SIDE - 1)


class Counted(Block):
    """A block with the counts of all texts for each of its tokens."""

    def __init__(self, row: dict, cells: pd.DataFrame):
        super().__init__(row)
        self.c = {}
        for name in ("total", "deleted"):
            for kind in range(KINDS):
                some = cells[cells["kind"] == kind].sort_values("part")
                counts = np.concatenate([np.zeros(0, np.uint64), *(wide(x, n) for x, n in zip(some[name], some["n"], strict=True))])
                self.c[name, kind] = counts[self.at[kind]].astype(np.float64)

    def estimates(self, facts: dict, kept_only: bool):
        """Of each token: bucket of its context, and the estimates by triple, pair, word and for the unseen."""
        counts = [self.c["total", kind] for kind in range(KINDS)]
        n, texts = facts["tokens"], facts["texts"]
        if kept_only:
            counts = [c - self.c["deleted", kind] for kind, c in enumerate(counts)]
            n, texts = n - facts["deleted_tokens"], texts - facts["deleted_texts"]
        found, before = [], []
        for lower, higher in zip(counts[:-1], counts[1:], strict=True):
            context = np.empty_like(lower)
            context[1:] = lower[:-1]
            context[self.starts] = texts
            before.append(context)
            found.append(np.divide(higher, context, out=np.zeros_like(higher), where=context > 0))
        bucket = np.where(before[1] > 0, SIDE + bucket_of(before[1]), bucket_of(before[0]))
        return bucket, found[1], found[0], counts[0] / max(n, 1), 1 / (facts["types"] + 1)


def events(left: DataFrame, right: DataFrame, facts: dict) -> DataFrame:
    """Histogram of the deleted tokens: bucket, triple, pair and word estimate on the grid (-1: none), tokens."""
    schema = "bucket long, triple long, pair long, word long, n long"

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros(0, np.int64)]
        for row in left.to_dict("records"):
            if not np.frombuffer(row["deleted"], dtype=bool).any():
                continue
            own = Counted(row, right)
            code, *ps, p0 = own.estimates(facts, kept_only=True)
            which = own.deleted[own.doc]
            code = code[which]
            for p in ps:
                level = np.where(p > 0, np.round(GRID * np.log(np.maximum(p, 1e-300) / p0)) + 501, 0).astype(np.int64)
                code = code * 1024 + level[which]
            out.append(code)
        code, n = np.unique(np.concatenate(out), return_counts=True)
        return pd.DataFrame({"bucket": code >> 30, **{c: ((code >> 10 * (2 - k)) & 1023) - 1 for k, c in enumerate(ORDERS)}, "n": n}, dtype="int64")

    found = left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(run, schema)
    return found.groupBy("bucket", *ORDERS).agg(F.sum("n").alias("n"))


def weights(histogram: pd.DataFrame) -> np.ndarray:
    """Mixture weights (triple, pair, word, unseen) of each bucket by expectation-maximisation."""
    def maximised(some: pd.DataFrame, start: np.ndarray, prior: float) -> np.ndarray:
        p = np.stack([np.where(some[c] < 0, 0.0, np.exp((some[c].to_numpy() - 500.0) / GRID)) for c in ORDERS] + [np.ones(len(some))], axis=1)
        n, w, allowed = some["n"].to_numpy(dtype=float), start, start > 0
        for _ in range(ROUNDS):
            share = p * w
            w = ((share / share.sum(1, keepdims=True) * n[:, None]).sum(0) + prior * start) / (n.sum() + prior)
        return (1 - allowed.sum() * FLOOR) * w + FLOOR * allowed

    out = np.zeros((2 * SIDE, 4))
    # what has a context: nothing but words after an unseen word, no triples after an unseen pair
    for first, last, unknown in ((0, 1, 2), (1, SIDE, 1), (SIDE, 2 * SIDE, 0)):
        even = np.where(np.arange(4) >= unknown, 1 / (4 - unknown), 0.0)
        own = histogram[(histogram["bucket"] >= first) & (histogram["bucket"] < last)]
        whole = maximised(own, even, 0.0) if len(own) else even
        for b in range(first, last):
            some = own[own["bucket"] == b]
            out[b] = maximised(some, whole, PRIOR) if len(some) else whole
    return out


def score(docs: DataFrame, train: Column, deleted: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10)."""
    blocks = kept(packed(docs, train, deleted, id_col, text_col), "blocks")
    sums = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "trained", "n_train", "n_deleted", "t_deleted")]).first()
    bits = max(4, int(np.ceil(np.log2(max(1, sums["tokens"] / PART_TOKENS)))))
    step = min(FAN, bits)
    # one kind after the other: the shuffle files of one are gone before the next writes its own
    (words, types), *longer = (exchanged(cells(blocks, kind, step, bits - step), bits, step) for kind in range(KINDS))
    answers = reduce(DataFrame.unionByName, [found for found, _ in longer], words)
    facts = {"tokens": sums["trained"], "texts": sums["n_train"], "deleted_tokens": sums["t_deleted"], "deleted_texts": sums["n_deleted"], "types": types}
    left = blocks.select("block", "ids", "train", "deleted", "ends", "texts")
    right = answers.select(F.col("owner").alias("block"), "kind", "part", "n", "total", "deleted")
    n, v = facts["tokens"], types
    mixture = weights(kept(events(left, right, facts), "events").toPandas())
    if not n:
        mixture[:] = (0, 0, 0, 1)

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in a.to_dict("records"):
            own = Counted(row, b)
            bucket, p3, p2, p1, p0 = own.estimates(facts, kept_only=False)
            w = mixture[bucket]
            c = own.c["total", 0]
            add = lambda x: np.add.reduceat(x, own.starts)
            out.append(pd.DataFrame({
                "id": pd.array(list(row["ids"]), dtype="Int64"), "train": own.train, "n_tokens": own.n, "n_known": add((c > 0).astype(np.int64)), "train_tokens": n,
                "base_score": add(np.log10((c + 1) / (n + v + 1))), "score": add(np.log10(w[:, 0] * p3 + w[:, 1] * p2 + w[:, 2] * p1 + w[:, 3] * p0)),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(run, schema)
