"""Operator 5: quality scores by Bradley-Terry pairwise ranking.

A document is described by shares of its bytes, words and lines. Pairs of one labelled 1 and one labelled
0 say which is preferred; logistic loss on the feature differences, without intercept, gives the weights,
and w.x is a document's strength. The threshold is the quantile of the strengths of the labelled rows at
the share of the label 0; strengths are moved so that it lies at a score of 0.7.

The weights are learned from a sample of at most about ``bound`` labelled rows (those with the smallest hash
of the id) and about ``per_document`` pairs for each preferred one. Threshold, spread and the share of the
label 0 are those of all labelled rows, by exact quantiles of a range sort. Null and empty texts have the features of an empty text and a
score like all others. Labels other than 0 and 1 are ignored; if one of the two is missing every score is
0.7. Repeated rows are scored each; other columns pass through, but for ``score`` and ``predicted``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import kept, slices
from foldwise.llm.words import BYTES, text_bytes, word_hashes
from foldwise.operators.stats import column_quantiles

CUT = 0.7
KINDS = {
    "upper": (BYTES >= 65) & (BYTES <= 90),
    "letter": ((BYTES | 32) >= 97) & ((BYTES | 32) <= 122) | (BYTES >= 128),
    "digit": (BYTES >= 48) & (BYTES <= 57),
    "stop": np.isin(BYTES, list(b".,;:?")),
    "shout": BYTES == ord("!"),
    "bar": BYTES == ord("|"),
    "mark": np.isin(BYTES, list(b"#$%&*+/<=>@\\^_`{}~")),
    "line": BYTES == 10,
}
N_FEATURES = 16


def features(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text, from its whole bytes."""
    buf, offsets = text_bytes(column)
    words, ends = word_hashes(column)
    size = np.diff(offsets).astype(float)
    sums = {}
    for name, kind in KINDS.items():
        total = np.concatenate([[0], np.cumsum(kind[buf], dtype=np.int64)])
        sums[name] = np.diff(total[offsets]).astype(float)
    n = np.diff(ends).astype(float)
    distinct, again, top, trigrams = (np.zeros(len(n)) for _ in range(4))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        own = words[a:b]
        if len(own):
            _, counts = np.unique(own, return_counts=True)
            distinct[i], top[i] = len(counts), counts.max()
            again[i] = (own[1:] == own[:-1]).sum()
            if len(own) > 3:
                three = own[:-2] * np.uint64(3) + own[1:-1] * np.uint64(5) + own[2:] * np.uint64(7)
                trigrams[i] = 1 - len(np.unique(three)) / len(three)
    some, w = np.maximum(size, 1), np.maximum(n, 1)
    return np.column_stack([
        np.log1p(n), size / w / 10, sums["upper"] / np.maximum(sums["letter"], 1), np.sqrt(sums["upper"] / np.maximum(sums["letter"], 1)),
        sums["digit"] / some, sums["stop"] / w, np.minimum(sums["shout"] / w, 1), np.minimum(sums["bar"] / w, 1), np.minimum(sums["mark"] / w, 3),
        np.sqrt(sums["mark"] / some), np.sqrt(sums["bar"] / w), np.sqrt(sums["shout"] / w),
        again / w, distinct / w, trigrams, np.minimum(sums["line"] / w, 1),
    ])


def described(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replaces the text by ``x``, its features."""
    rest = [c for c in docs.columns if c not in (text_col, "x")]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in slices(batches, text_col):
            x = features(batch.column(text_col))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * N_FEATURES, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), lists], names=schema.names)

    return docs.select(*rest, text_col).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, bound: int = 20_000, per_document: int = 4) -> dict:
    """``docs``: ``doc_id``, ``text``; ``labels``: ``doc_id``, ``quality``. Weights, threshold and spread."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    share = min(1.0, bound / max(1, n))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < share * (1 << 20))  # bounded, so broadcast
    rows = kept(described(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).dropDuplicates(["doc_id"]), "labelled")
    sizes = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return {"w": [0.0] * N_FEATURES, "threshold": 0.0, "spread": 1.0}
    buckets = max(1, sizes[0] // per_document)
    better, worse = (rows.filter(F.col("quality") == q).select(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(buckets)).alias("bucket"), F.col("x").alias(x), F.col("doc_id").alias(f"{x}_id")) for q, x in ((1, "x"), (0, "y")))
    # the preferred one first or last, by a hash of the two: both labels occur, however rows are partitioned
    sign = F.when(F.pmod(F.xxhash64("x_id", "y_id"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    pairs = better.join(worse, "bucket").withColumn("sign", sign)
    pairs = kept(pairs.select(F.transform(F.arrays_zip("x", "y"), lambda p: (p["x"] - p["y"]) * F.col("sign")).alias("d"), F.when(F.col("sign") > 0, 1.0).otherwise(0.0).alias("label")), "preferences")
    if pairs.select("label").distinct().count() < 2:
        return {"w": [0.0] * N_FEATURES, "threshold": 0.0, "spread": 1.0}
    ready = pairs.select(array_to_vector("d").alias("features"), "label")
    w = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=60).fit(ready).coefficients.toArray().tolist()
    strengths = rows.select("quality", strength_of(w).alias("s")) if share == 1 else kept(all_strengths(docs, known, n, w), "strengths")
    sizes = {r["quality"]: r["count"] for r in strengths.groupBy("quality").count().collect()}
    q = sizes[0] / (sizes[0] + sizes[1])
    probs = [q / 2, q, (1 + q) / 2]
    found = {r["prob"]: r["quantile"] for r in column_quantiles(strengths, ["s"], probs).collect()}
    low, threshold, high = (found[p] for p in probs)
    return {"w": w, "threshold": threshold, "spread": max((high - low) / 6, 1e-6)}


def all_strengths(docs: DataFrame, known: DataFrame, n: int, w: list[float], broadcast_rows: int = 1_000_000) -> DataFrame:
    """``doc_id``, ``quality``, ``s`` of every labelled row; texts are not shuffled."""
    some = docs.select("doc_id", "text")
    if n <= broadcast_rows:
        some = some.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    own = described(some).groupBy("doc_id").agg(F.min(strength_of(w)).alias("s"))
    return own.join(known, "doc_id")


def strength_of(w: list[float]):
    return F.aggregate(F.zip_with("x", F.array(*map(F.lit, w)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def scored(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Adds ``score`` and ``predicted``; the text is kept."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    w, shift = np.array(model["w"]), math.log(CUT / (1 - CUT))
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in slices(batches, text_col):
            strength = (features(batch.column(text_col)) * w).sum(1)
            score = 1 / (1 + np.exp(-np.clip((strength - model["threshold"]) / model["spread"] + shift, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=schema.names)

    return docs.select(*rest).mapInArrow(run, schema)
