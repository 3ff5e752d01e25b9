"""Operator 10: language identification by word-first backoff.

A known word scores by its log frequency in each language. An unseen word falls back to its character
n-grams (the word between two marks), from the longest order down to single characters, and scores by the
mean log frequency of those known at the first order that knows any. A text's scores are added up over
its words and turned into probabilities; the score is that of the language predicted.

The model is fitted on a sample of labelled rows: about ``per_language`` texts of each language, those
with the smallest hash of their id. The ``words`` most frequent words and of each order the ``grams``
most frequent n-grams are kept, by the largest of their shares of one language's words or n-grams: languages
with few or short texts keep theirs beside the large ones. Words are runs of letters, lower-cased. Languages are few (tens): their list goes to the driver.

A text that is null or without letters has the prediction ``und`` and the score 0, as has every text if
nothing can be learned. Repeated rows are predicted each, and other columns pass through, but for
``lang_pred`` and ``score``, which are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import kept, slices, texts

WORD = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
ALPHA = 0.1


def ngrams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def counted(train: DataFrame) -> DataFrame:
    """``lang``, ``kind`` (0: word, else the order), ``gram``, ``n``, added up within Arrow slices first."""
    schema = "lang string, kind int, gram string, n long"

    def run(batches):
        for batch in slices(batches, "text"):
            by: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                by.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            rows = []
            for lang, words in by.items():
                rows += [(lang, 0, w, c) for w, c in words.items()]
                for n in ORDERS:
                    grams: Counter = Counter()
                    for w, c in words.items():
                        for g in ngrams(w, n):
                            grams[g] += c
                    rows += [(lang, n, g, c) for g, c in grams.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], names=["lang", "kind", "gram", "n"])

    return train.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, per_language: int = 1500, words: int = 60_000, grams: int = 60_000) -> dict:
    """``labelled``: ``doc_id``, ``lang``, ``text``. The model is bounded by its parameters."""
    there = labelled.filter("lang is not null and text is not null")
    sizes = there.groupBy("lang").count().orderBy("lang").collect()
    if not sizes:
        return {"langs": [], "grams": [(pa.array([], pa.string()), np.zeros(0, int))] * (max(ORDERS) + 1), "table": np.zeros((0, 0), np.float32)}
    share = F.create_map(*chain.from_iterable((F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"]))) for r in sizes))
    part = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    counts = kept(counted(there.filter(part)), "grams")  # of the sample, so bounded
    langs = [r["lang"] for r in sizes]
    per = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"l{i}") for i, lang in enumerate(langs)]
    wide = kept(counts.groupBy("kind", "gram").agg(*per), "wide")  # read for each order
    totals = {r["kind"]: r for r in wide.groupBy("kind").agg(F.count("*").alias("size"), *[F.sum(f"l{i}").alias(f"l{i}") for i in range(len(langs))]).collect()}
    best = []
    for kind, total in sorted(totals.items()):
        shares = [F.col(f"l{i}") / F.lit(float(max(total[f"l{i}"], 1))) for i in range(len(langs))]
        top = F.array_max(F.array(*shares)).desc()
        best.append(wide.filter(F.col("kind") == kind).orderBy(top, "gram").limit(words if kind == 0 else grams))
    # picked on the executors; the driver gets the kept rows only, as Arrow columns, and makes no object of a row
    found = (kept(reduce(DataFrame.unionByName, best), "best") if best else wide).toArrow()
    kinds = found["kind"].to_numpy()
    table = np.zeros((len(found), len(langs)), np.float32)
    for i in range(len(langs)):
        top = np.array([float(totals[k][f"l{i}"] + ALPHA * totals[k]["size"]) if k in totals else 1.0 for k in range(max(ORDERS) + 1)])
        table[:, i] = np.log((found[f"l{i}"].to_numpy() + ALPHA) / top[kinds])
    rows = [np.flatnonzero(kinds == k) for k in range(max(ORDERS) + 1)]
    return {"langs": langs, "grams": [(found["gram"].take(pa.array(r)).combine_chunks(), r) for r in rows], "table": table}


class Scorer:
    """Scores of words by language, kept for up to ``limit`` words at a time."""

    def __init__(self, model: dict, limit: int = 100_000):
        self.langs, self.base, self.limit = model["langs"], model["table"], limit
        self.by_kind = [dict(zip(grams.to_pylist(), rows.tolist(), strict=True)) for grams, rows in model["grams"]]
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((0, len(self.langs)), np.float32)

    def learn(self, asked: set[str]) -> None:
        if len(self.at) + len(asked) > self.limit:
            self.clear()
        new = list(asked.difference(self.at))
        rows, ends = [], []
        for word in new:
            known = self.by_kind[0].get(word)
            if known is not None:
                rows.append(known)
            else:
                for n in ORDERS:
                    own = self.by_kind[n]
                    some = [own[g] for g in ngrams(word, n) if g in own]
                    if some:
                        rows += some
                        break
            ends.append(len(rows))
        if new:
            sums = np.vstack([np.zeros((1, len(self.langs))), np.cumsum(self.base[np.array(rows, int)], axis=0, dtype=np.float64)])
            counts = np.diff([0, *ends])
            means = np.diff(sums[[0, *ends]], axis=0) / np.maximum(counts, 1)[:, None]
            self.at.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table = np.vstack([self.table, means.astype(np.float32)])

    def score(self, some: list[str]) -> tuple[list[str], list[float]]:
        cut = [WORD.findall(t.lower()) for t in some]
        self.learn(set(chain.from_iterable(cut)))
        names, scores = [], []
        for words in cut:
            if not words or not self.langs:
                names.append("und")
                scores.append(0.0)
                continue
            total = self.table[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(0, dtype=np.float64)
            best = int(np.argmax(total))
            names.append(self.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        own = Scorer(shared.value)
        for batch in slices(batches, text_col):
            names, scores = own.score(texts(batch, text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, "lang_pred", "score"])

    return docs.select(*rest).mapInArrow(run, schema)


def identify(docs: DataFrame, learn: Column, **bounds) -> DataFrame:
    """Fit on the rows that ``learn`` names and predict all."""
    return predict(docs, fit(docs.filter(learn).select("doc_id", "lang", "text"), **bounds))
