"""One-hot rows and per-entity level counts of any width.

The dense forms (``encode.one_hot``, ``child.child_summary``) make a column for each level and refuse more than
``lookup.MAX_LEVELS``. Here a row holds the places of its levels only, as a struct of ``size`` (places in all),
``indices`` (ascending) and, for counts, ``values``. Places are fixed at fit: columns in the order given, the
levels of a column sorted. Level tables are lookups: broadcast within their bounds, joined with a shuffle beyond.
NULL and levels unseen at fit have no place; a row or entity without any keeps an empty list.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.text import clean_category
from foldwise.operators.encode import fit_label_encoder, label_encode
from foldwise.operators.lookup import Lookup


@dataclass
class SparseLevels:
    encoders: dict[str, Lookup]  # column -> (level, code from 0)
    begins: dict[str, int]  # column -> place of its first level that has one
    size: int
    first: int  # codes below it have no place


def fit_sparse_levels(df: DataFrame, cols: list[str], drop_first: bool = False, clean: bool = False) -> SparseLevels:
    """``clean``: levels as the child summary writes them; cleaned levels that collide are one."""
    if clean:
        df = df.select(*[clean_category(F.col(c).cast("string")).alias(c) for c in cols])
    first, size = int(drop_first), 0
    encoders = {c: fit_label_encoder(df, c) for c in cols}
    begins = {}
    for c, enc in encoders.items():
        begins[c] = size
        size += max(enc.df.count() - first, 0)
    return SparseLevels(encoders, begins, size, first)


def one_hot_sparse(df: DataFrame, st: SparseLevels, out: str = "one_hot") -> DataFrame:
    """Adds ``out``: struct of ``size`` and the ``indices`` that are 1."""
    places = []
    for c, enc in st.encoders.items():
        df = label_encode(df, c, enc, out=f"_place_{c}")
        code = F.col(f"_place_{c}")
        places.append(F.when(code >= st.first, code - st.first + st.begins[c]))
    found = F.struct(F.lit(st.size).alias("size"), F.array_compact(F.array(*places)).alias("indices"))
    return df.withColumn(out, found).drop(*[f"_place_{c}" for c in st.encoders])


def sparse_counts(child: DataFrame, key: str, st: SparseLevels, out: str = "counts") -> DataFrame:
    """One row per ``key``: how many of its rows have each level (``st`` fitted with ``clean=True``). Rows are
    counted by (key, column, level) before the shuffle, so a key of many rows sends each of its levels once."""
    pairs = [F.struct(F.lit(c).alias("c"), clean_category(F.col(c).cast("string")).alias("l")) for c in st.encoders]
    counted = child.select(F.col(key), F.explode(F.array(*pairs)).alias("_s")).groupBy(key, "_s.c", "_s.l").agg(F.count(F.lit(1)).alias("_n"))
    tables = [
        enc.df.where(F.col("code") >= st.first).select(F.lit(c).alias("c"), F.col(c).alias("l"), (F.col("code") - st.first + st.begins[c]).alias("_place"))
        for c, enc in st.encoders.items()
    ]
    places = Lookup(reduce(DataFrame.unionByName, tables), all(e.broadcastable for e in st.encoders.values()))
    known = F.when(F.col("_place").isNotNull(), F.struct("_place", "_n"))
    listed = places.join(counted, ["c", "l"]).groupBy(key).agg(F.array_sort(F.collect_list(known)).alias("_all"))
    parts = F.lit(st.size).alias("size"), F.col("_all._place").alias("indices"), F.col("_all._n").alias("values")
    return listed.select(key, F.struct(*parts).alias(out))
