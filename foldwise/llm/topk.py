"""Operator 3: exact top-k search by tiled matrix products.

Vectors become integers floor(scale * x). Candidates are dealt to shards and queries to blocks by id; a
tile is one block against one shard: a matrix product in double precision (exact below 2**53), of which
each query keeps its best k. The lists of a query meet in a tree of levels of at most ``fan`` lists.

Vectors that are null, or hold null or non-finite components, take no part. An id names one vector: of
repeated ids the smallest vector stands. No query finds itself. Equal scores go to the smaller id. With
fewer than k candidates all are returned; an empty table gives no rows. Vectors of unequal lengths have no inner
product and raise an error that names the lengths. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD_ROWS, BLOCK_ROWS, PRODUCT_CELLS = 8192, 4096, 4_000_000


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v`` (doubles): one row for each id with a vector of finite components."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.col(vector_col).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(whole & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def of_one_length(facts=None) -> list[Column]:
    """The aggregates that tell whether all ``v`` have one length; with their row, an error if not."""
    if facts is not None and facts["shortest"] != facts["longest"]:
        raise ValueError(f"vectors of {facts['shortest']} and of {facts['longest']} components have no inner product")
    return [F.min(F.size("v")).alias("shortest"), F.max(F.size("v")).alias("longest")]


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new references: both sides of a cogroup come from one table here."""
    return df.select(*[F.col(c).alias(c) for c in ("id", "v", "block", "shard")])


def matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.float64)


def best(scores: np.ndarray, k: int, slack: float = 0.0) -> list[np.ndarray]:
    """For each row of scores the places of at least its k highest: all within ``slack`` of the k-th."""
    if scores.shape[1] <= k:
        return [np.arange(scores.shape[1])] * len(scores)
    least = np.partition(scores, -k, axis=1)[:, -k] - slack
    rows, places = np.nonzero(scores >= least[:, None])
    return np.split(places, np.searchsorted(rows, np.arange(1, len(scores))))


def tile(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    queries, shard = queries.sort_values("id"), shard.sort_values("id")
    ids, base = shard["id"].to_numpy(), matrix(shard["v"])
    out = []
    step = max(1, PRODUCT_CELLS // len(ids))
    for at in range(0, len(queries), step):
        own = queries.iloc[at : at + step]
        scores = matrix(own["v"]) @ base.T
        asked = own["id"].to_numpy()
        place = np.searchsorted(ids, asked)
        here = (place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == asked)
        scores[np.flatnonzero(here), place[here]] = -np.inf
        for q, row, some in zip(asked, scores, best(scores, k), strict=True):
            some = some[np.isfinite(row[some])]
            some = some[np.argsort(-row[some], kind="stable")[:k]]
            out.append((np.full(len(some), q), ids[some], row[some]))
    ids, found, scores = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"query_id": ids, "vec_id": found, "score": scores.astype(np.int64)})


def merged(lists: DataFrame, k: int, shards: int, fan: int = 64) -> DataFrame:
    """Tree merge of per-query lists that carry the ``shard`` they come from; adds ``rank``."""
    order = [F.col("score").desc(), F.col("vec_id")]
    while shards > fan:
        shards = -(-shards // fan)
        lists = lists.withColumn("shard", F.expr(f"shard div {fan}"))
        lists = lists.withColumn("rank", F.row_number().over(W.partitionBy("query_id", "shard").orderBy(*order))).filter(F.col("rank") <= k).drop("rank")
    return lists.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k).drop("shard")


def search(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (long); ``is_query`` speaks of the column ``id``."""
    whole = usable(vectors, id_col, vector_col).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    of_one_length(whole.agg(*of_one_length()).first())
    rows = max(1, vectors.count())
    shards = -(-rows // SHARD_ROWS)
    queries = whole.filter(is_query)
    blocks = max(1, -(-queries.select("id").count() // BLOCK_ROWS))
    spread = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("block", spread(blocks, 1)).withColumn("shard", each(shards))
    right = whole.withColumn("shard", spread(shards, 2)).withColumn("block", each(blocks))

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "shard": []}).astype("int64")
        return tile(a, b, k).assign(shard=key[1])

    tiles = fresh(left).groupBy("block", "shard").cogroup(fresh(right).groupBy("block", "shard")).applyInPandas(run, "query_id long, vec_id long, score long, shard long")
    return merged(tiles, k, shards).select("query_id", "rank", "vec_id", "score")
