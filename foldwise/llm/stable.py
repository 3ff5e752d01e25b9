"""Operator 13: near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Vectors are compared only inside their label. On the unit sphere a cosine of c is a distance of
sqrt(2 - 2c), and a Gaussian projection of two vectors at distance r differs by r times a normal number. A
hash is floor((projection + offset) / width); a table's bucket joins ``hashes`` of them, and a pair meets if
it shares a bucket of any table. The width is ten times the distance at the threshold. ``hashes`` grows with
the logarithm of the largest label, so that strangers fill a bucket with about ``FILL`` vectors at any size, and
``tables`` is then the number that a pair exactly at the threshold misses with a chance of ``miss`` at most;
closer pairs miss less. Whatever meets is checked by its cosine in double precision, so no link is wrong.

Equal vectors of a label are hashed once, with their number. Buckets are dealt in shards of some thousand rows;
a bucket of over ``BLOCK`` vectors is cut into blocks by a hash of the id, and every two of its blocks meet
as one matrix product in a task of their own. A pair counts in the first table that joins it; tasks return a
number of links and one neighbour for each vector, never pairs.

Null labels, and vectors that are null, empty, zero or hold null or non-finite components, link with nothing;
neither do vectors of different lengths. An id names one vector: of repeated ids the smallest label and
vector stand. Rows without an id are returned with no links, no component, and as kept. Other columns play
no part. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import kept
from foldwise.llm.components import contract

BLOCK, SHARD_ROWS, FILL, WIDTHS = 1024, 16384, 64, 10.0


def meeting(ratio: float) -> float:
    """Chance that one hash joins two vectors, by the width over the spread of their projections."""
    tail = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def plan(cosine: float, rows: int, miss: float) -> tuple[float, int, int]:
    """Width, hashes of a table and number of tables for labels of up to ``rows`` distinct vectors."""
    near = math.sqrt(max(2 - 2 * cosine, 1e-12))
    width = WIDTHS * near
    close, far = meeting(WIDTHS), min(meeting(width / math.sqrt(2)), 0.999)
    hashes = max(1, math.ceil(math.log(max(rows / FILL, 1.0)) / -math.log(far)))
    return width, hashes, max(1, math.ceil(math.log(miss) / math.log1p(-(close**hashes))))


def units(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucketed(distinct: DataFrame, width: float, hashes: int, tables: int, seed: int) -> DataFrame:
    """Adds ``keys``: the vector's bucket in each table, as 64-bit hashes."""

    def run(batches):
        for rows in batches:
            keys = np.zeros((len(rows), tables), dtype=np.uint64)
            for dim, at in rows.groupby(rows["v"].map(len)).indices.items():
                rng = np.random.default_rng((seed, int(dim)))
                directions, offsets = rng.standard_normal((dim, tables * hashes)), rng.uniform(0, width, tables * hashes)
                cells = np.floor((units(rows["v"].iloc[at]) @ directions + offsets) / width).astype(np.int64).view(np.uint64)
                out = np.arange(tables, dtype=np.uint64)[None, :] + (rows["label_key"].to_numpy().view(np.uint64)[at, None] ^ np.uint64(dim))
                for i in range(hashes):
                    out = (out ^ cells[:, i::hashes]) * np.uint64(0x9E3779B97F4A7C15)
                    out ^= out >> np.uint64(29)
                keys[at] = out
            yield rows[["id", "copies", "v"]].assign(keys=list(keys.view(np.int64)))

    vector = distinct.schema["v"].dataType.simpleString()
    return distinct.mapInPandas(run, f"id long, copies long, v {vector}, keys array<long>")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` reaches over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, before[a], least)
        np.minimum.at(root, before[b], least)
        while (deeper := root[root]).tolist() != root.tolist():
            root = deeper
        if (root[a] == root[b]).all():
            return root


def compared(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """All buckets of a shard: links of each vector in them, and one vector it is joined with."""
    rows = rows.sort_values(["table", "bucket", "id"], kind="stable")
    ids, place = np.unique(rows["id"].to_numpy(), return_inverse=True)
    first = np.zeros(len(ids), dtype=np.int64)
    first[place] = np.arange(len(rows))
    copies = rows["copies"].to_numpy()[first]
    keys = np.stack(rows["keys"].to_numpy()[first])
    table, bucket, side = (rows[c].to_numpy() for c in ("table", "bucket", "side"))
    cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (table[1:] != table[:-1])) + 1
    lengths = rows["v"].map(len).to_numpy()[first]
    unit = {}
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        unit[dim] = (units(rows["v"].iloc[first[at]]), np.cumsum(lengths == dim) - 1)
    links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    for part in np.split(np.arange(len(rows)), cuts):
        who = place[part]
        base, index = unit[lengths[who[0]]]
        left, right = (who[side[part] != 2], who[side[part] != 1])  # side 0: within; 1 and 2: two blocks
        same = (left[:, None] < right[None, :]) if side[part[0]] == 0 else np.ones((len(left), len(right)), bool)
        i, j = np.nonzero((base[index[left]] @ base[index[right]].T >= cosine) & same)
        a, b = left[i], right[j]
        met = np.ones(len(a), bool)  # not joined by an earlier table
        for earlier in range(table[part[0]]):
            met &= keys[a, earlier] != keys[b, earlier]
        a, b = a[met], b[met]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        if len(a):
            root = forest(len(ids), np.concatenate([a, np.arange(len(ids))]), np.concatenate([b, root]))
    found = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
    return pd.DataFrame({"id": ids[found], "links": links[found], "near": ids[root[found]]})


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, miss: float = 1e-4, seed: int = 13, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id``, ``n_links``, ``root``, ``kept`` for each vector."""
    floats = vectors.schema[vector_col].dataType.simpleString() == "array<float>"  # half the bytes to move
    v = F.col(vector_col) if floats else F.col(vector_col).cast("array<double>")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    one = vectors.select(F.col(id_col).alias("id"), F.struct(F.col(label_col).alias("label"), F.when(sound, v).alias("v")).alias("x"))
    whole = kept(one.filter("id is not null").groupBy("id").agg(F.min("x").alias("x")).select("id", "x.label", "x.v"), "vectors")
    usable = whole.filter("label is not null and v is not null")
    distinct = kept(usable.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "distinct")
    most = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width, hashes, tables = plan(cosine, most, miss)
    keyed = kept(bucketed(distinct.withColumn("label_key", F.xxhash64("label")), width, hashes, tables, seed), "keyed")
    slim = keyed.select("id", F.posexplode("keys").alias("table", "bucket"))
    sizes = kept(slim.groupBy("table", "bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    shards = max(1, math.ceil((sizes.agg(F.sum("n")).first()[0] or 0) / SHARD_ROWS))
    met = slim.join(sizes, ["table", "bucket"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    met = kept(met.withColumn("own", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")).cast("int")), "met").join(keyed, "id")
    small = met.filter("blocks = 1").select("*", F.pmod(F.xxhash64("table", "bucket"), F.lit(shards)).alias("shard"), F.lit(0).alias("side"))
    tiles = met.filter("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.xxhash64("table", "bucket", F.least("own", "other"), F.greatest("own", "other"))
    large = tiles.select("*", tile.alias("shard"), F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
    wanted = ["id", "copies", "v", "keys", "table", "bucket", "side", "shard"]
    shape = "id long, links long, near long"
    found = small.select(*wanted).groupBy("shard").applyInPandas(lambda rows: compared(rows, cosine), shape)
    found = kept(found.unionByName(large.select(*wanted).groupBy("shard").applyInPandas(lambda rows: compared(rows, cosine), shape)), "found")
    roots = contract(found.select(F.col("id").alias("a"), F.col("near").alias("b")))
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    if roots is not None:
        linked = linked.join(roots, "id", "full")
    else:
        linked = linked.withColumn("root", F.col("id"))
    groups = distinct.join(linked, "id", "left").select(
        "label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "id").alias("root")
    )
    out = whole.join(groups, ["label", "v"], "left")
    rows = out.select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("root"))
    nameless = one.filter("id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("root"))
    return rows.unionByName(nameless).withColumn("kept", F.coalesce(F.col("id") == F.col("root"), F.lit(True)))
