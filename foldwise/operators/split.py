"""Fold assignment, splits and bootstrap draws (D1-D7), all deterministic and distributed.

Rows are "shuffled" by a hash uniform u = uniform(id, seed) and numbered in (stratum, u, id) order, so each
class is spread evenly over the folds (class counts per fold differ by at most one). The numbering uses fixed
buckets of u (``ranked``): rows per (stratum, bucket) are counted, a prefix sum of those counts says where each
bucket starts, and a window numbers the rows inside it. u is uniform, so a class that holds most rows is still
dealt evenly over its buckets. That is one hash shuffle of the rows: nothing is written, and no row is joined
back by its id, so repeated and NULL ids keep their rows (full copies may swap places, which changes nothing).
The numbers do not depend on how many buckets there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.hashing import poisson_weight, uniform
from foldwise.operators.lookup import Lookup

BUCKETS_PER_PARTITION = 16


def ranked(df: DataFrame, strata: list[str], id_col: str, *extra_key, seed: int, buckets: int | None = None) -> DataFrame:
    """Adds ``_r`` (1-based place in (strata, u, id) order), ``_in`` (place inside the stratum) and ``_n``
    (rows of the stratum). The driver gets nothing but a size-checked lookup of strata x buckets rows."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or BUCKETS_PER_PARTITION * parts
    u = uniform(F.col(id_col), *extra_key, seed=seed)
    bucket = F.floor(u * buckets).cast("int")

    counts = df.select(*strata, bucket.alias("_b")).groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    stratum = Window.partitionBy(*strata)
    earlier = stratum.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumns({"_before": F.coalesce(F.sum("_c").over(earlier), F.lit(0)), "_n": F.sum("_c").over(stratum)}).drop("_c")
    if strata:  # one row per stratum: the rows of the strata before it
        before = Window.orderBy(*strata).rowsBetween(Window.unboundedPreceding, -1)
        sizes = counts.groupBy(*strata).agg(F.sum("_c").alias("_m"))
        sizes = sizes.withColumn("_start", F.coalesce(F.sum("_m").over(before), F.lit(0))).drop("_m")
        starts = Lookup.fit(sizes).join_null_safe(starts, strata)
    else:
        starts = starts.withColumn("_start", F.lit(0))

    hashable = [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    inside = Window.partitionBy(*strata, "_b").orderBy("_u", id_col, "_h")
    rows = df.withColumns({"_u": u, "_b": bucket, "_h": F.xxhash64(*[F.col(f"`{c}`") for c in hashable])})
    rows = rows.withColumn("_i", F.row_number().over(inside)).drop("_u", "_h")
    rows = Lookup.fit(starts).join_null_safe(rows, [*strata, "_b"])
    place = F.col("_before") + F.col("_i")
    return rows.withColumns({"_r": F.col("_start") + place, "_in": place}).drop("_b", "_i", "_before", "_start")


def _with_fold(df: DataFrame, strata: list[str], id_col: str, k: int, seed: int, fold_col: str) -> DataFrame:
    out = ranked(df.drop(fold_col), strata, id_col, seed=seed)
    return out.withColumn(fold_col, ((F.col("_r") - 1) % k).cast("int")).drop("_r", "_in", "_n")


def stratified_kfold(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42, fold_col: str = "kfold") -> DataFrame:
    """Rows with a NULL label are a class of their own."""
    return _with_fold(df, [label], id_col, k, seed, fold_col)


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, fold_col: str = "kfold", exact: bool = True) -> DataFrame:
    """Plain k-fold. exact: equal parts (rank in hash order mod k); else pmod(xxhash64) with no shuffle."""
    if not exact:
        return df.withColumn(fold_col, F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(k)).cast("int"))
    return _with_fold(df, [], id_col, k, seed, fold_col)


def equal_width_bins(df: DataFrame, col: str, k: int) -> tuple[list[float], object]:
    """pandas ``cut(y, k)``: k equal-width right-closed bins, left edge extended by 0.1 % of the range."""
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = float(mm["lo"]), float(mm["hi"])
    if hi == lo:
        edges = [lo - 0.001 * abs(lo) if lo else -0.001] + [lo + 0.001 * abs(lo) if lo else 0.001] * k
    else:
        step = (hi - lo) / k
        edges = [lo + i * step for i in range(k + 1)]
        edges[0] = lo - (hi - lo) * 0.001
        edges[-1] = hi
    x = F.col(col)
    expr = None
    for i in range(k):
        cond = (x > F.lit(edges[i])) & (x <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return edges, expr


def stratified_kfold_regression(df: DataFrame, target: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    _, code = equal_width_bins(df, target, k)
    out = stratified_kfold(df.withColumn("_ybin", code), "_ybin", id_col, k, seed)
    return out.drop("_ybin")


def fold_split(df: DataFrame, fold: int, fold_col: str = "kfold") -> tuple[DataFrame, DataFrame]:
    """(train, valid) = (kfold != f, kfold == f); on a table written partitioned by kfold both are pruned scans."""
    return df.where(F.col(fold_col) != fold), df.where(F.col(fold_col) == fold)


def train_test_split(df: DataFrame, id_col: str, test_size: float = 0.25, seed: int = 42,
                     stratify: str | None = None, flag_col: str = "is_test") -> DataFrame:
    """Hash-ordered hold-out. Stratified: per class (NULL is one), the first ceil(test_size * n_class) rows in hash order."""
    out = ranked(df.drop(flag_col), [stratify] if stratify else [], id_col, seed=seed)
    is_test = F.col("_in") <= F.ceil(F.col("_n") * F.lit(test_size))
    return out.withColumn(flag_col, is_test.cast("int")).drop("_r", "_in", "_n")


def bootstrap_weights(df: DataFrame, id_col: str, n_samples: int, frac: float, seed: int = 42) -> DataFrame:
    """(row, replicate, weight): Poisson(frac) draw per row and replicate from uniform(id | r | seed)."""
    r = F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("replicate")
    ex = df.select(F.col(id_col), r)
    return ex.withColumn("weight", poisson_weight(uniform(F.col(id_col), F.col("replicate"), seed=seed), frac))


def union_split(train: DataFrame, test: DataFrame, target: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train UNION test by name (test lacks the target -> NULL); split back by NULL target."""
    both = train.unionByName(test, allowMissingColumns=True)
    return both, both.where(F.col(target).isNotNull()), both.where(F.col(target).isNull())
