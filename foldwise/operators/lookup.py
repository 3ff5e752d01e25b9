"""Fitted lookup tables and size-checked broadcast joins.

A fit produces a small table keyed by category level(s). ``Lookup.fit`` counts its rows and bytes where they
are; if both are within their bounds the table is pulled as an Arrow table and becomes a local relation, which
is broadcast (its size is proven); if not, it is checkpointed to the shared checkpoint folder and joined
with a shuffle instead. Arrow keeps NULL, NaN and large integers apart on either way. Nothing of data size ever
reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foldwise.session import cut_lineage

DEFAULT_MAX_LOCAL_ROWS = 200_000
DEFAULT_MAX_LOCAL_BYTES = 64 << 20
MAX_LEVELS = 5_000
BOUND_CONF = "foldwise.lookup.maxLocalRows"  # optional session settings overriding the bounds
BYTES_CONF = "foldwise.lookup.maxLocalBytes"


def _bound(spark, given: int | None, conf: str = BOUND_CONF, default: int = DEFAULT_MAX_LOCAL_ROWS) -> int:
    if given:
        return given
    found = spark.conf.get(conf, None)
    return int(found) if found else default


def _cell_bytes(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        inside = F.aggregate(c, F.lit(8).cast("long"), lambda total, x: total + _cell_bytes(x, kind.elementType))
        return F.coalesce(inside, F.lit(8))
    if isinstance(kind, T.StructType):
        return sum((_cell_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row as Arrow keeps it."""
    return sum((_cell_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0)).cast("long")


def local_table(spark, rows, schema: T.StructType | str) -> DataFrame:
    """Driver-side rows (a list of tuples or an Arrow table) as a local relation, whose size the planner knows."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not isinstance(rows, pa.Table):
        columns = zip(*rows, strict=True) if rows else [()] * len(schema)
        rows = pa.table([pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(schema), strict=True)], names=schema.names)
    return spark.createDataFrame(rows, schema=schema)


@dataclass
class Lookup:
    df: DataFrame
    broadcastable: bool

    @classmethod
    def fit(cls, lut: DataFrame, max_local_rows: int | None = None) -> "Lookup":
        spark = lut.sparkSession
        max_rows, max_bytes = _bound(spark, max_local_rows), _bound(spark, None, BYTES_CONF, DEFAULT_MAX_LOCAL_BYTES)
        # computed once: the sizes, the pull and (over a bound) the checkpoint read the cache
        cached = lut.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, size = cached.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(lut)), F.lit(0))).first()
            if rows <= max_rows and size <= max_bytes:
                return cls(local_table(spark, cached.toArrow(), lut.schema), True)
            return cls(cut_lineage(cached), False)
        finally:
            cached.unpersist()

    @classmethod
    def fit_split(cls, lut: DataFrame, by: str, max_local_rows: int | None = None) -> dict:
        """One lookup per value of ``by`` (e.g. per encoded feature): a feature with millions of levels
        is shuffle-joined without costing the small ones their broadcast. All local parts together
        stay under the bounds. The table is computed once (cached); they come back in one job."""
        spark = lut.sparkSession
        max_rows, max_bytes = _bound(spark, max_local_rows), _bound(spark, None, BYTES_CONF, DEFAULT_MAX_LOCAL_BYTES)
        cached = lut.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counted = cached.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"), F.sum(row_bytes(lut)).alias("_bytes")).collect()
            sizes = {r[by]: (r["_rows"], r["_bytes"]) for r in counted}
            # the smallest first, up to the bounds in all: the rest is joined with a shuffle
            small, rows, size = [], 0, 0
            for k in sorted(sizes, key=lambda k: (sizes[k], str(k))):
                rows, size = rows + sizes[k][0], size + sizes[k][1]
                if rows > max_rows or size > max_bytes:
                    break
                small.append(k)
            pulled = cached.where(F.col(by).isin(small)).toArrow() if small else None
            out = {k: cls(local_table(spark, pulled.filter(pc.equal(pulled[by], pa.scalar(k, pulled[by].type))), lut.schema), True) for k in small}
            for k in sizes:
                if k not in out:
                    out[k] = cls(cut_lineage(cached.where(F.col(by) == F.lit(k))), False)
            return out
        finally:
            cached.unpersist()

    def select_keys(self, keys: list[str]) -> "Lookup":
        return Lookup(self.df.select(*keys).distinct(), self.broadcastable)

    def join(self, df: DataFrame, on, how: str = "left") -> DataFrame:
        right = F.broadcast(self.df) if self.broadcastable else self.df
        return df.join(right, on, how)

    def join_null_safe(self, df: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
        """Like ``join`` on ``keys``, but a NULL key matches the lookup's NULL row."""
        right = self.df.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
        return df.join(F.broadcast(right) if self.broadcastable else right, same, how).drop(*[f"_key_{k}" for k in keys])


def collect_levels(df: DataFrame, cols: list[str], max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted non-null distinct levels of several columns in ONE aggregation pass.

    Raises when a column has more than ``max_levels`` levels: a wide pivot / one-hot of
    unbounded width is refused instead of collecting it to the driver.
    """
    if not cols:
        return {}
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols])
        ).alias("s")
    ).select("s.k", "s.v")
    levels = stacked.where(F.col("v").isNotNull()).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    cap = max_levels * len(cols) + 1
    rows = levels.limit(cap).collect()
    if len(rows) >= cap:
        raise ValueError(f"more than {max_levels} levels per column in {cols}")
    out: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        out[r["k"]].append(r["v"])
    for c in cols:
        if len(out[c]) > max_levels:
            raise ValueError(f"column {c} has more than {max_levels} levels")
        out[c].sort()
    return out
