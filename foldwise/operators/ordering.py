"""Global order statistics without a single-partition window.

``with_global_rank`` numbers rows 1..n in a total order: range-partition on the order key,
sort inside each partition, read the in-partition position from
``monotonically_increasing_id`` (partition index in the upper bits), and add the partition's
offset from a tiny per-partition count table (one row per partition, broadcast).

``with_global_cumsum`` adds running sums in a total order the same way; the in-partition
running sum is an Arrow-batched ``mapInPandas`` over the sorted partition.

The range-partitioned, numbered rows are written once with a reliable ``checkpoint`` (to the
shared ``spark.checkpoint.dir``) before the per-partition totals are taken: two independent
executions of a range shuffle may draw different range bounds (the bound sample is seeded per
RDD), so positions and offsets must come from the same materialised partitions. The
checkpoint also makes the result survive executor loss without recomputing the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.session import cut_lineage

_LOW_BITS = (1 << 33) - 1


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _offsets(per_part: DataFrame, value_cols: list[str]) -> DataFrame:
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_pid", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_off_{c}") for c in value_cols]
    )


def with_global_rank(df: DataFrame, order: list, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of the row in ``order`` (must be a total order)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    sort_cols = [c.asc_nulls_first() if isinstance(o, str) else c for c, o in zip(cols, order)]
    ranged = df.repartitionByRange(_n_partitions(df, partitions), *cols).sortWithinPartitions(*sort_cols)
    ranged = cut_lineage(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, ["_n"])
    out = ranged.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off__n") + F.col("_pos") + 1)
    return out.drop("_mid", "_pid", "_pos", "_off__n")


def with_global_cumsum(
    df: DataFrame,
    order: list[str],
    value_cols: list[str],
    suffix: str = "_cum",
    partitions: int | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{c}{suffix}`` of ``value_cols`` in ``order``.

    ``order`` must be a total order on the rows (e.g. distinct scores).
    """
    ranged = df.repartitionByRange(_n_partitions(df, partitions), *order).sortWithinPartitions(*order)
    ranged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id().cast("long")))
    out_fields = list(ranged.schema.fields) + [
        T.StructField(f"{c}_local", T.DoubleType()) for c in value_cols
    ]
    out_schema = T.StructType(out_fields)

    def local_cumsum(batches):
        carry = {c: 0.0 for c in value_cols}
        for pdf in batches:
            for c in value_cols:
                vals = pdf[c].astype("float64").fillna(0.0)
                cs = vals.cumsum() + carry[c]
                if len(cs):
                    carry[c] = float(cs.iloc[-1])
                pdf[f"{c}_local"] = cs
            yield pdf

    local = ranged.mapInPandas(local_cumsum, out_schema)
    totals = ranged.groupBy("_pid").agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in value_cols])
    offsets = _offsets(totals, value_cols)
    joined = local.join(F.broadcast(offsets), "_pid")
    return joined.select(
        *[F.col(f.name) for f in df.schema.fields],
        *[(F.col(f"{c}_local") + F.col(f"_off_{c}")).alias(f"{c}{suffix}") for c in value_cols],
    )
