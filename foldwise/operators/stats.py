"""Statistics and profiles (A5-A9, W1-W2, X1-X8) and exact distributed quantiles.

Exact quantiles come by bracket refinement. One aggregate counts the values of a group and sketches an edge a little
below and above each requested place; a second counts the values at and between the edges, so that each place is known to
be an edge itself or to lie in one bracket. Only the rows of such brackets are ranked; a bracket of more than
``RANKED_ROWS`` rows is refined like a group of its own. The sketch decides how much is left to rank, never the result.
No data-size sort, no checkpoint. Linear interpolation matches numpy / pandas / ``percentile`` / ``quantile_cont``.
NULL and NaN are missing.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.lookup import Lookup, local_table

RANKED_ROWS = 1 << 20  # rows of a group that are ranked as they are


def stack(cols: dict[str, Column], name_col: str = "column", value_col: str = "value") -> Column:
    """explode(array(struct(name, value), ...)) helper: wide row -> long rows."""
    return F.explode(
        F.array(*[F.struct(F.lit(n).alias(name_col), c.alias(value_col)) for n, c in cols.items()])
    )


def number(c: str | Column) -> Column:
    """As a double; NaN is missing, and -0.0 is 0.0."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(v), v + 0.0)


def _edges(value: Column, probs: list[float], accuracy: int) -> Column:
    """Sorted sketched values a little below and above the requested places."""
    margin = 2.0 / accuracy
    grid = sorted({min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)})
    return F.array_sort(F.array_distinct(F.percentile_approx(value, grid, accuracy)))


def _accuracy(probs: list[float]) -> int:
    return max(10_000, 20 * len(probs))


def order_statistics(data: DataFrame, keys: list[str], wanted: DataFrame, probs: list[float], rows: int = RANKED_ROWS) -> DataFrame:
    """``wanted``: ``keys``, ``_rank`` (from 0), a small table. Adds ``_v``: the value at that place among ``data``'s ``_v``
    of the keys. ``probs``: about where in their groups the places lie."""
    asked = Lookup.fit(wanted.distinct())
    data = asked.select_keys(keys).join_null_safe(data, keys, "inner")
    sizes = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= rows:
        order = Window.partitionBy(*keys).orderBy("_v")
        return asked.join_null_safe(data.withColumn("_rank", F.row_number().over(order) - 1), [*keys, "_rank"], "inner")
    edges = Lookup.fit(data.groupBy(*keys).agg(_edges(F.col("_v"), probs, _accuracy(probs)).alias("_e")))
    cell = F.aggregate("_e", F.lit(0), lambda n, e: n + (e < F.col("_v")).cast("int") + (e <= F.col("_v")).cast("int"))
    celled = edges.join_null_safe(data, keys, "inner").withColumn("_cell", cell).drop("_e")
    return _from_cells(celled, keys, asked.df, rows)


def _from_cells(celled: DataFrame, keys: list[str], wanted: DataFrame, rows: int) -> DataFrame:
    """The places by exact counts of cells: those of one value are that value, the others are looked for inside."""
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = celled.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    cells = cells.withColumn("_start", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    inside = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_c"))
    hit = Lookup.fit(Lookup.fit(wanted).join_null_safe(cells, keys, "inner").where(inside).select(*keys, "_rank", "_cell", "_start", "_lo", "_hi"))
    known = hit.df.where("_lo = _hi").select(*keys, "_rank", F.col("_lo").alias("_v"))
    open_ = hit.df.where("_lo < _hi")
    if open_.isEmpty():
        return known
    deeper = f"_in{len(keys)}"
    local = open_.select(*keys, F.col("_cell").alias(deeper), (F.col("_rank") - F.col("_start")).alias("_rank"), F.col("_start").alias("_base"))
    found = order_statistics(celled.withColumnRenamed("_cell", deeper), [*keys, deeper], local.drop("_base"), [i / 32 for i in range(1, 32)], rows)
    starts = Lookup(local.select(*keys, deeper, "_base").distinct(), hit.broadcastable)
    found = starts.join_null_safe(found, [*keys, deeper], "inner")
    return known.unionByName(found.select(*keys, (F.col("_rank") + F.col("_base")).alias("_rank"), "_v"))


def _places(sizes: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """The two places around each requested probability and the weight of the upper one."""
    h = (F.col("_n") - 1) * F.col("prob")
    each = sizes.select(*keys, "_n", F.explode(F.array(*[F.lit(float(x)) for x in probs])).alias("prob"))
    return each.select(*keys, "prob", F.floor(h).alias("_lo"), F.ceil(h).alias("_hi"), (h - F.floor(h)).alias("_frac"))


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], rows: int = RANKED_ROWS) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group: (keys..., prob, quantile). Groups without a value
    have no row; NULL keys are a group."""
    data = df.select(*keys, number(value).alias("_v")).where("_v is not null")
    places = Lookup.fit(_places(data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, probs))
    wanted = places.df.select(*keys, F.explode(F.array("_lo", "_hi")).alias("_rank"))
    found = Lookup.fit(order_statistics(data, keys, wanted, probs, rows))
    return _interpolated(places.df, found, keys)


def _interpolated(places: DataFrame, found: Lookup, keys: list[str]) -> DataFrame:
    low = Lookup(found.df.withColumnsRenamed({"_rank": "_lo", "_v": "_vlo"}), found.broadcastable)
    high = Lookup(found.df.withColumnsRenamed({"_rank": "_hi", "_v": "_vhi"}), found.broadcastable)
    got = high.join_null_safe(low.join_null_safe(places, [*keys, "_lo"], "inner"), [*keys, "_hi"], "inner")
    same = F.col("_vhi") == F.col("_vlo")  # also where both are infinite
    q = F.when(same, F.col("_vlo")).otherwise(F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo")))
    return got.select(*keys, "prob", q.alias("quantile"))


def _celled_columns(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """``column``, ``_v``, ``_cell`` for several columns with many edges each: one binary search a value in the JVM. An
    edge is a cell of its own, up to the next double."""
    splits = {c: sorted({-math.inf, math.inf, *e, *np.nextafter(e, math.inf).tolist()}) for c, e in edges.items()}
    wide = df.select(*[number(c).alias(f"_v_{c}") for c in edges], *[F.coalesce(number(c), F.lit(0.0)).alias(f"_x_{c}") for c in edges])
    search = Bucketizer(splitsArray=list(splits.values()), inputCols=[f"_x_{c}" for c in edges], outputCols=[f"_b_{c}" for c in edges])
    long = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`_v_{c}`").alias("_v"), F.col(f"`_b_{c}`").cast("int").alias("_cell")) for c in edges])
    return search.transform(wide).select(F.inline(long)).where("_v is not null")


def _exact_columns(df: DataFrame, cols: list[str], probs: list[float], rows: int) -> DataFrame:
    spark = df.sparkSession
    sketch = df.agg(*[F.count(number(c)).alias(f"n_{i}") for i, c in enumerate(cols)], *[_edges(number(c), probs, _accuracy(probs)).alias(f"e_{i}") for i, c in enumerate(cols)]).first()
    sizes = {c: sketch[f"n_{i}"] for i, c in enumerate(cols) if sketch[f"n_{i}"]}
    if not sizes:
        return local_table(spark, [], "column string, prob double, quantile double")
    places = _places(local_table(spark, list(sizes.items()), "column string, _n long"), ["column"], probs)
    wanted = places.select("column", F.explode(F.array("_lo", "_hi")).alias("_rank")).distinct()
    if max(sizes.values()) <= rows:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), number(c).alias("_v")) for c in sizes]))).where("_v is not null")
        found = order_statistics(long, ["column"], wanted, probs, rows)
    else:
        edges = {c: sketch[f"e_{i}"] for i, c in enumerate(cols) if c in sizes}
        found = _from_cells(_celled_columns(df, edges), ["column"], wanted, rows)
    return _interpolated(places, Lookup.fit(found), ["column"])


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True,
                     accuracy: int = 100_000, rows: int = RANKED_ROWS) -> DataFrame:
    """Quantiles of several columns at once: (column, prob, quantile). A column without a value has no row.

    exact: brackets from one aggregate over all columns, cells counted by one more, the rest ranked (linear
    interpolation, equals numpy / DuckDB). approximate: ``percentile_approx`` sketches, one map-side-combined aggregation; relative
    rank error about 1 / accuracy, no sort. The choice for the largest inputs.
    """
    if exact:
        return _exact_columns(df, cols, probs, rows)
    long = df.select(stack({c: number(c) for c in cols}).alias("s")).select("s.column", "s.value")
    arr = long.where(F.col("value").isNotNull()).groupBy("column").agg(
        F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("_q"))
    return arr.select("column", F.posexplode("_q").alias("_i", "quantile")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1).alias("prob"), "quantile")


# ---- group statistics ------------------------------------------------------------------------

AGG_FUNCS = {
    "nunique": lambda c: F.count_distinct(F.col(c)),
    "count": lambda c: F.count(F.col(c)),
    "size": lambda c: F.count(F.lit(1)),
    "mean": lambda c: F.avg(F.col(c)),
    "max": lambda c: F.max(F.col(c)),
    "min": lambda c: F.min(F.col(c)),
    "sum": lambda c: F.coalesce(F.sum(F.col(c)), F.lit(0)),
    "std": lambda c: F.stddev_samp(F.col(c)),
}


def group_stats(df: DataFrame, keys: list[str], spec: dict[str, list[str]], prefix: str) -> DataFrame:
    """pandas-style ``groupby(keys).agg(spec)`` with flattened names ``{prefix}_{col}_{func}``.

    Rows with a NULL key are dropped (pandas semantics).
    """
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    aggs = [AGG_FUNCS[f](c).alias(f"{prefix}_{c}_{f}") for c, fs in spec.items() for f in fs]
    return df.where(cond).groupBy(*keys).agg(*aggs)


def join_group_stats(df: DataFrame, keys: list[str], spec: dict[str, list[str]], prefix: str) -> DataFrame:
    """Group stats joined back to every row (size-checked broadcast of the per-group table)."""
    return Lookup.fit(group_stats(df, keys, spec, prefix)).join(df, keys, "left")


def group_transform(df: DataFrame, keys: list[str], value: str, funcs: list[str], names: dict[str, str]) -> DataFrame:
    """Per-row group statistics (pandas ``groupby().transform``) as aggregate + join.

    A window ``partitionBy(keys)`` would put a whole group into one task; the aggregate
    combines map-side and the join back is broadcast (size checked) or skew-split by AQE.
    """
    stats = group_stats(df, keys, {value: funcs}, "_g")
    stats = stats.select(*keys, *[F.col(f"_g_{value}_{f}").alias(names[f]) for f in funcs])
    return Lookup.fit(stats).join(df, keys, "left")


# ---- correlation -----------------------------------------------------------------------------

def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every pair i < j in one aggregation, as a long table (i, j, col_i, col_j, r)."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    row = df.agg(*[F.corr(cols[i], cols[j]).alias(f"r_{i}_{j}") for i, j in pairs])
    return row.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(cols[i]).alias("col_i"),
                         F.lit(cols[j]).alias("col_j"), F.col(f"r_{i}_{j}").alias("r"))
                for i, j in pairs
            ])
        ).alias("s")
    ).select("s.*")


def correlated_to_drop(corr: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Columns j with any upper-triangle r_ij > threshold (signed, as in the reference)."""
    return corr.where(F.col("r") > threshold).groupBy("j", "col_j").agg(F.max("r").alias("max_r"))


# ---- profiles ----------------------------------------------------------------------------------

def profile_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.select(
        F.col("_n"), stack({c: F.col(c) for c in cols}, "column", "n_missing").alias("s")
    ).select("s.column", "s.n_missing", (F.col("s.n_missing") / F.col("_n")).alias("share_missing"))


def profile_nunique(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else (lambda c: F.count_distinct(F.col(c)))
    row = df.agg(*[fn(c).alias(c) for c in cols])
    return row.select(stack({c: F.col(c) for c in cols}, "column", "nunique").alias("s")).select("s.*")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 50, transform=None) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed on the right)."""
    x = transform(F.col(col)) if transform else F.col(col)
    data = df.select(x.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    mm = data.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return data.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = data.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "count",
    )


def box_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR) and outlier count per group."""
    q = grouped_quantiles(df, keys, value, [0.25, 0.5, 0.75])
    wide = q.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]]
    )
    wide = wide.withColumn("iqr", F.col("q3") - F.col("q1"))
    lk = Lookup.fit(wide)
    j = lk.join(df.select(*keys, number(value).alias("_x")).where(F.col("_x").isNotNull()), keys, "inner")
    lo_b = F.col("q1") - 1.5 * F.col("iqr")
    hi_b = F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col("_x") >= lo_b) & (F.col("_x") <= hi_b)
    return j.groupBy(*keys, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


def crosstab(df: DataFrame, row: str, col: str, col_levels: list) -> DataFrame:
    """row x col counts, columns for the fitted ``col_levels`` (a pivot with explicit values)."""
    return df.groupBy(row).pivot(col, col_levels).agg(F.count(F.lit(1))).na.fill(0)


def null_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count of rows per null pattern ('1' = missing), as in a missing-value heat map."""
    pattern = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("count"))
