"""Projection, cleaning and type conversion (P1-P12) and simple fills."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.lookup import Lookup

# ---- fixed values: the reference's payment-mode recoding (7 entries) ------------------
PAYMENT_MODE_MAP = {
    "Cheque": "PDC",
    "Auto Debit": "Billed",
    "PDC_E": "PDC",
    "SI Reject": "Reject",
    "ECS Reject": "Reject",
    "PDC Reject": "Reject",
    "Escrow": "Direct Debit",
}
# ---- fixed values: censored duration text and its value; reference date for date fills --
CENSORED_TEXT, CENSORED_VALUE = "14+", 15
REFERENCE_DATE = "2020-12-31"


def extract_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    return df.drop(*([cols] if isinstance(cols, str) else cols))


def recode(c: Column, mapping: dict) -> Column:
    """Value-map replace: mapped values are replaced, everything else passes through."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.element_at(m, c), c) if mapping else c


def recode_censored(c: Column, text: str = CENSORED_TEXT, value: float = CENSORED_VALUE,
                    null_value: float | None = 0.0) -> Column:
    out = F.when(c == F.lit(text), F.lit(float(value))).otherwise(c.try_cast("double"))
    return F.coalesce(out, F.lit(null_value)) if null_value is not None else out


def fit_levels(df: DataFrame, cols: list[str]) -> dict[str, Lookup]:
    """One table of the levels seen at fit time for each category column, however many there are: one
    aggregation of all columns, size-checked broadcast or shuffle join per column. A column without a
    non-null level has no entry."""
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("level")) for c in cols])))
    found = Lookup.fit_split(stacked.where(F.col("level").isNotNull()).distinct(), "k")
    return {c: Lookup(lk.df.select(F.col("level").alias("_level")), lk.broadcastable) for c, lk in found.items()}


def to_category(df: DataFrame, c: str, levels: Lookup | None) -> DataFrame:
    """Keep fitted levels, unseen -> NULL."""
    if levels is None:
        return df.withColumn(c, F.lit(None).cast("string"))
    joined = levels.join(df.withColumn(c, F.col(c).cast("string")), F.col(c) == F.col("_level"))
    return joined.withColumn(c, F.col("_level")).drop("_level")


def type_conversion(
    df: DataFrame,
    levels: dict[str, Lookup],
    double_cols: list[str] = (),
    int_cols: list[str] = (),
    timestamp_cols: list[str] = (),
    string_cols: list[str] = (),
    category_cols: list[str] | None = None,
) -> DataFrame:
    """``category_cols``: the columns to hold against ``levels`` (default: all that have some)."""
    exprs = {}
    for c in double_cols:
        exprs[c] = F.col(c).cast("double")
    for c in int_cols:
        exprs[c] = F.col(c).cast("int")
    for c in timestamp_cols:
        exprs[c] = F.col(c).cast("timestamp")
    for c in string_cols:
        exprs[c] = F.col(c).cast("string")
    df = df.withColumns(exprs) if exprs else df
    for c in category_cols if category_cols is not None else levels:
        df = to_category(df, c, levels.get(c))
    return df


def feature_union(df: DataFrame, parts: list[dict[str, Column]]) -> DataFrame:
    """Side-by-side union of several transformers' outputs: one projection, no positional concat."""
    merged: dict[str, Column] = {}
    for p in parts:
        merged.update(p)
    return df.withColumns(merged)


# ---- imputation ----------------------------------------------------------------------

def fit_mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value, ties -> the smallest value, as a 1-row table.

    Two-phase and distributed: count per value (map-side combined), then one global
    ``min_by`` over (−count, value). No per-group value map is ever buffered.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias("mode"))


def mode_value(df: DataFrame, col: str):
    return fit_mode(df, col).first()["mode"]


def fit_means(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """All column means in one aggregation (a 1-row result)."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Constant / fitted-value fill as ``coalesce`` (keeps column types)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def fill_dates(df: DataFrame, cols: list[str] | dict[str, str], date: str = REFERENCE_DATE) -> DataFrame:
    """Missing dates -> a fixed reference date (never 'today': results must be reproducible), or with a
    dict of column -> date each column's own."""
    dates = cols if isinstance(cols, dict) else dict.fromkeys(cols, date)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.to_timestamp(F.lit(v)).cast(df.schema[c].dataType)) for c, v in dates.items()}
    )
