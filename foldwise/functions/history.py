"""Ragged comma-separated history strings, handled with higher-order array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_30_DAYS = 2.592e12


def history_items(c: Column, null_fill: str = ",,,") -> Column:
    return F.split(F.coalesce(c, F.lit(null_fill)), ",")


def history_sum(c: Column) -> Column:
    """Sum of the items; empty (or unparseable) items count 0, a NULL history sums to 0.

    Empty items are tested before ``try_cast``: a failed cast is far more expensive than a
    comparison, and empty items are the common case in these histories.
    """
    return F.aggregate(
        history_items(c),
        F.lit(0.0),
        lambda acc, x: acc + F.when(x == "", F.lit(0.0)).otherwise(F.coalesce(x.try_cast("double"), F.lit(0.0))),
    )


_ITEM8 = r"(?:^|,)[^,]{8}(?=,|$)"  # an item of exactly 8 characters


def history_date_gap(reported: Column, c: Column, fmt: str = "yyyyMMdd") -> Column:
    """Mean gap, in 30-day months, between ``reported`` and each 8-character date item.

    NULL inputs or an unparseable 8-character item give 0; no 8-character item gives NULL.
    One pass over the items with a double accumulator: each 8-character item adds its
    wall-clock gap (``timestamp_diff`` on ``timestamp_ntz``, so the session time zone does not
    matter), an unparseable one adds NaN, which then marks the whole row. The number of
    8-character items comes from one regex count, and the division happens in the finish step.
    """
    # wall-clock micros since the epoch, once per row (time-zone free); items are whole days
    rep = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), reported.cast("timestamp_ntz"))
    n_items = F.regexp_count(c, F.lit(_ITEM8))

    def step(acc, x):
        day = F.unix_date(F.try_to_date(x, fmt)).cast("long")
        gap = (rep - day * F.lit(86_400_000_000)) / F.lit(MICROS_PER_30_DAYS)
        return acc + F.when(F.length(x) == 8, F.coalesce(gap, F.lit(float("nan")))).otherwise(F.lit(0.0))

    mean = F.aggregate(F.split(c, ","), F.lit(0.0), step, lambda acc: F.when(F.isnan(acc), F.lit(0.0)).otherwise(acc / n_items))
    return (
        F.when(reported.isNull() | c.isNull(), F.lit(0.0))
        .when(n_items == 0, F.lit(None).cast("double"))
        .otherwise(mean)
    )
