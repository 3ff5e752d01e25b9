"""Date features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldwise.functions.history import MICROS_PER_30_DAYS


def date_parts(c: Column, prefix: str) -> dict[str, Column]:
    """day, weekday (Monday = 0), month, year."""
    return {
        f"{prefix}_day": F.dayofmonth(c),
        f"{prefix}_weekday": F.weekday(c),
        f"{prefix}_month": F.month(c),
        f"{prefix}_year": F.year(c),
    }


def micros_between(later: Column, earlier: Column) -> Column:
    """Wall-clock microseconds from ``earlier`` to ``later``.

    Both sides are read as ``timestamp_ntz``, so the result does not depend on the session
    time zone (a cast to ``timestamp`` would shift across daylight-saving changes).
    """
    return F.timestamp_diff("MICROSECOND", earlier.cast("timestamp_ntz"), later.cast("timestamp_ntz"))


def months_30d(later: Column, earlier: Column) -> Column:
    """(later - earlier) / 30 days, as a double."""
    return micros_between(later, earlier) / F.lit(MICROS_PER_30_DAYS)


def months_30d_or_zero(later: Column, earlier: Column) -> Column:
    """Null-safe variant: 0 when either side is NULL."""
    return F.coalesce(months_30d(later, earlier), F.lit(0.0))
