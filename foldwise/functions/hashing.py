"""Deterministic pseudo-randomness as column expressions.

``uniform(id, seed)`` = first 8 hex digits of md5("id|seed") read as an unsigned integer
divided by 2^32. It depends only on the row's key and the seed, so every fold, split,
bootstrap weight or shuffle built on it is reproducible, re-computable after an executor loss,
and equal to the same formula written in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _key(cols, seed) -> Column:
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.concat_ws("|", *parts, F.lit(str(seed)))


def uniform(*cols, seed=42) -> Column:
    return F.conv(F.substring(F.md5(_key(cols, seed)), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def uniform_sql(*cols: str, seed=42) -> str:
    key = " || '|' || ".join([f"CAST({c} AS VARCHAR)" for c in cols] + [f"'{seed}'"])
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT / {TWO_POW_32})"


def poisson_thresholds(lam: float) -> list[float]:
    """Cumulative Poisson(lam) probabilities until the CDF is 1.0 in double precision."""
    out, p, cdf, k = [], math.exp(-lam), 0.0, 0
    while True:
        cdf += p
        if cdf >= 1.0 or p == 0.0:
            break
        out.append(cdf)
        k += 1
        p *= lam / k
    return out


def _tree(u, t, lo, hi, when, lit):
    """Smallest k in [lo, hi] with u < t[k] (hi = len(t) means none): a balanced comparison tree,
    so a draw costs about log2(len(t)) comparisons instead of a linear CASE chain."""
    if lo == hi:
        return lit(lo)
    mid = (lo + hi) // 2
    return when(u, t[mid], _tree(u, t, lo, mid, when, lit), _tree(u, t, mid + 1, hi, when, lit))


def poisson_weight(u: Column, lam: float) -> Column:
    """Inverse-CDF Poisson(lam) draw from a uniform column (exact in double precision)."""
    t = poisson_thresholds(lam)
    return _tree(u, t, 0, len(t), lambda x, th, a, b: F.when(x < F.lit(th), a).otherwise(b), F.lit)


def poisson_weight_sql(u_sql: str, lam: float) -> str:
    t = poisson_thresholds(lam)
    return _tree(u_sql, t, 0, len(t), lambda x, th, a, b: f"(CASE WHEN {x} < {th!r} THEN {a} ELSE {b} END)", str)
