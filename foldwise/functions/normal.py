"""Standard normal CDF and inverse CDF as column expressions (no UDF).

Fixed values:
* inverse CDF: P. J. Acklam's rational approximation (relative error about 1.15e-9),
  split at p_low = 0.02425.
* CDF: the double-precision algorithm of W. J. Cody / J. F. Hart as published by
  G. West, "Better approximations to cumulative normal functions" (2005).

The formulas are written once against a tiny expression protocol so that the same code
builds a Spark ``Column`` and the SQL text used by the DuckDB oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: Acklam inverse-normal coefficients --------------------------------
ACKLAM_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
            1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
ACKLAM_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
            6.680131188771972e01, -1.328068155288572e01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
            -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
            3.754408661907416e00)
ACKLAM_P_LOW = 0.02425

# ---- fixed values: Hart / West cumulative normal coefficients -------------------------
HART_NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
            112.079291497871, 221.213596169931, 220.206867912376)
HART_DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
            296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
HART_SWITCH = 7.07106781186547
HART_TAIL = 37.0
SQRT_2PI = 2.506628274631


class SqlExpr:
    """Minimal arithmetic on SQL text, mirroring Column operators."""

    def __init__(self, text: str):
        self.t = text

    @staticmethod
    def _s(o) -> str:
        return o.t if isinstance(o, SqlExpr) else repr(float(o))

    def _bin(self, op, o, rev=False):
        a, b = (self._s(o), self.t) if rev else (self.t, self._s(o))
        return SqlExpr(f"({a} {op} {b})")

    def __add__(self, o): return self._bin("+", o)
    def __radd__(self, o): return self._bin("+", o, True)
    def __sub__(self, o): return self._bin("-", o)
    def __rsub__(self, o): return self._bin("-", o, True)
    def __mul__(self, o): return self._bin("*", o)
    def __rmul__(self, o): return self._bin("*", o, True)
    def __truediv__(self, o): return self._bin("/", o)
    def __rtruediv__(self, o): return self._bin("/", o, True)
    def __neg__(self): return SqlExpr(f"(-{self.t})")


class _ColOps:
    lit = staticmethod(F.lit)
    sqrt = staticmethod(F.sqrt)
    log = staticmethod(F.log)
    exp = staticmethod(F.exp)
    abs = staticmethod(F.abs)

    @staticmethod
    def case(branches, default):
        expr = None
        for cond, val in branches:
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        return expr.otherwise(default)

    @staticmethod
    def lt(a, b): return a < b
    @staticmethod
    def gt(a, b): return a > b
    @staticmethod
    def isnull(a): return a.isNull()


class _SqlOps:
    @staticmethod
    def lit(v): return SqlExpr(repr(float(v)))
    @staticmethod
    def sqrt(a): return SqlExpr(f"sqrt({a.t})")
    @staticmethod
    def log(a): return SqlExpr(f"ln({a.t})")
    @staticmethod
    def exp(a): return SqlExpr(f"exp({a.t})")
    @staticmethod
    def abs(a): return SqlExpr(f"abs({a.t})")

    @staticmethod
    def case(branches, default):
        body = " ".join(f"WHEN {c.t} THEN {SqlExpr._s(v)}" for c, v in branches)
        return SqlExpr(f"(CASE {body} ELSE {SqlExpr._s(default)} END)")

    @staticmethod
    def lt(a, b): return SqlExpr(f"({SqlExpr._s(a)} < {SqlExpr._s(b)})")
    @staticmethod
    def gt(a, b): return SqlExpr(f"({SqlExpr._s(a)} > {SqlExpr._s(b)})")
    @staticmethod
    def isnull(a): return SqlExpr(f"({a.t} IS NULL)")


def _horner(coefs, x, ops):
    acc = ops.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + c
    return acc


def _ppf(p, ops):
    q_lo = ops.sqrt(ops.log(p) * -2.0)
    lower = _horner(ACKLAM_C, q_lo, ops) / (_horner(ACKLAM_D, q_lo, ops) * q_lo + 1.0)
    q_hi = ops.sqrt(ops.log(1.0 - p) * -2.0)
    upper = -(_horner(ACKLAM_C, q_hi, ops)) / (_horner(ACKLAM_D, q_hi, ops) * q_hi + 1.0)
    q = p - 0.5
    r = q * q
    central = _horner(ACKLAM_A, r, ops) * q / (_horner(ACKLAM_B, r, ops) * r + 1.0)
    return ops.case(
        [(ops.lt(p, ACKLAM_P_LOW), lower), (ops.gt(p, 1.0 - ACKLAM_P_LOW), upper)], central
    )


def _cdf(x, ops):
    ax = ops.abs(x)
    e = ops.exp(ax * ax * -0.5)
    near = e * _horner(HART_NUM, ax, ops) / _horner(HART_DEN, ax, ops)
    cf = ax + 0.65
    cf = ax + 4.0 / cf
    cf = ax + 3.0 / cf
    cf = ax + 2.0 / cf
    cf = ax + 1.0 / cf
    far = e / cf / SQRT_2PI
    tail = ops.case([(ops.gt(ax, HART_TAIL), ops.lit(0.0)), (ops.lt(ax, HART_SWITCH), near)], far)
    return ops.case([(ops.gt(x, 0.0), 1.0 - tail)], tail)


def norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF for p in (0, 1)."""
    return _ppf(p, _ColOps)


def ppf_point(p: Column) -> Column:
    """Where ``norm_ppf_at`` takes its polynomials, for p in (0, 1)."""
    tail = F.when(p < ACKLAM_P_LOW, p).when(p > 1.0 - ACKLAM_P_LOW, 1.0 - p)
    return F.when(tail.isNull(), p - 0.5).otherwise(F.sqrt(F.log(tail) * -2.0))


def norm_ppf_at(p: Column, q: Column) -> Column:
    """``norm_ppf(p)`` from ``q``, which is ``ppf_point(p)``: the same operations, with the point worked out once."""
    tail = _horner(ACKLAM_C, q, _ColOps) / (_horner(ACKLAM_D, q, _ColOps) * q + 1.0)
    r = q * q
    central = _horner(ACKLAM_A, r, _ColOps) * q / (_horner(ACKLAM_B, r, _ColOps) * r + 1.0)
    sign = F.when(p > 0.5, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when((p < ACKLAM_P_LOW) | (p > 1.0 - ACKLAM_P_LOW), sign * tail).otherwise(central)


def norm_cdf(x: Column) -> Column:
    return _cdf(x, _ColOps)


def norm_ppf_sql(p_sql: str) -> str:
    return _ppf(SqlExpr(p_sql), _SqlOps).t


def norm_cdf_sql(x_sql: str) -> str:
    return _cdf(SqlExpr(x_sql), _SqlOps).t


class _PyOps:
    lit = staticmethod(float)
    sqrt = staticmethod(math.sqrt)
    log = staticmethod(math.log)
    exp = staticmethod(math.exp)
    abs = staticmethod(abs)

    @staticmethod
    def case(branches, default):
        for cond, val in branches:
            if cond:
                return val
        return default

    @staticmethod
    def lt(a, b): return a < b
    @staticmethod
    def gt(a, b): return a > b


def norm_ppf_py(p: float) -> float:
    """Same approximation on the driver (used for clip constants and tests)."""
    if p < ACKLAM_P_LOW:
        q = math.sqrt(-2.0 * math.log(p))
        return _horner(ACKLAM_C, q, _PyOps) / (_horner(ACKLAM_D, q, _PyOps) * q + 1.0)
    if p > 1.0 - ACKLAM_P_LOW:
        q = math.sqrt(-2.0 * math.log(1.0 - p))
        return -_horner(ACKLAM_C, q, _PyOps) / (_horner(ACKLAM_D, q, _PyOps) * q + 1.0)
    q = p - 0.5
    r = q * q
    return _horner(ACKLAM_A, r, _PyOps) * q / (_horner(ACKLAM_B, r, _PyOps) * r + 1.0)


def norm_cdf_py(x: float) -> float:
    return _cdf(x, _PyOps)
