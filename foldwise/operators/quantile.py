"""Outlier bounds (P13), standard scaling (P14) and the quantile transformer.

Quantiles are exact (``column_quantiles``: brackets, counted and refined). NaN counts as missing, and a missing value
stays missing; a column that had no value at the fit is passed through as it is. The transform
locates each value among the distinct fitted quantiles with ``Bucketizer`` (binary search in
the JVM), then reads neighbours from small array literals, interpolates linearly (averaging
the forward and backward interpolation at repeated quantiles), applies the bound rules and,
for normal output, the inverse normal CDF with clipping. No Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.normal import norm_cdf, norm_ppf_at, norm_ppf_py, ppf_point
from foldwise.operators.lookup import local_table
from foldwise.operators.stats import column_quantiles, number

# ---- fixed values: bound threshold of the reference's quantile transformer ----------------
BOUNDS_THRESHOLD = 1e-7
_EPS = float(np.spacing(1))
CLIP_MIN = norm_ppf_py(BOUNDS_THRESHOLD - _EPS)
CLIP_MAX = norm_ppf_py(1 - (BOUNDS_THRESHOLD - _EPS))


# ---- outliers ----------------------------------------------------------------------------------

def fit_outlier_bounds(df: DataFrame, cols: list[str], whisker: float = 1.5, exact: bool = True) -> dict[str, tuple[float, float]]:
    q = column_quantiles(df, cols, [0.25, 0.75], exact=exact).collect()  # 2 rows per column
    return outlier_bounds_from({(r["column"], r["prob"]): r["quantile"] for r in q}, cols, whisker)


def outlier_bounds_from(quartiles: dict, cols: list[str], whisker: float = 1.5) -> dict[str, tuple[float, float]]:
    """Bounds from {(column, 0.25): q1, (column, 0.75): q3} (e.g. taken from a quantile fit)."""
    by = {}
    for (c, p), v in quartiles.items():
        by.setdefault(c, {})[p] = v
    out = {}
    for c in cols:
        q1, q3 = by.get(c, {}).get(0.25), by.get(c, {}).get(0.75)
        if q1 is None:
            out[c] = (None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1 - whisker * iqr, q3 + whisker * iqr)
    return out


def outlier_flag(df: DataFrame, bounds: dict, suffix: str = "_outlier") -> DataFrame:
    """0/1 flag; NULL and NaN are never outliers."""
    return df.withColumns({
        f"{c}{suffix}": F.coalesce((number(c) < F.lit(lo)) | (number(c) > F.lit(hi)), F.lit(False)).cast("int")
        for c, (lo, hi) in bounds.items()
    })


def outlier_null(df: DataFrame, bounds: dict) -> DataFrame:
    return df.withColumns({
        c: F.when((number(c) < F.lit(lo)) | (number(c) > F.lit(hi)), F.lit(None)).otherwise(F.col(c))
        for c, (lo, hi) in bounds.items()
    })


# ---- standard scaler ----------------------------------------------------------------------------

def fit_standard(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.avg(number(c)).alias(f"m_{c}") for c in cols], *[F.stddev_pop(number(c)).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        s = row[f"s_{c}"]
        out[c] = (row[f"m_{c}"], s if s else 1.0)  # zero variance -> scale 1
    return out


def standard_scale(df: DataFrame, params: dict) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


# ---- quantile transformer -----------------------------------------------------------------------

def references(n_quantiles: int) -> list[float]:
    return [float(x) for x in np.linspace(0.0, 1.0, n_quantiles)]


@dataclass
class QuantileState:
    refs: list[float]
    quantiles: dict[str, list[float]]

    def distinct(self, c: str):
        """distinct values with the reference of their first and last occurrence."""
        q = self.quantiles[c]
        d, lo, hi = [], [], []
        for i, v in enumerate(q):
            if d and v == d[-1]:
                hi[-1] = self.refs[i]
            else:
                d.append(v)
                lo.append(self.refs[i])
                hi.append(self.refs[i])
        return d, lo, hi


def fit_quantiles(df: DataFrame, cols: list[str], n_quantiles: int = 1000, exact: bool = True,
                  extra: dict | None = None) -> tuple[QuantileState, DataFrame]:
    """Fit the transformer's quantiles. ``extra`` (a dict) receives {(column, prob): value} for
    the probabilities it lists under the key "probs", computed in the same sort (e.g. the
    quartiles for outlier bounds)."""
    n = df.count()
    nq = max(1, min(n_quantiles, n))
    refs = references(nq)
    extra_probs = [p for p in (extra or {}).get("probs", []) if p not in set(refs)]
    table = column_quantiles(df, cols, refs + extra_probs, exact=exact)
    rows = table.collect()  # len(cols) x (n_quantiles + extras) values: bounded by the parameters
    qs = {c: [None] * nq for c in cols}
    idx = {p: i for i, p in enumerate(refs)}
    for r in rows:
        if extra is not None and r["prob"] in set((extra or {}).get("probs", [])):
            extra[(r["column"], r["prob"])] = r["quantile"]
        if r["prob"] in idx:
            qs[r["column"]][idx[r["prob"]]] = r["quantile"]
    for c in cols:  # a column without a value has no quantiles
        known = [] if None in qs[c] else qs[c]
        qs[c] = [float(v) for v in np.maximum.accumulate(np.array(known, dtype=float))]  # monotone, as the reference enforces
    flat = [(c, i, refs[i], q) for c in cols for i, q in enumerate(qs[c])]
    fitted = local_table(df.sparkSession, flat, "column string, idx int, reference double, quantile double")
    return QuantileState(refs, qs), fitted


def quantile_transform(df: DataFrame, st: QuantileState, cols: list[str], output: str = "normal", suffix: str = "") -> DataFrame:
    spark = df.sparkSession
    asked, cols = cols, [c for c in cols if st.quantiles[c]]
    if not cols:
        return df.withColumns({c + suffix: F.col(c).cast("double") for c in asked})
    distinct = {c: st.distinct(c) for c in cols}
    # one multi-column Bucketizer: m = index of the largest distinct quantile <= x, plus one
    bucketizer = Bucketizer(
        splitsArray=[[-float("inf"), *distinct[c][0], float("inf")] for c in cols],
        inputCols=[f"_x_{c}" for c in cols], outputCols=[f"_b_{c}" for c in cols], handleInvalid="keep",
    )
    out = bucketizer.transform(df.withColumns({f"_n_{c}": number(c) for c in cols}).withColumns({f"_x_{c}": F.coalesce(f"_n_{c}", F.lit(0.0)) for c in cols}))
    for c in cols:
        d, rlo, rhi = distinct[c]
        n = len(d)
        # neighbours of each distinct quantile: at most n_quantiles rows, broadcast on m
        rows = [(m, d[m - 1], rlo[m - 1], rhi[m - 1], d[min(m, n - 1)], rlo[min(m, n - 1)]) for m in range(1, n + 1)]
        lut = local_table(spark, rows, "m int, d double, lo double, hi double, dn double, lon double")
        lut = lut.select(F.col("m").alias(f"_m_{c}"), F.struct("d", "lo", "hi", "dn", "lon").alias(f"_l_{c}"))
        out = out.join(F.broadcast(lut), F.col(f"_b_{c}").cast("int") == F.col(f"_m_{c}"), "left")

    def share(s):
        x, m, n, q0, qn, near = s["x"], s["m"], s["n"], s["q0"], s["qn"], s["near"]
        interp = (
            F.when(m <= 0, F.lit(0.0))
            .when(m >= n, F.when(x == near["d"], (near["lo"] + near["hi"]) / 2).otherwise(F.lit(1.0)))
            .when(x == near["d"], (near["lo"] + near["hi"]) / 2)
            .otherwise(near["hi"] + (x - near["d"]) * (near["lon"] - near["hi"]) / (near["dn"] - near["d"]))
        )
        if output == "normal":
            lower, upper = (x - F.lit(BOUNDS_THRESHOLD)) < q0, (x + F.lit(BOUNDS_THRESHOLD)) > qn
        else:
            lower, upper = x == q0, x == qn
        return F.when(x.isNotNull(), F.when(lower, F.lit(0.0)).when(upper, F.lit(1.0)).otherwise(interp))

    def score(u):
        z = F.transform(F.array(ppf_point(u)), lambda q: norm_ppf_at(u, q))[0]
        z = F.when(u <= 0.0, F.lit(CLIP_MIN)).when(u >= 1.0, F.lit(CLIP_MAX)).otherwise(F.least(F.greatest(z, F.lit(CLIP_MIN)), F.lit(CLIP_MAX)))
        return F.when(u.isNotNull(), z)

    # one function over all columns: written out for each, the generated method soon has more than the 8,000 bytes
    # of code up to which the JVM compiles a method, and the whole stage is interpreted
    each = F.array(*[
        F.struct(
            F.col(f"_n_{c}").alias("x"), F.col(f"_b_{c}").cast("int").alias("m"), F.lit(len(distinct[c][0])).alias("n"),
            F.lit(distinct[c][0][0]).alias("q0"), F.lit(distinct[c][0][-1]).alias("qn"), F.col(f"_l_{c}").alias("near"),
        )
        for c in cols
    ])
    shares = F.transform(each, share)
    out = out.withColumn("_z", F.transform(shares, score) if output == "normal" else shares)
    z_cols = {c + suffix: F.col("_z")[i] for i, c in enumerate(cols)}
    z_cols |= {c + suffix: F.col(c).cast("double") for c in asked if c not in cols}
    helper = [f"_{k}_{c}" for c in cols for k in ("b", "n", "x", "m", "l")]
    return out.withColumns(z_cols).drop("_z", *helper)


def quantile_inverse(df: DataFrame, st: QuantileState, cols: list[str], output: str = "normal", suffix: str = "",
                     fitted: dict[str, str] | None = None) -> DataFrame:
    """Back from the output distribution to the data scale (linear interpolation on the quantiles).

    ``fitted`` maps a column to the fitted column whose quantiles it uses (default: same name).
    The reference grid is uniform, so the segment index is floor(u / step); the segment's end
    points come from a broadcast lookup of at most n_quantiles rows.
    """
    spark = df.sparkSession
    asked, cols = cols, [c for c in cols if st.quantiles[(fitted or {}).get(c, c)]]
    n = len(st.refs)
    step = 1.0 / (n - 1) if n > 1 else 1.0
    out = df.withColumns({f"_u_{c}": norm_cdf(number(c)) if output == "normal" else number(c)
                          for c in cols})
    for c in cols:
        qs = st.quantiles[(fitted or {}).get(c, c)]
        j = F.least(F.greatest(F.floor(F.col(f"_u_{c}") / F.lit(step)).cast("int"), F.lit(0)), F.lit(max(n - 2, 0)))
        out = out.withColumn(f"_j_{c}", j)
        rows = [(i, st.refs[i], st.refs[min(i + 1, n - 1)], float(qs[i]), float(qs[min(i + 1, n - 1)])) for i in range(max(n - 1, 1))]
        lut = local_table(spark, rows, f"_i_{c} int, _rj_{c} double, _rk_{c} double, _qj_{c} double, _qk_{c} double")
        out = out.join(F.broadcast(lut), F.col(f"_j_{c}") == F.col(f"_i_{c}"), "left")
    res_cols = {}
    for c in cols:
        qs = st.quantiles[(fitted or {}).get(c, c)]
        z = number(c)
        u = F.col(f"_u_{c}")
        if output == "normal":
            lower, upper = (u - F.lit(BOUNDS_THRESHOLD)) < F.lit(0.0), (u + F.lit(BOUNDS_THRESHOLD)) > F.lit(1.0)
        else:
            lower, upper = u == F.lit(0.0), u == F.lit(1.0)
        rj, rk, qj, qk = (F.col(f"_{k}_{c}") for k in ("rj", "rk", "qj", "qk"))
        val = F.when(rk == rj, qj).otherwise(qj + (u - rj) * (qk - qj) / (rk - rj))
        res = F.when(lower, F.lit(qs[0])).when(upper, F.lit(qs[-1])).otherwise(val)
        res_cols[c + suffix] = F.when(z.isNull(), F.lit(None).cast("double")).otherwise(res)
    res_cols |= {c + suffix: F.col(c).cast("double") for c in asked if c not in cols}
    helper = [f"_{k}_{c}" for c in cols for k in ("u", "j", "i", "rj", "rk", "qj", "qk")]
    return out.withColumns(res_cols).drop(*helper)
