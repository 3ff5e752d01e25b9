"""Outliers, scaling and the quantile transformer bound to the entity table."""

from __future__ import annotations


from foldwise.functions.normal import norm_cdf_sql, norm_ppf_sql
from foldwise.operators import quantile as Q
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query

QCOLS = ["o_totalprice", "c_acctbal"]
NQ = 1000


def _quantiles_sql(src: str, col: str, probs_sql: str) -> str:
    """Exact linear-interpolated quantiles by row position (same arithmetic as the Spark operator)."""
    return f"""(WITH v AS (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL),
  r AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS rn FROM v),
  c AS (SELECT count(*) AS n FROM v),
  t AS (SELECT p.*, (c.n - 1) * p.prob AS h FROM {probs_sql} p, c)
  SELECT t.* EXCLUDE (h), a.x + (t.h - floor(t.h)) * (b.x - a.x) AS quantile
  FROM t JOIN r a ON a.rn = floor(t.h) JOIN r b ON b.rn = ceil(t.h))"""


_BOUNDS_SQL = {
    c: _quantiles_sql(ENTITY_SQL, c, "(SELECT unnest([0.25, 0.75]) AS prob)") for c in QCOLS
}


def _bound(c, which, src=None):
    q = _BOUNDS_SQL[c] if src is None else _quantiles_sql(src, c, "(SELECT unnest([0.25, 0.75]) AS prob)")
    q1 = f"(SELECT quantile FROM {q} WHERE prob = 0.25)"
    q3 = f"(SELECT quantile FROM {q} WHERE prob = 0.75)"
    return f"({q1} - 1.5 * ({q3} - {q1}))" if which == "lo" else f"({q3} + 1.5 * ({q3} - {q1}))"


@query(
    "outlier_flag",
    sql=f"SELECT ID, {', '.join(QCOLS)}, "
    + ", ".join(f"CAST(coalesce({c} < {_bound(c, 'lo')} OR {c} > {_bound(c, 'hi')}, false) AS INTEGER) AS {c}_outlier" for c in QCOLS)
    + f" FROM {ENTITY_SQL}",
)
def q_outlier_flag(spark, d):
    e = entity(spark, d, ["ID", *QCOLS])
    return round_doubles(Q.outlier_flag(e, Q.fit_outlier_bounds(e, QCOLS)))


@query(
    "outlier_null",
    sql="SELECT ID, "
    + ", ".join(f"round(CASE WHEN {c} < {_bound(c, 'lo')} OR {c} > {_bound(c, 'hi')} THEN NULL ELSE {c} END, 6) AS {c}" for c in QCOLS)
    + f" FROM {ENTITY_SQL}",
)
def q_outlier_null(spark, d):
    e = entity(spark, d, ["ID", *QCOLS])
    return round_doubles(Q.outlier_null(e, Q.fit_outlier_bounds(e, QCOLS)))


@query(
    "standard_scale",
    sql="SELECT ID, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM {ENTITY_SQL})) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM {ENTITY_SQL}), 6) AS {c}"
        for c in QCOLS
    )
    + f" FROM {ENTITY_SQL}",
)
def q_standard(spark, d):
    e = entity(spark, d, ["ID", *QCOLS])
    return round_doubles(Q.standard_scale(e, Q.fit_standard(e, QCOLS)))


def _refs_sql(nq, src=None):
    """linspace(0, 1, n) with n = min(nq, rows of src) (the transformer's n_quantiles rule)."""
    if src is None:
        return (
            f"(SELECT i AS idx, CASE WHEN i = {nq - 1} THEN 1.0 ELSE i * (1.0::DOUBLE / {nq - 1}) END AS prob "
            f"FROM (SELECT unnest(range({nq})) AS i))"
        )
    n = f"(SELECT least({nq}, count(*)) FROM {src})"
    return (
        f"(SELECT i AS idx, CASE WHEN i = {n} - 1 THEN 1.0 ELSE i * (1.0::DOUBLE / ({n} - 1)) END AS prob "
        f"FROM (SELECT unnest(range({nq})) AS i) WHERE i < {n})"
    )


def _fitted_sql(col, nq=NQ, src=None):
    raw = _quantiles_sql(src or ENTITY_SQL, col, _refs_sql(nq, src))
    return f"(SELECT idx, prob AS reference, max(quantile) OVER (ORDER BY idx ROWS UNBOUNDED PRECEDING) AS quantile FROM {raw})"


@query(
    "quantile_fit",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(idx AS INTEGER) AS idx, round(reference, 6) AS reference, round(quantile, 6) AS quantile FROM {_fitted_sql(c)}"
        for c in QCOLS
    ),
)
def q_quantile_fit(spark, d):
    _, fitted = Q.fit_quantiles(entity(spark, d), QCOLS, NQ)
    return round_doubles(fitted)


def _forward_sql(c, output, src=None):
    f = _fitted_sql(c, src=src)
    dq = f"(SELECT quantile AS d, min(reference) AS rlo, max(reference) AS rhi FROM {f} GROUP BY quantile)"
    dq2 = f"(SELECT d, rlo, rhi, lead(d) OVER (ORDER BY d) AS dn, lead(rlo) OVER (ORDER BY d) AS lon FROM {dq})"
    q0 = f"(SELECT min(quantile) FROM {f})"
    qn = f"(SELECT max(quantile) FROM {f})"
    x = f"e.{c}"
    interp = (
        f"CASE WHEN g_{c}.d IS NULL THEN 0.0 WHEN g_{c}.dn IS NULL THEN (CASE WHEN {x} = g_{c}.d THEN (g_{c}.rlo + g_{c}.rhi) / 2 ELSE 1.0 END) "
        f"WHEN {x} = g_{c}.d THEN (g_{c}.rlo + g_{c}.rhi) / 2 "
        f"ELSE g_{c}.rhi + ({x} - g_{c}.d) * (g_{c}.lon - g_{c}.rhi) / (g_{c}.dn - g_{c}.d) END"
    )
    if output == "normal":
        lower, upper = f"({x} - 1e-07) < {q0}", f"({x} + 1e-07) > {qn}"
    else:
        lower, upper = f"{x} = {q0}", f"{x} = {qn}"
    u = f"(CASE WHEN {lower} THEN 0.0 WHEN {upper} THEN 1.0 ELSE {interp} END)"
    if output == "normal":
        z = (
            f"(CASE WHEN {u} <= 0.0 THEN {Q.CLIP_MIN!r} WHEN {u} >= 1.0 THEN {Q.CLIP_MAX!r} "
            f"ELSE least(greatest({norm_ppf_sql(u)}, {Q.CLIP_MIN!r}), {Q.CLIP_MAX!r}) END)"
        )
    else:
        z = u
    return dq2, f"CASE WHEN {x} IS NULL THEN NULL ELSE {z} END"


def _transform_sql(output, rounded=True, fit_src=None):
    joins, sel = [], ["e.ID"]
    for c in QCOLS:
        dq2, expr = _forward_sql(c, output, fit_src)
        joins.append(f"ASOF LEFT JOIN {dq2} g_{c} ON e.{c} >= g_{c}.d")
        sel.append(f"round({expr}, 6) AS {c}" if rounded else f"{expr} AS {c}")
    return f"SELECT {', '.join(sel)} FROM {ENTITY_SQL} e " + " ".join(joins)


@query("quantile_uniform", sql=_transform_sql("uniform"))
def q_quantile_uniform(spark, d):
    e = entity(spark, d, ["ID", *QCOLS])
    st, _ = Q.fit_quantiles(e, QCOLS, NQ)
    return round_doubles(Q.quantile_transform(e, st, QCOLS, "uniform"))


@query("quantile_normal", sql=_transform_sql("normal"))
def q_quantile_normal(spark, d):
    e = entity(spark, d, ["ID", *QCOLS])
    st, _ = Q.fit_quantiles(e, QCOLS, NQ)
    return round_doubles(Q.quantile_transform(e, st, QCOLS, "normal"))


def _inverse_sql():
    fwd = f"({_transform_sql('normal', rounded=False)})"
    joins, sel = [], ["z.ID"]
    step = f"(1.0::DOUBLE / {NQ - 1})"
    for c in QCOLS:
        f = _fitted_sql(c)
        u = f"({norm_cdf_sql(f'z.{c}')})"
        j = f"least(greatest(CAST(floor({u} / {step}) AS BIGINT), 0), {NQ - 2})"
        joins.append(f"LEFT JOIN {f} a_{c} ON a_{c}.idx = {j} LEFT JOIN {f} b_{c} ON b_{c}.idx = {j} + 1")
        val = f"(CASE WHEN b_{c}.reference = a_{c}.reference THEN a_{c}.quantile ELSE a_{c}.quantile + ({u} - a_{c}.reference) * (b_{c}.quantile - a_{c}.quantile) / (b_{c}.reference - a_{c}.reference) END)"
        q0, qn = f"(SELECT min(quantile) FROM {f})", f"(SELECT max(quantile) FROM {f})"
        res = f"(CASE WHEN ({u} - 1e-07) < 0.0 THEN {q0} WHEN ({u} + 1e-07) > 1.0 THEN {qn} ELSE {val} END)"
        sel.append(f"round(CASE WHEN z.{c} IS NULL THEN NULL ELSE {res} END, 6) AS {c}")
    return f"SELECT {', '.join(sel)} FROM {fwd} z " + " ".join(joins)


@query("quantile_inverse", sql=_inverse_sql())
def q_quantile_inverse(spark, d):
    e = entity(spark, d, ["ID", *QCOLS])
    st, _ = Q.fit_quantiles(e, QCOLS, NQ)
    z = Q.quantile_transform(e, st, QCOLS, "normal")
    return round_doubles(Q.quantile_inverse(z, st, QCOLS, "normal"))
