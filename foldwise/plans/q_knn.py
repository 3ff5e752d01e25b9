"""kNN imputer (I8), kNN classifier (M6) and ADASYN (D10) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions.hashing import uniform, uniform_sql
from foldwise.operators import knn
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query
from foldwise.sources.tables import table

KCOLS, K = ["price", "balance", "months"], 5

_KNN_ROWS_SQL = f"""(SELECT ID, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS DOUBLE) / 1000 END AS price,
  CAST(acctbal_m AS DOUBLE) / 100 AS balance, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 30.0::DOUBLE AS months FROM {ENTITY_SQL})"""


def _knn_rows(spark, d):
    """Two of three features carry NULLs, so there are four patterns of present columns."""
    e = entity(spark, d, ["ID", "o_orderstatus", "o_totalprice", "o_orderdate", "acctbal_m"])
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    return e.select(
        "ID", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("double") / 1000).alias("price"),
        (F.col("acctbal_m").cast("double") / 100).alias("balance"), (days / F.lit(30.0)).alias("months"),
    )


def _impute_sql():
    square = " + ".join(f"CASE WHEN q.{c} IS NULL OR d.{c} IS NULL THEN 0.0 ELSE (q.{c} - d.{c}) * (q.{c} - d.{c}) END" for c in KCOLS)
    common = " + ".join(f"CASE WHEN q.{c} IS NULL OR d.{c} IS NULL THEN 0 ELSE 1 END" for c in KCOLS)
    fills = [
        f"""f_{t} AS (SELECT ID, CASE WHEN count(*) FILTER (s = 0) > 0 THEN avg(v) FILTER (s = 0) ELSE sum(v / sqrt(s)) / sum(1 / sqrt(s)) END AS v FROM (
  SELECT *, row_number() OVER (PARTITION BY ID ORDER BY s, donor) AS r FROM (
    SELECT q.ID, d.ID AS donor, d.{t} AS v, ({square}) * {len(KCOLS)} / ({common}) AS s
    FROM e q JOIN e d ON q.{t} IS NULL AND d.{t} IS NOT NULL AND ({common}) > 0)) WHERE r <= {K} GROUP BY ID)"""
        for t in KCOLS
    ]
    joins = " ".join(f"LEFT JOIN f_{t} ON f_{t}.ID = e.ID" for t in KCOLS)
    out = ", ".join(f"round(coalesce(e.{t}, f_{t}.v, (SELECT avg({t}) FROM e)), 8) AS {t}" for t in KCOLS)
    return f"WITH e AS {_KNN_ROWS_SQL}, {', '.join(fills)} SELECT e.ID, {out} FROM e {joins}"


@query("impute_knn", sql=_impute_sql())
def q_impute_knn(spark, d):
    return round_doubles(knn.impute_knn(_knn_rows(spark, d), "ID", KCOLS, k=K), 8)


_POINTS_SQL = f"(SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS VARCHAR) AS label, CAST(floor({uniform_sql('vec_id')} * 5) AS INTEGER) AS fold FROM embeddings)"
_VOTES_SQL = f"""WITH p AS {_POINTS_SQL}, n AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY far, donor) AS r FROM (
    SELECT q.id, d.id AS donor, d.label, list_distance(q.x, d.x) AS far FROM p q JOIN p d ON {{candidates}})
), w AS (SELECT id, label, sum({{weight}}) AS w FROM n WHERE r <= {{k}} GROUP BY id, label),
v AS (SELECT id, label, w / sum(w) OVER (PARTITION BY id) AS votes FROM w)
SELECT id, label, round(votes, 6) AS votes, first(label) OVER (PARTITION BY id ORDER BY votes DESC, label) AS predicted FROM v"""


def _points(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label", F.floor(uniform("vec_id") * 5).cast("int").alias("fold"))


@query("knn_classify", sql=_VOTES_SQL.format(candidates="q.fold <> d.fold", weight="1", k=10))
def q_knn_classify(spark, d):
    rows = _points(spark, d)
    return round_doubles(knn.knn_classify(rows, rows, "id", F.col("embedding").cast("array<double>"), "label", k=10, fold="fold"))


@query("knn_classify_weighted", sql=_VOTES_SQL.format(candidates="q.id <> d.id", weight="1 / far", k=5))
def q_knn_classify_weighted(spark, d):
    rows = _points(spark, d)
    return round_doubles(knn.knn_classify(rows, rows, "id", F.col("embedding").cast("array<double>"), "label", k=5, weight="distance"))


_HARDNESS_SQL = f"""p AS {_POINTS_SQL}, n AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY far, donor) AS r FROM (
    SELECT q.id, q.label, d.id AS donor, d.label AS other, list_distance(q.x, d.x) AS far FROM p q JOIN p d ON q.id <> d.id)
), h AS (SELECT id, label, CAST(count(*) FILTER (r <= {K} AND other <> label) AS INTEGER) AS n_other FROM n GROUP BY id, label),
c AS (SELECT label, count(*) AS n, sum(n_other) AS s, max(count(*)) OVER () - count(*) AS wanted FROM h GROUP BY label),
s AS (SELECT h.*, wanted, CASE WHEN c.s > 0 THEN n_other / c.s ELSE 1.0 / c.n END AS share FROM h JOIN c USING (label)),
f AS (SELECT *, share * wanted AS exact, floor(share * wanted + 1e-9) AS base FROM s),
g AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(greatest(exact - base, 0), 9) DESC, id) AS place, wanted - sum(base) OVER (PARTITION BY label) AS spare FROM f),
hardness AS (SELECT id, label, n_other, share, CAST(base + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS n_new FROM g)"""


def _targets(rows) -> dict[str, int]:
    """As many rows of each label as the most frequent one has."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy(F.col("label").cast("string").alias("label")).count().collect() if r["label"] is not None}
    return dict.fromkeys(sizes, max(sizes.values(), default=0))


@query("adasyn_hardness", sql=f"WITH {_HARDNESS_SQL} SELECT id, label, n_other, round(share, 6) AS share, n_new FROM hardness")
def q_adasyn_hardness(spark, d):
    rows = _points(spark, d)
    return round_doubles(knn.adasyn_hardness(rows, "id", F.col("embedding").cast("array<double>"), "label", _targets(rows), K))


@query(
    "oversample_adasyn",
    sql=f"""WITH {_HARDNESS_SQL}, m AS (
  SELECT id, donor, row_number() OVER (PARTITION BY id ORDER BY far, donor) AS r FROM n WHERE label = other
), k AS (SELECT id, list(donor ORDER BY r) AS near FROM m WHERE r <= {K} GROUP BY id),
y AS (SELECT id, label, unnest(range(n_new)) AS copy FROM hardness WHERE n_new > 0),
z AS (SELECT y.id, CAST(copy AS INTEGER) AS copy, label, near[CAST(floor({uniform_sql('y.id', 'copy', seed=42)} * len(near)) AS INTEGER) + 1] AS toward,
  {uniform_sql('y.id', 'copy', seed=43)} AS step FROM y JOIN k ON k.id = y.id)
SELECT z.id, z.copy, z.label, z.toward, round(step, 6) AS step, round(a.x[1] + (b.x[1] - a.x[1]) * step, 6) AS first,
  round(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] + (b.x[i] - a.x[i]) * step)), 6) AS total
FROM z JOIN p a ON a.id = z.id JOIN p b ON b.id = z.toward""",
)
def q_oversample_adasyn(spark, d):
    rows = _points(spark, d)
    made = knn.oversample_adasyn(rows, "id", F.col("embedding").cast("array<double>"), "label", _targets(rows), K)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return round_doubles(made.select("id", "copy", "label", "toward", "step", F.col("x")[0].alias("first"), total.alias("total")))
