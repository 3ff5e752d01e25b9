"""Metrics (V1-V11) on deterministic toy scores over the entity table.

A trained model is not needed to check metric definitions: the toy scores below are plain
integer date arithmetic (so both engines compute bit-identical values) with many ties, which
exercises the tie-aware AUC. Trained-model metrics use the same operators (q_models).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import blend as B
from foldwise.operators import metrics as M
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query
from foldwise.plans.q_split import FOLDS_SQL, folds

STATUS_CLASSES = ["F", "O", "P"]  # label-encoded 0, 1, 2 (sorted levels)


def toy(spark, d):
    e = entity(spark, d, ["ID", "target", "o_orderstatus", "o_orderdate"])
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    p1 = ((F.lit(2002) - y) * 12 - m + 12).cast("double") / F.lit(100.0)
    w = F.array(*[c.cast("double") for c in (F.lit(2002) - y, y - F.lit(1994), F.lit(3) + m % 4)])
    code = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    out = e.select("ID", "target", code.alias("y"), p1.alias("p1"), B.normalise(w, 3).alias("probs"))
    return out.withColumn("pred1", (F.col("p1") >= 0.5).cast("int")).withColumn("pred", B.argmax(F.col("probs")))


_W = ["(2002 - year(o_orderdate))", "(year(o_orderdate) - 1994)", "(3 + month(o_orderdate) % 4)"]
_WS = "(" + " + ".join(f"CAST({w} AS DOUBLE)" for w in _W) + ")"
_PK = [f"(CAST({w} AS DOUBLE) / {_WS})" for w in _W]
TOY_SQL = f"""(SELECT ID, target, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y,
  CAST((2002 - year(o_orderdate)) * 12 - month(o_orderdate) + 12 AS DOUBLE) / 100.0::DOUBLE AS p1,
  {_PK[0]} AS p0_, {_PK[1]} AS p1_, {_PK[2]} AS p2_,
  CAST(CAST((2002 - year(o_orderdate)) * 12 - month(o_orderdate) + 12 AS DOUBLE) / 100.0::DOUBLE >= 0.5 AS INTEGER) AS pred1,
  CASE WHEN {_PK[0]} >= {_PK[1]} AND {_PK[0]} >= {_PK[2]} THEN 0 WHEN {_PK[1]} >= {_PK[2]} THEN 1 ELSE 2 END AS pred
  FROM {ENTITY_SQL})"""


@query(
    "metric_accuracy",
    sql=f"SELECT round(avg(CAST(target = pred1 AS DOUBLE)), 6) AS accuracy, round(round(avg(CAST(target = pred1 AS DOUBLE)) * 100, 2), 6) AS accuracy_pct FROM {TOY_SQL}",
)
def q_accuracy(spark, d):
    return round_doubles(M.accuracy(toy(spark, d), "target", "pred1"))


def _clip(x):
    return f"least(greatest({x}, 1e-15), {1 - 1e-15!r})"


_MULTI_P = (
    f"(CASE y WHEN 0 THEN {_clip('p0_')} WHEN 1 THEN {_clip('p1_')} ELSE {_clip('p2_')} END) / "
    f"({_clip('p0_')} + {_clip('p1_')} + {_clip('p2_')})"
)


@query(
    "metric_log_loss",
    sql=f"""SELECT round(avg(CASE WHEN target = 1 THEN -ln({_clip('p1')}) ELSE -ln(1 - {_clip('p1')}) END), 6) AS log_loss_binary,
  round(avg(-ln({_MULTI_P})), 6) AS log_loss_multi FROM {TOY_SQL}""",
)
def q_log_loss(spark, d):
    t = toy(spark, d)
    return round_doubles(t.agg(
        F.avg(M.binary_loss("target", "p1")).alias("log_loss_binary"),
        F.avg(M.multi_loss("y", "probs")).alias("log_loss_multi"),
    ))


def _auc_sql(src, score, label, groups=()):
    g = ", ".join(groups)
    gsel = f"{g}, " if groups else ""
    part = f"PARTITION BY {g} " if groups else ""
    return f"""(WITH s AS (SELECT {gsel}{score} AS score, CAST(sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
     CAST(sum(CASE WHEN {label} = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM {src} GROUP BY {gsel}{score}),
  c AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
  SELECT {gsel}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc,
    CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c {('GROUP BY ' + g) if groups else ''})"""


@query("metric_auc", sql=f"SELECT round(auc, 6) AS auc, n_pos, n_neg FROM {_auc_sql(TOY_SQL, 'p1', 'target')}")
def q_auc(spark, d):
    return round_doubles(M.auc_binary(toy(spark, d), "p1", "target"))


_OVR_SRC = f"(SELECT y, k AS cls, CASE k WHEN 0 THEN p0_ WHEN 1 THEN p1_ ELSE p2_ END AS score, CAST(y = k AS INTEGER) AS yk FROM {TOY_SQL}, (SELECT unnest(range(3)) AS k))"


@query("metric_auc_ovr", sql=f"SELECT round(avg(auc), 6) AS auc_ovr FROM {_auc_sql(_OVR_SRC, 'score', 'yk', ('cls',))}")
def q_auc_ovr(spark, d):
    return round_doubles(M.auc_ovr(toy(spark, d), "y", "probs", 3))


_CM_SQL = f"""(SELECT a.k AS y, b.k AS pred, CAST(coalesce(c.n, 0) AS BIGINT) AS count
  FROM (SELECT unnest(range(3)) AS k) a, (SELECT unnest(range(3)) AS k) b
  LEFT JOIN (SELECT y, pred, count(*) AS n FROM {TOY_SQL} GROUP BY y, pred) c ON c.y = a.k AND c.pred = b.k)"""


def _cm(spark, d):
    return M.confusion_matrix(toy(spark, d), "y", "pred", [0, 1, 2])


@query("confusion_matrix", sql=f"SELECT CAST(y AS INTEGER) AS y, CAST(pred AS INTEGER) AS pred, count FROM {_CM_SQL}")
def q_cm(spark, d):
    cm = _cm(spark, d)
    return cm.select(F.col("y").cast("int"), F.col("pred").cast("int"), F.col("count").cast("bigint"))


_PER_CLASS = f"""(SELECT CAST(t.y AS VARCHAR) AS label,
    CASE WHEN p.n > 0 THEN t.tp / p.n ELSE 0.0 END AS precision, CASE WHEN s.n > 0 THEN t.tp / s.n ELSE 0.0 END AS recall,
    CAST(s.n AS BIGINT) AS support
  FROM (SELECT y, sum(count) AS tp FROM {_CM_SQL} WHERE y = pred GROUP BY y) t
  JOIN (SELECT pred, sum(count) AS n FROM {_CM_SQL} GROUP BY pred) p ON p.pred = t.y
  JOIN (SELECT y, sum(count) AS n FROM {_CM_SQL} GROUP BY y) s ON s.y = t.y)"""
_PER_F1 = f"(SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM {_PER_CLASS})"
_REPORT_SQL = f"""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, support, round(f1, 6) AS f1 FROM {_PER_F1}
  UNION ALL SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(sum(support) AS BIGINT), round(sum(recall * support) / sum(support), 6) FROM {_PER_F1}
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), CAST(sum(support) AS BIGINT), round(avg(f1), 6) FROM {_PER_F1}
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
    CAST(sum(support) AS BIGINT), round(sum(f1 * support) / sum(support), 6) FROM {_PER_F1}"""


@query("classification_report", sql=_REPORT_SQL)
def q_report(spark, d):
    return round_doubles(M.classification_report(_cm(spark, d), "y", "pred"))


@query("metric_macro_f1", sql=f"SELECT round(avg(f1), 6) AS macro_f1 FROM {_PER_F1}")
def q_macro_f1(spark, d):
    return round_doubles(M.macro_f1(_cm(spark, d), "y", "pred"))


@query(
    "roc_curve",
    sql=f"""WITH s AS (SELECT p1 AS score, sum(target) AS pos, sum(1 - target) AS neg FROM {TOY_SQL} GROUP BY p1),
  c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps FROM s)
  SELECT round(score, 6) AS threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps,
    round(tps / (SELECT sum(pos) FROM s), 6) AS tpr, round(fps / (SELECT sum(neg) FROM s), 6) AS fpr FROM c""",
)
def q_roc(spark, d):
    return round_doubles(M.roc_curve(toy(spark, d), "p1", "target"))


@query(
    "binary_prf",
    sql=f"""SELECT CAST(count_if(target = 0 AND pred1 = 0) AS BIGINT) AS tn, CAST(count_if(target = 0 AND pred1 = 1) AS BIGINT) AS fp,
  CAST(count_if(target = 1 AND pred1 = 0) AS BIGINT) AS fn, CAST(count_if(target = 1 AND pred1 = 1) AS BIGINT) AS tp,
  round(count_if(target = 1 AND pred1 = 1) / count_if(pred1 = 1), 6) AS precision,
  round(count_if(target = 1 AND pred1 = 1) / count_if(target = 1), 6) AS recall,
  round(count_if(target = pred1) / count(*), 6) AS accuracy FROM {TOY_SQL}""",
)
def q_prf(spark, d):
    return round_doubles(M.binary_prf(toy(spark, d), "target", "pred1"))


_FOLD_TOY = f"(SELECT t.*, f.kfold FROM {TOY_SQL} t JOIN {FOLDS_SQL} f ON t.ID = f.ID)"


@query(
    "metrics_by_fold",
    sql=f"""WITH a AS (SELECT kfold, avg(CAST(target = pred1 AS DOUBLE)) AS accuracy FROM {_FOLD_TOY} GROUP BY kfold),
  u AS {_auc_sql(_FOLD_TOY, 'p1', 'target', ('kfold',))},
  j AS (SELECT a.kfold, a.accuracy, u.auc FROM a JOIN u ON a.kfold = u.kfold)
  SELECT CAST(kfold AS INTEGER) AS kfold, round(accuracy, 6) AS accuracy, round(auc, 6) AS auc FROM j
  UNION ALL SELECT -1, round(avg(accuracy), 6), round(avg(auc), 6) FROM j""",
)
def q_by_fold(spark, d):
    t = toy(spark, d).join(folds(spark, d).select("ID", "kfold"), "ID")
    acc = M.accuracy(t, "target", "pred1", ["kfold"]).select("kfold", "accuracy")
    auc = M.grouped_auc(t, ["kfold"], "p1", "target").select("kfold", "auc")
    per = acc.join(auc, "kfold")
    mean = per.agg(F.lit(-1).alias("kfold"), F.avg("accuracy").alias("accuracy"), F.avg("auc").alias("auc"))
    return round_doubles(per.unionByName(mean).withColumn("kfold", F.col("kfold").cast("int")))
