"""Scoring algebra (M11-M16), prediction sinks (S3, S4, S5, S7) and stacking joins.

Deterministic toy fold models stand in for trained ones so every step has oracle SQL:
fold model f scores class k with weight w_k + (f + k) % 3 (binary: p1 shifted by f / 101).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import blend as B
from foldwise.operators import encode as E
from foldwise.operators import metrics as M
from foldwise.operators.clean import mode_value
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.q_metrics import TOY_SQL, _auc_sql, _clip, toy
from foldwise.plans.q_split import FOLDS_SQL, K, folds
from foldwise.plans.registry import query

_Y, _M = "year(o_orderdate)", "month(o_orderdate)"
_W = [f"(2002 - {_Y})", f"({_Y} - 1994)", f"(3 + {_M} % 4)"]


def _w_cols():
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return [F.lit(2002) - y, y - F.lit(1994), F.lit(3) + m % 4]


def fold_model_probs(f: int):
    w = [(c + F.lit((f + k) % 3)).cast("double") for k, c in enumerate(_w_cols())]
    return B.normalise(F.array(*w), 3)


def _fold_probs_sql(f: int) -> list[str]:
    w = [f"CAST({c} + {(f + k) % 3} AS DOUBLE)" for k, c in enumerate(_W)]
    tot = "(" + " + ".join(w) + ")"
    return [f"({x} / {tot})" for x in w]


def _argmax_sql(p):
    return f"CASE WHEN {p[0]} >= {p[1]} AND {p[0]} >= {p[2]} THEN 0 WHEN {p[1]} >= {p[2]} THEN 1 ELSE 2 END"


def _fold_avg_sql():
    per = [_fold_probs_sql(f) for f in range(K)]
    s = ["(" + " + ".join(per[f][k] for f in range(K)) + ")" for k in range(3)]
    tot = "(" + " + ".join(s) + ")"
    return [f"({x} / {tot})" for x in s]


_FA = _fold_avg_sql()


def _fold_avg(spark, d):
    e = entity(spark, d, ["ID", "o_orderdate"])
    e = e.withColumns({f"fold{f}": fold_model_probs(f) for f in range(K)})
    return B.fold_average(e, [f"fold{f}" for f in range(K)], n_classes=3)


@query(
    "fold_average",
    sql=f"SELECT ID, {', '.join(f'round({p}, 6) AS p{k}' for k, p in enumerate(_FA))}, {_argmax_sql(_FA)} AS pred FROM {ENTITY_SQL}",
)
def q_fold_average(spark, d):
    out = _fold_avg(spark, d)
    return round_doubles(out.select("ID", *[F.col("probs")[k].alias(f"p{k}") for k in range(3)], "pred"))


_A = [f"(CAST({w} AS DOUBLE) / (" + " + ".join(f"CAST({x} AS DOUBLE)" for x in _W) + "))" for w in _W]
_B0 = _fold_probs_sql(0)
_MB = [f"(({a} + {b}) / 2.0)" for a, b in zip(_A, _B0)]


def _two_models(spark, d):
    e = entity(spark, d, ["ID", "o_orderdate"])
    return e.withColumns({"A": B.normalise(F.array(*[c.cast("double") for c in _w_cols()]), 3), "B": fold_model_probs(0)})


@query(
    "mean_blend",
    sql=f"SELECT ID, {', '.join(f'round({p}, 6) AS p{k}' for k, p in enumerate(_MB))}, {_argmax_sql(_MB)} AS pred FROM {ENTITY_SQL}",
)
def q_mean_blend(spark, d):
    out = B.mean_blend(_two_models(spark, d), ["A", "B"], n_classes=3)
    return round_doubles(out.select("ID", *[F.col("probs")[k].alias(f"p{k}") for k in range(3)], "pred"))


@query(
    "stage_probabilities",
    sql="SELECT ID, " + ", ".join(f"round({p}, 6) AS A{k}" for k, p in enumerate(_A)) + ", "
    + ", ".join(f"round({p}, 6) AS B{k}" for k, p in enumerate(_B0)) + f" FROM {ENTITY_SQL}",
)
def q_stage_probs(spark, d):
    out = B.side_by_side(_two_models(spark, d), {"A": "A", "B": "B"}, 3)
    return round_doubles(out.select("ID", *[f"{m}{k}" for m in "AB" for k in range(3)]))


_P1F = "CAST((2002 - year(o_orderdate)) * 12 - month(o_orderdate) + 12 + {f} AS DOUBLE) / 101.0::DOUBLE"


def _p1_fold(f):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return ((F.lit(2002) - y) * 12 - m + 12 + f).cast("double") / F.lit(101.0)


def _oof(spark, d):
    """Each row is scored by the model of its own fold. The toy fold models are expressions of
    the fold id, so all folds are scored in ONE pass (no per-fold scan + union); trained models
    use the per-fold union in ``models.train_oof`` over one cached frame."""
    fo = folds(spark, d).join(entity(spark, d, ["ID", "o_orderdate"]), "ID")
    p1 = _p1_fold(F.col("kfold"))
    return fo.select("ID", "kfold", "target", (1 - p1).alias("target_pred0"), p1.alias("target_pred1"))


_OOF_SQL = " UNION ALL ".join(
    f"SELECT f.ID, f.kfold, f.target, 1 - {_P1F.format(f=k)} AS target_pred0, {_P1F.format(f=k)} AS target_pred1 "
    f"FROM {FOLDS_SQL} f JOIN {ENTITY_SQL} e ON f.ID = e.ID WHERE f.kfold = {k}"
    for k in range(K)
)


@query("oof_predictions", sql=f"SELECT ID, kfold, target, round(target_pred0, 6) AS target_pred0, round(target_pred1, 6) AS target_pred1 FROM ({_OOF_SQL})")
def q_oof(spark, d):
    return round_doubles(_oof(spark, d))


_MB_P = "CAST(month(o_orderdate) AS DOUBLE) / 13.0::DOUBLE"


@query(
    "stacking_join",
    sql=f"""SELECT f.ID, f.kfold, f.target, round(a.target_pred1, 6) AS gbt_target_pred1, round({_MB_P}, 6) AS lr_target_pred1
  FROM {FOLDS_SQL} f LEFT JOIN ({_OOF_SQL}) a ON f.ID = a.ID AND f.kfold = a.kfold
  LEFT JOIN {ENTITY_SQL} e ON f.ID = e.ID""",
)
def q_stacking(spark, d):
    fo = folds(spark, d)
    gbt = _oof(spark, d).select("ID", "kfold", "target_pred1")
    lr = fo.join(entity(spark, d, ["ID", "o_orderdate"]), "ID").select(
        "ID", "kfold", (F.month("o_orderdate").cast("double") / F.lit(13.0)).alias("target_pred1"))
    return round_doubles(B.stacking_join(fo, {"gbt": gbt, "lr": lr}))


@query("submission", sql=f"SELECT ID, round(p1, 6) AS target FROM {TOY_SQL}")
def q_submission(spark, d):
    return round_doubles(B.submission_binary(toy(spark, d), "ID", "p1", "target"))


@query(
    "submission_multiclass",
    sql=f"SELECT ID, CASE {_argmax_sql(_FA)} WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus FROM {ENTITY_SQL}",
)
def q_submission_multi(spark, d):
    e = entity(spark, d)
    enc = E.fit_label_encoder(e, "o_orderstatus")  # the fitted target encoder decodes class ids
    avg = _fold_avg(spark, d)
    return E.label_decode(avg, "pred", enc, "o_orderstatus", "o_orderstatus").select("ID", "o_orderstatus")


_TRAIN = "o_orderdate < TIMESTAMP '1997-01-01'"


@query(
    "baseline_submission",
    sql=f"""SELECT ID, (SELECT o_orderstatus FROM {ENTITY_SQL} WHERE {_TRAIN} GROUP BY o_orderstatus ORDER BY count(*) DESC, o_orderstatus LIMIT 1) AS o_orderstatus
  FROM {ENTITY_SQL} WHERE NOT ({_TRAIN})""",
)
def q_baseline(spark, d):
    e = entity(spark, d)
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    majority = mode_value(e.where(cut), "o_orderstatus")
    return B.constant_submission(e.where(~cut), "ID", "o_orderstatus", majority)


@query(
    "metrics_report",
    sql=f"""SELECT 'accuracy' AS metric, round(avg(CAST(target = pred1 AS DOUBLE)), 6) AS value FROM {TOY_SQL}
  UNION ALL SELECT 'log_loss', round(avg(CASE WHEN target = 1 THEN -ln({_clip('p1')}) ELSE -ln(1 - {_clip('p1')}) END), 6) FROM {TOY_SQL}
  UNION ALL SELECT 'auc', round(auc, 6) FROM {_auc_sql(TOY_SQL, 'p1', 'target')}""",
)
def q_metrics_report(spark, d):
    t = toy(spark, d)
    acc = M.accuracy(t, "target", "pred1").select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    ll = M.log_loss_binary(t, "target", "p1").select(F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value"))
    auc = M.auc_binary(t, "p1", "target").select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return round_doubles(acc.unionByName(ll).unionByName(auc))


SCORE_FEATURES = {"n_name": "n_name", "c_mktsegment": "c_mktsegment"}


def fit_scorer(train):
    return E.fit_beta(train, "target", SCORE_FEATURES, "ID", n_samples=50, sample_size=0.8, seed=42, mode="expected")


def score_batch(batch, st):
    """Stateless scoring of a new batch: lookups are joined, the toy model averages encodings."""
    enc = E.beta_transform(batch, st, ("mean",))
    return enc.select("ID", ((F.col("n_name__M") + F.col("c_mktsegment__M")) / 2).alias("target"))


def _score_sql_clean():
    from foldwise.plans.q_encode import beta_sql

    inner = beta_sql(SCORE_FEATURES, ("mean",), train_where=_TRAIN, keep=("ID", "o_orderdate"), rounded=False)
    return f"SELECT ID, round((n_name__M + c_mktsegment__M) / 2, 6) AS target FROM ({inner}) WHERE NOT ({_TRAIN})"


@query("score_unseen", sql=_score_sql_clean())
def q_score_unseen(spark, d):
    e = entity(spark, d)
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    st = fit_scorer(e.where(cut))
    return round_doubles(score_batch(e.where(~cut), st))
