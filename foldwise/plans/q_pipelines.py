"""The two whole pipelines on the test tables: fitted on one part of the orders, saved, reloaded, applied to the rest; and
the multi-class predict path and two-level stacking. The SQL fits every step on the training rows alone."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foldwise.operators import encode as E
from foldwise.operators import features as FT
from foldwise.operators import models as ML
from foldwise.operators import pipelines as P
from foldwise.operators import split as SP
from foldwise.operators import stack as ST
from foldwise.plans import q_child, q_encode, q_quantile
from foldwise.plans.bindings import ENTITY_SQL, child, entity, round_doubles
from foldwise.plans.q_flows import _CUT
from foldwise.plans.q_models import FEATURES, model_frame
from foldwise.plans.registry import query
from foldwise.functions.history import history_sum
from foldwise.session import checkpoint_dir, stored
from foldwise.sources.state import load_state, save_state

NQ = q_quantile.NQ


def _cut():
    return F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")


def reloaded(spark, state):
    """The state as another session would find it in the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}"
    save_state(spark, state, path)
    return load_state(spark, path)


# ---- lead scoring ------------------------------------------------------------------------------

LEAD = P.LeadConfig(
    id_col="ID", target="target", categories=["region", "health", "holding"], mode_fill=["health"], constant_fill={"holding": "no_policy"},
    censored="months_held", beta={"region": "region"}, dummies=["health", "holding"], premium="premium", upper="upper_age", lower="lower_age",
    bins={"premium": FT.PREMIUM_EDGES, "lower_age": FT.AGE_EDGES, "upper_age": FT.AGE_EDGES},
    quantiles=["upper_age", "lower_age", "premium_to_age1", "premium_to_age2", "duration", "premium"], n_quantiles=NQ,
)

_LEAD_ROWS = f"""(SELECT ID, target, o_orderdate, n_name AS region, NULLIF(c_mktsegment, 'BUILDING') AS health, priority_m AS holding,
  CASE WHEN priority_m IS NULL THEN NULL WHEN month(o_orderdate) = 12 THEN '14+' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS months_held,
  CAST(18 + o_custkey % 58 AS DOUBLE) AS upper_age, CAST(18 + o_custkey % 58 - ID % 19 AS DOUBLE) AS lower_age, CAST(o_totalprice AS DOUBLE) / 4 AS premium
  FROM {ENTITY_SQL})"""


def _lead_rows(spark, d):
    e = entity(spark, d, ["ID", "target", "o_orderdate", "n_name", "c_mktsegment", "priority_m", "o_custkey", "o_totalprice"])
    age = F.lit(18) + F.col("o_custkey") % 58
    month = F.month("o_orderdate")
    return e.select(
        "ID", "target", "o_orderdate", F.col("n_name").alias("region"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("health"), F.col("priority_m").alias("holding"),
        F.when(F.col("priority_m").isNotNull(), F.when(month == 12, "14+").otherwise(month.cast("string"))).alias("months_held"),
        age.cast("double").alias("upper_age"), (age - F.col("ID") % 19).cast("double").alias("lower_age"), (F.col("o_totalprice").cast("double") / 4).alias("premium"),
    )


def _lead_sql():
    div = lambda a, b: f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"
    cats = ["region", "health", "holding"]
    pairs = [(a, b) for i, a in enumerate(cats) for b in cats[i + 1 :]]
    key = lambda t, a, b: f"concat_ws('_', coalesce({t}.{a}, 'nan'), coalesce({t}.{b}, 'nan'))"
    seen = ", ".join(f"CASE WHEN {c} IN (SELECT {c} FROM filled WHERE is_train) THEN {c} END AS {c}" for c in cats)
    ctes = [
        f"raw AS (SELECT *, {_CUT} AS is_train FROM {_LEAD_ROWS})",
        """filled AS (SELECT ID, target, is_train, region, coalesce(health, (SELECT health FROM raw WHERE is_train AND health IS NOT NULL GROUP BY health ORDER BY count(*) DESC, health LIMIT 1)) AS health,
          coalesce(holding, 'no_policy') AS holding, CASE WHEN months_held = '14+' THEN 15.0 ELSE coalesce(TRY_CAST(months_held AS DOUBLE), 0.0) END AS months_held, upper_age, lower_age, premium FROM raw)""",
        f"typed AS (SELECT ID, target, is_train, {seen}, months_held, upper_age, lower_age, premium, {div('premium', 'upper_age')} AS premium_to_age1, {div('premium', 'lower_age')} AS premium_to_age2, "
        f"upper_age - lower_age AS duration, {div('upper_age - lower_age', 'lower_age')} AS age_dist FROM filled)",
        "tr AS (SELECT * FROM typed WHERE is_train)", "s AS (SELECT count(*) AS n, avg(CAST(target AS DOUBLE)) AS p FROM tr)",
        "b AS (SELECT region, p + CAST(floor(n * 0.8) AS BIGINT) / n * sum(target) AS a, 1.0 - p + CAST(floor(n * 0.8) AS BIGINT) / n * sum(1 - target) AS b FROM tr, s GROUP BY region, n, p)",
    ]
    sel, joins = ["e.ID", "round(e.months_held, 6) AS months_held", "round(e.age_dist, 6) AS age_dist", "round(coalesce(b.a / (b.a + b.b), (SELECT p FROM s)), 6) AS region__M"], ["LEFT JOIN b ON e.region = b.region"]
    for a, b in pairs:
        ctes.append(f"p_{a}_{b} AS (SELECT {key('tr', a, b)} AS k, count(*) / (SELECT n FROM s) AS f FROM tr GROUP BY 1)")
        joins.append(f"LEFT JOIN p_{a}_{b} ON {key('e', a, b)} = p_{a}_{b}.k")
        sel.append(f"round(coalesce(p_{a}_{b}.f, 0.0), 6) AS {a}_{b}")
    for name, edges in LEAD.bins.items():
        sel += [f"CASE WHEN e.{name} > {edges[k]} AND e.{name} <= {edges[k + 1]} THEN 1 ELSE 0 END AS {name}__{k}" for k in range(2, len(edges) - 2)]
    levels = {"health": [x for x in q_encode.SEGMENT_LEVELS if x != "BUILDING"], "holding": [x for x in q_encode.PRIORITY_LEVELS if x != "4-NOT SPECIFIED"] + ["no_policy"]}
    for c, names in levels.items():
        sel += [f"CASE WHEN e.{c} = '{x}' THEN 1 ELSE 0 END AS \"{c}_{x}\"" for x in names[1:]]
    for c in LEAD.quantiles:
        dq2, expr = q_quantile._forward_sql(c, "normal", "tr")
        joins.append(f"ASOF LEFT JOIN {dq2} g_{c} ON e.{c} >= g_{c}.d")
        sel.append(f"round({expr}, 6) AS {c}")
    return f"WITH {', '.join(ctes)} SELECT {', '.join(sel)} FROM (SELECT * FROM typed WHERE NOT is_train) e {' '.join(joins)}"


@query("lead_pipeline_unseen", sql=_lead_sql())
def q_lead_unseen(spark, d):
    """All steps fitted on the training rows, the state saved and reloaded, an unseen batch transformed."""
    rows = _lead_rows(spark, d)
    state = reloaded(spark, P.fit_lead(rows.where(_cut()).drop("o_orderdate"), LEAD))
    return round_doubles(P.apply_lead(rows.where(~_cut()).drop("o_orderdate", "target"), state))


# ---- top-up timing -----------------------------------------------------------------------------

CHILD_Q = ["l_quantity__mean", "l_extendedprice__std", "amt_hist_sum__mean"]
TOPUP = P.TopupConfig(
    id_col="ID", target="o_orderpriority", recode={"mode": {"Cheque": "PDC", "Escrow": "Direct Debit"}}, log1p=["income"], start="disbursed", end="authorised",
    outliers=["amount", "income"], categories=["n_name", "c_mktsegment", "mode"], forest_categories=["mode"], forest_numbers=["balance"],
    dirichlet={"n_name": "n_name", "Place": ["n_name", "c_mktsegment"]}, dummies=["c_mktsegment"],
    loan={"emi": "emi", "income": "income", "tenure": "tenure", "disbursal": "amount", "asset": "asset", "finance": "finance"},
    quantiles=["amount", "Total_amount_to_pay", "Asset_to_total_income"], child_categories=q_child.CHILD_CATS, child_sums=["self_indicator"],
    child_numbers=q_child.SUMMARY_NUMS, child_quantiles=CHILD_Q, n_quantiles=NQ, child_n_quantiles=NQ, trees=5, depth=4,
)
_TOPUP_ROWS = f"""(SELECT ID, o_orderpriority, o_orderstatus, n_name, c_mktsegment, o_orderdate,
  CASE o_custkey % 4 WHEN 0 THEN 'Cheque' WHEN 1 THEN 'Escrow' WHEN 2 THEN 'Billed' END AS mode, CAST(acctbal_m AS DOUBLE) AS balance,
  CAST(o_totalprice AS DOUBLE) AS amount, CAST(o_totalprice AS DOUBLE) / 7 + o_custkey % 100 AS income, CAST(6 + ID % 30 AS DOUBLE) AS tenure,
  CAST(o_totalprice AS DOUBLE) / 20 AS emi, CAST(o_totalprice AS DOUBLE) * 1.25 AS asset, CAST(o_totalprice AS DOUBLE) * 1.1 AS finance,
  o_orderdate AS disbursed, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + to_days(CAST(o_custkey % 90 AS INTEGER)) END AS authorised FROM {ENTITY_SQL})"""


def _topup_rows(spark, d):
    e = entity(spark, d, ["ID", "o_orderpriority", "o_orderstatus", "n_name", "c_mktsegment", "o_orderdate", "o_custkey", "acctbal_m", "o_totalprice"])
    price, turn = F.col("o_totalprice").cast("double"), F.col("o_custkey") % 4
    later = F.col("o_orderdate") + F.make_dt_interval((F.col("o_custkey") % 90).cast("int"))
    return e.select(
        "ID", "o_orderpriority", "n_name", "c_mktsegment", "o_orderdate", F.when(turn == 0, "Cheque").when(turn == 1, "Escrow").when(turn == 2, "Billed").alias("mode"),
        F.col("acctbal_m").cast("double").alias("balance"), price.alias("amount"), (price / 7 + F.col("o_custkey") % 100).alias("income"), (F.lit(6) + F.col("ID") % 30).cast("double").alias("tenure"),
        (price / 20).alias("emi"), (price * 1.25).alias("asset"), (price * 1.1).alias("finance"), F.col("o_orderdate").alias("disbursed"),
        F.when(F.col("o_orderstatus") != "P", later).alias("authorised"),
    )


def _topup_sql():
    """What does not hang on the forests: all but the filled values of ``mode`` and ``balance``."""
    div = lambda a, b: f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"
    loan = {
        "monthly_surplus": "emi - income", "EMI_to_income_ratio": div("emi", "income"), "Total_amount_to_pay": "emi * tenure", "Total_income_within_loan": "income * tenure",
        "Interest_amount": "emi * tenure - amount", "Residual_amount": "income * tenure - emi * tenure", "Asset_to_total_income": div("asset", "income * tenure"),
        "Asset_to_monthly_income": div("asset", "income"), "pay_to_loan_ratio": div("emi * tenure", "amount"), "Finance_to_disbursed_ratio": div("amount", "finance"),
        "finance_leverage_money": "asset - finance", "finance_leverage_ratio": div("asset", "finance"), "processing_fees": "finance - amount",
    }
    bound = lambda c, side: q_quantile._bound(c, side, "(SELECT * FROM dated WHERE is_train)")
    ctes = [
        f"raw AS (SELECT *, {_CUT} AS is_train FROM {_TOPUP_ROWS})",
        "dated AS (SELECT * REPLACE (ln(1 + income) AS income, coalesce(authorised, TIMESTAMP '2020-12-31') AS authorised) FROM raw)",
        f"whole AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in loan.items())} FROM dated)", "tr AS (SELECT * FROM whole WHERE is_train)",
        f"cs AS ({q_child.SUMMARY_SQL.replace('round(', '(').replace(', 6)', ')')})",
        f"ctr AS (SELECT cs.* FROM cs JOIN tr ON cs.ID = tr.ID)",
        f"di AS ({q_encode.dirichlet_sql(TOPUP.dirichlet, ('mean',), n_classes=5, target='o_orderpriority', train_where=_CUT)})",
    ]
    sel = ["e.ID", "true AS whole"]
    sel += [f"CAST({f}(e.disbursed) {x} AS INTEGER) AS disbursed_{n}" for n, f, x in (("day", "dayofmonth", ""), ("weekday", "isodow", "- 1"), ("month", "month", ""), ("year", "year", ""))]
    sel.append("round((epoch_us(e.authorised) - epoch_us(e.disbursed)) / 2.592e12, 6) AS disbursed_months")
    sel += [f"CAST(coalesce(e.{c} < {bound(c, 'lo')} OR e.{c} > {bound(c, 'hi')}, false) AS INTEGER) AS {c}_outlier" for c in TOPUP.outliers]
    sel += [f"CASE WHEN e.c_mktsegment = '{x}' THEN 1 ELSE 0 END AS \"c_mktsegment_{x}\"" for x in q_encode.SEGMENT_LEVELS[1:]]
    plain = [c for c in ("income", "tenure", "emi", "asset", "finance", *loan) if c not in TOPUP.quantiles]
    sel += [f"round(e.{c}, 6) AS {c}" for c in plain]
    joins = ["LEFT JOIN di ON di.ID = e.ID", "LEFT JOIN cs ON cs.ID = e.ID"]
    for c in TOPUP.quantiles:
        dq2, expr = q_quantile._forward_sql(c, "normal", "tr")
        joins.append(f"ASOF LEFT JOIN {dq2} g_{c} ON e.{c} >= g_{c}.d")
        sel.append(f"round({expr}, 6) AS {c}")
    sel.append("di.* EXCLUDE (ID)")
    names = ["self_indicator", *[f"{c}__{v}" for c, vs in q_child.SQL_LEVELS.items() for v in vs], *[f"{c}__{s}" for c in q_child.SUMMARY_NUMS for s in ("mean", "std")]]
    for c in names:
        if c in CHILD_Q:
            dq2, expr = q_quantile._forward_sql(c, "normal", "ctr")
            joins.append(f"ASOF LEFT JOIN {dq2} g_{c} ON cs.{c} >= g_{c}.d")
            sel.append(f"round({expr.replace(f'e.{c}', f'cs.{c}')}, 6) AS {c}")
        else:
            sel.append(f"round(cs.{c}, 6) AS {c}" if "__" in c and c.rsplit("__", 1)[1] in ("mean", "std") else f"cs.{c}")
    return f"WITH {', '.join(ctes)} SELECT {', '.join(sel)} FROM (SELECT * FROM whole WHERE NOT is_train) e {' '.join(joins)}"


def _history(spark, d):
    return child(spark, d).withColumn("amt_hist_sum", history_sum(F.col("amt_hist")))


def _fit_topup(spark, d):
    rows, history = stored(_topup_rows(spark, d)), _history(spark, d)
    train = rows.where(_cut())
    own = history.join(train.select("ID"), "ID", "left_semi")
    levels, summary = P.fit_history(own, history, TOPUP)  # training and unseen rows share the history's table
    return rows, history, train, own, summary, P.fit_topup(train.drop("o_orderdate"), own, TOPUP, (levels, summary))


@query("topup_pipeline_unseen", sql=_topup_sql())
def q_topup_unseen(spark, d):
    rows, history, _, _, summary, state = _fit_topup(spark, d)
    state = reloaded(spark, state)
    unseen = rows.where(~_cut()).drop("o_orderdate", "o_orderpriority")
    out = P.apply_topup(unseen, history.join(unseen.select("ID"), "ID", "left_semi"), state, summary)
    return round_doubles(out.withColumn("whole", F.col("balance").isNotNull()).drop("balance"))


@query("multiclass_flow_submission")
def q_multiclass_submission(spark, d):
    """The multi-class predict path: the pipeline fitted and saved, a forest for each fold, the unseen batch transformed by the
    reloaded state, scored by all fold models in one scan, the class decoded to its label."""
    rows, history, train, own, summary, state = _fit_topup(spark, d)
    state = reloaded(spark, state)
    feats = stored(P.apply_topup(train.drop("o_orderdate"), own, state, summary))  # the folds' counts and the forests read it
    feats = SP.stratified_kfold(E.label_encode(feats, TOPUP.target, state.codes, out="y"), "y", "ID", 3, 42)
    cols = [c for c in feats.columns if c not in ("ID", TOPUP.target, "y", "kfold")]
    feats = feats.fillna(0.0, cols)
    _, fold_models = ML.train_oof(feats, "ID", cols, "y", "kfold", 3, "rf", {"numTrees": 10, "maxDepth": 5})
    unseen = rows.where(~_cut()).drop("o_orderdate", TOPUP.target)
    batch = P.apply_topup(unseen, history.join(unseen.select("ID"), "ID", "left_semi"), state, summary).fillna(0.0, cols)
    scored = ML.score_with_folds(batch, fold_models, cols, len(state.classes))
    return E.label_decode(scored, "pred", state.codes, TOPUP.target, TOPUP.target).select("ID", TOPUP.target)


# ---- two-level stacking ------------------------------------------------------------------------

STAGE1 = {"rf": ("rf", {"numTrees": 10, "maxDepth": 5}), "lr": ("logreg", {"maxIter": 20, "family": "multinomial"})}
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"


@query(
    "stack_oof",
    sql=f"""SELECT ID, CAST((row_number() OVER (ORDER BY y, u, ID) - 1) % 3 AS INTEGER) AS kfold, y, 1.0::DOUBLE AS prob_sum, true AS in_range
  FROM (SELECT ID, {_STATUS} AS y, {q_encode.uniform_sql('ID', seed=42)} AS u FROM {ENTITY_SQL})""",
)
def q_stack_oof(spark, d):
    """Stage 2 trained on stage 1's out-of-fold probabilities; of the result, what does not hang on the models."""
    frame = model_frame(spark, d, k=3, stratify="y")
    _, oof = ST.fit_stack(frame, "ID", FEATURES, "y", "kfold", 3, 3, STAGE1, ("logreg", {"maxIter": 20, "family": "multinomial"}))
    return _sums(oof.select("ID", "kfold", "y", "probs"))


def _sums(df):
    total = sum((F.col("probs")[i] for i in range(1, 3)), F.col("probs")[0])
    inside = F.forall("probs", lambda p: (p >= 0) & (p <= 1))
    return df.select(*[c for c in df.columns if c not in ("probs", "pred")], F.round(total, 6).alias("prob_sum"), inside.alias("in_range"))


@query("stack_predict", sql=f"SELECT ID, 1.0::DOUBLE AS prob_sum, true AS in_range, true AS known FROM {ENTITY_SQL} WHERE year(o_orderdate) >= 1997")
def q_stack_predict(spark, d):
    """Both stages fitted on the orders before 1997, saved, reloaded, and the later ones scored in one scan."""
    frame = model_frame(spark, d, k=3, stratify="y")
    train = SP.stratified_kfold(frame.where("od_year < 1997"), "y", "ID", 3, 42)
    state, _ = ST.fit_stack(train, "ID", FEATURES, "y", "kfold", 3, 3, STAGE1, ("logreg", {"maxIter": 20, "family": "multinomial"}))
    out = ST.predict_stack(frame.where("od_year >= 1997").select("ID", *FEATURES), reloaded(spark, state))
    return _sums(out.select("ID", "probs", F.col("pred").between(0, 2).alias("known")))
