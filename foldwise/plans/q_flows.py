"""End-to-end feature flows: the operators chained the way the reference's two projects chain them.

Binary flow (lead scoring): impute -> pair-category frequency -> Beta target encoding ->
one-hot -> quantile-to-normal (in place) -> stratified folds -> drop text columns.
Multi-class flow (loan timing): entity + one-pass child summary -> value recode -> date parts ->
outlier flags -> Dirichlet target encoding (single and composite keys) -> one-hot ->
quantile-to-normal -> stratified folds -> drop text columns.

The Spark side is one sequential plan per flow; the oracle SQL joins the per-step SQL that is
checked on its own elsewhere, keyed by ID.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.dates import date_parts
from foldwise.operators import clean as C
from foldwise.operators import encode as E
from foldwise.operators import models as ML
from foldwise.operators import quantile as Q
from foldwise.operators import split as SP
from foldwise.functions.history import history_sum
from foldwise.operators.child import attach, child_summary, fit_child_levels
from foldwise.plans import q_child, q_encode, q_quantile
from foldwise.plans.bindings import ENTITY_SQL, child, entity, round_doubles
from foldwise.plans.q_split import FOLDS_SQL
from foldwise.plans.registry import query
from foldwise.session import cut_lineage, stored

BIN_CATS = ["o_orderpriority", "c_mktsegment", "n_name", "priority_m"]
BETA = {"n_name": "n_name", "c_mktsegment": "c_mktsegment", "o_orderpriority": "o_orderpriority"}
ONE_HOT = ["o_orderpriority", "c_mktsegment"]
QCOLS = ["o_totalprice", "c_acctbal"]
FILLS = {"priority_m": "no_policy", "acctbal_m": 0.0}


def _drop_text(df, keep=("ID",)):
    return df.select(*[f.name for f in df.schema.fields if f.name in keep or not isinstance(f.dataType, T.StringType)])


@dataclass
class BinaryFlowState:
    """Everything the binary flow learned at fit time (small, bounded tables and lists)."""

    pairs: list
    freq: dict
    beta: E.BetaState
    levels: dict
    quantiles: Q.QuantileState


def fit_binary_flow(train):
    """Fit on training rows (ID, target, categories, acctbal_m, numerics)."""
    x = C.fill(train, FILLS)
    pairs, freq = E.fit_combine_frequency(x, BIN_CATS)
    beta = E.fit_beta(x, "target", BETA, "ID", n_samples=50, sample_size=0.8, seed=42, mode="expected")
    levels = E.collect_levels(x, ONE_HOT)
    qst, _ = Q.fit_quantiles(x, QCOLS, q_quantile.NQ)
    return BinaryFlowState(pairs, freq, beta, levels, qst)


def apply_binary_flow(df, st: BinaryFlowState):
    """Stateless per row given the fitted state: valid on a new batch or on a stream."""
    x = C.fill(df, FILLS)
    x = E.combine_frequency(x, st.pairs, st.freq)
    x = E.beta_transform(x, st.beta, ("mean",))
    x = E.one_hot(x, st.levels)
    return Q.quantile_transform(x, st.quantiles, QCOLS, "normal")


def binary_features(spark, d):
    e = entity(spark, d, ["ID", "target", *BIN_CATS, "acctbal_m", *QCOLS])
    x = C.fill(e, FILLS)
    pairs, freq = E.fit_combine_frequency(x, BIN_CATS)
    x = E.combine_frequency(x, pairs, freq)
    st = E.fit_beta(x, "target", BETA, "ID", n_samples=50, sample_size=0.8, seed=42, mode="expected")
    x = E.beta_transform(x, st, ("mean",))
    x = E.one_hot(x, E.collect_levels(x, ONE_HOT))
    x = cut_lineage(x)  # the encoded table is written once; the quantile fit jobs read it
    qst, _ = Q.fit_quantiles(x, QCOLS, q_quantile.NQ)
    x = Q.quantile_transform(x, qst, QCOLS, "normal")
    x = SP.stratified_kfold(x, "target", "ID", 5, 42)
    return _drop_text(x)


def _pair_sql():
    out = []
    for i, a in enumerate(BIN_CATS):
        for b in BIN_CATS[i + 1:]:
            key = f"concat_ws('_', coalesce(CAST({a} AS VARCHAR), 'nan'), coalesce(CAST({b} AS VARCHAR), 'nan'))"
            out.append(f"round(count(*) OVER (PARTITION BY {key}) / count(*) OVER (), 6) AS {a}_{b}")
    return ", ".join(out)


_BIN_SQL = f"""WITH imp AS (SELECT ID, target, o_orderpriority, c_mktsegment, n_name,
    coalesce(priority_m, 'no_policy') AS priority_m, round(coalesce(acctbal_m, 0.0), 6) AS acctbal_m FROM {ENTITY_SQL}),
  cf AS (SELECT ID, {_pair_sql()} FROM imp),
  be AS ({q_encode.beta_sql(BETA, ("mean",))}),
  oh AS (SELECT ID, {q_encode._onehot_sql('o_orderpriority', q_encode.PRIORITY_LEVELS)}, {q_encode._onehot_sql('c_mktsegment', q_encode.SEGMENT_LEVELS)} FROM {ENTITY_SQL}),
  qn AS ({q_quantile._transform_sql('normal')}),
  fo AS (SELECT ID, kfold FROM {FOLDS_SQL})
SELECT imp.ID, imp.target, imp.acctbal_m, cf.* EXCLUDE (ID), be.* EXCLUDE (ID), oh.* EXCLUDE (ID), qn.* EXCLUDE (ID), fo.kfold
FROM imp JOIN cf ON imp.ID = cf.ID JOIN be ON imp.ID = be.ID JOIN oh ON imp.ID = oh.ID JOIN qn ON imp.ID = qn.ID JOIN fo ON imp.ID = fo.ID"""


@query("binary_feature_table", sql=_BIN_SQL)
def q_binary_features(spark, d):
    return round_doubles(binary_features(spark, d))


@query("binary_oof_scores")
def q_binary_oof(spark, d):
    feats = binary_features(spark, d)
    cols = [c for c in feats.columns if c not in ("ID", "target", "kfold")]
    oof, _ = ML.train_oof(feats, "ID", cols, "target", "kfold", 5, "gbt",
                          {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}, early_stop=True)
    return oof.select("ID", "kfold", F.col("target").cast("int").alias("target"), F.col("probs")[1].alias("target_pred1"))


_CUT = "o_orderdate < TIMESTAMP '1997-01-01'"
_TRAIN_SRC = f"(SELECT * FROM {ENTITY_SQL} WHERE {_CUT})"


def _unseen_pair_sql():
    ctes, sel, joins = [], [], []
    for i, a in enumerate(BIN_CATS):
        for b in BIN_CATS[i + 1:]:
            key = lambda t: (f"concat_ws('_', coalesce(CAST({t}.{a} AS VARCHAR), 'nan'), "
                             f"coalesce(CAST({t}.{b} AS VARCHAR), 'nan'))")
            ctes.append(f"p_{a}_{b} AS (SELECT {key('tr')} AS k, count(*) / (SELECT count(*) FROM tr) AS f FROM tr GROUP BY 1)")
            joins.append(f"LEFT JOIN p_{a}_{b} ON {key('t')} = p_{a}_{b}.k")
            sel.append(f"round(coalesce(p_{a}_{b}.f, 0.0), 6) AS {a}_{b}")
    return ctes, sel, joins


def _unseen_sql():
    fill = "coalesce(priority_m, 'no_policy') AS priority_m, round(coalesce(acctbal_m, 0.0), 6) AS acctbal_m"
    pc, ps, pj = _unseen_pair_sql()
    beta = q_encode.beta_sql(BETA, ("mean",), train_where=_CUT, keep=("ID",))
    ctes = [
        f"tr AS (SELECT ID, o_orderpriority, c_mktsegment, n_name, coalesce(priority_m, 'no_policy') AS priority_m FROM {ENTITY_SQL} WHERE {_CUT})",
        f"t AS (SELECT ID, o_orderpriority, c_mktsegment, n_name, {fill} FROM {ENTITY_SQL} WHERE NOT ({_CUT}))",
        *pc,
        f"cf AS (SELECT t.ID, t.acctbal_m, {', '.join(ps)} FROM t {' '.join(pj)})",
        f"be AS ({beta})",
        f"oh AS (SELECT ID, {q_encode._onehot_sql('o_orderpriority', q_encode.PRIORITY_LEVELS)}, "
        f"{q_encode._onehot_sql('c_mktsegment', q_encode.SEGMENT_LEVELS)} FROM {ENTITY_SQL})",
        f"qn AS ({q_quantile._transform_sql('normal', fit_src=_TRAIN_SRC)})",
    ]
    return ("WITH " + ",\n".join(ctes) + "\nSELECT cf.*, be.* EXCLUDE (ID), oh.* EXCLUDE (ID), qn.* EXCLUDE (ID) "
            "FROM cf JOIN be ON cf.ID = be.ID JOIN oh ON cf.ID = oh.ID JOIN qn ON cf.ID = qn.ID")


@query("binary_flow_unseen", sql=_unseen_sql())
def q_binary_flow_unseen(spark, d):
    """Fit the binary flow on training rows, then transform an unseen batch with the saved state
    (the reference's predict path). The unseen rows carry no target."""
    e = entity(spark, d, ["ID", "target", *BIN_CATS, "acctbal_m", *QCOLS, "o_orderdate"])
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    st = fit_binary_flow(e.where(cut).drop("o_orderdate"))
    unseen = e.where(~cut).drop("o_orderdate", "target")
    return round_doubles(_drop_text(apply_binary_flow(unseen, st)))


# ---- multi-class flow -------------------------------------------------------------------------

RECODE = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "4-NOT SPECIFIED": "UNKNOWN"}
DIR = {"n_name": "n_name", "Place": ["n_name", "c_mktsegment"]}


def multiclass_features(spark, d):
    e = entity(spark, d, ["ID", "o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name", "o_orderdate", *QCOLS])
    own = e.columns
    e = e.withColumn("o_orderpriority", C.recode(F.col("o_orderpriority"), RECODE))
    e = stored(e.withColumns(date_parts(F.col("o_orderdate"), "o_orderdate")))  # no fit reads the summary: it is attached last
    # one exact-quantile sort gives both the transformer's quantiles and the outlier quartiles
    quartiles = {"probs": [0.25, 0.75]}
    qst, _ = Q.fit_quantiles(e, QCOLS, q_quantile.NQ, extra=quartiles)
    e = Q.outlier_flag(e, Q.outlier_bounds_from({k: v for k, v in quartiles.items() if k != "probs"}, QCOLS))
    enc = E.fit_label_encoder(e, "o_orderstatus")
    e = E.label_encode(e, "o_orderstatus", enc, out="y")
    st = E.fit_dirichlet(e, "y", DIR, "ID", n_samples=50, sample_size=0.8, seed=42, mode="expected")
    e = E.dirichlet_transform(e, st, ("mean",))
    e = E.one_hot(e, E.collect_levels(e, ["c_mktsegment", "o_orderpriority"]))
    e = Q.quantile_transform(e, qst, QCOLS, "normal")
    e = SP.stratified_kfold(e, "y", "ID", 3, 42)
    added = [c for c in e.columns if c not in own]
    history = q_child.summary(spark, d)
    e = attach(e, history, "ID").select(*own, *[c for c in history.columns if c != "ID"], *added)
    return _drop_text(e.drop("o_orderdate"))


_OUT = {c: (q_quantile._bound(c, "lo"), q_quantile._bound(c, "hi")) for c in QCOLS}
_RECODE_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RECODE.items()) + " ELSE o_orderpriority END"
_MC_LEVELS = ["3-MEDIUM", "5-LOW", "HIGH", "UNKNOWN"]
_MC_SQL = f"""WITH base AS (SELECT ID, o_orderstatus, c_mktsegment, {_RECODE_SQL} AS o_orderpriority, o_orderdate, o_totalprice, c_acctbal FROM {ENTITY_SQL}),
  cs AS ({q_child.SUMMARY_SQL}),
  fl AS (SELECT ID, CAST(dayofmonth(o_orderdate) AS INTEGER) AS o_orderdate_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_weekday,
    CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
    {", ".join(f"CAST(coalesce({c} < {lo} OR {c} > {hi}, false) AS INTEGER) AS {c}_outlier" for c, (lo, hi) in _OUT.items())},
    {q_encode._onehot_sql('c_mktsegment', q_encode.SEGMENT_LEVELS)}, {q_encode._onehot_sql('o_orderpriority', _MC_LEVELS)} FROM base),
  di AS ({q_encode.dirichlet_sql(DIR, ("mean",), n_classes=3, target="o_orderstatus")}),
  qn AS ({q_quantile._transform_sql('normal')}),
  fo AS (SELECT ID, y, CAST((row_number() OVER (ORDER BY y NULLS FIRST, u, ID) - 1) % 3 AS INTEGER) AS kfold
    FROM (SELECT ID, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS y, {q_encode.uniform_sql('ID', seed=42)} AS u FROM base))
SELECT fl.*, cs.* EXCLUDE (ID), di.* EXCLUDE (ID), qn.* EXCLUDE (ID), fo.y, fo.kfold
FROM fl LEFT JOIN cs ON fl.ID = cs.ID JOIN di ON fl.ID = di.ID JOIN qn ON fl.ID = qn.ID JOIN fo ON fl.ID = fo.ID"""


@dataclass
class MultiFlowState:
    child_levels: dict
    bounds: dict
    target_codes: object
    dirichlet: E.DirichletState
    levels: dict
    quantiles: Q.QuantileState


def _mc_base(x, child_summary_df):
    x = attach(x, child_summary_df, "ID")
    x = x.withColumn("o_orderpriority", C.recode(F.col("o_orderpriority"), RECODE))
    return x.withColumns(date_parts(F.col("o_orderdate"), "o_orderdate"))


def fit_multiclass_flow(train, train_child):
    """Fit on training entities and their child rows (entity columns as in the flow)."""
    levels = fit_child_levels(train_child, q_child.CHILD_CATS)
    x = cut_lineage(_mc_base(train, _child_summary(train_child, levels)))
    quartiles = {"probs": [0.25, 0.75]}  # taken from the same sort as the transformer's quantiles
    qst, _ = Q.fit_quantiles(x, QCOLS, q_quantile.NQ, extra=quartiles)
    bounds = Q.outlier_bounds_from({k: v for k, v in quartiles.items() if k != "probs"}, QCOLS)
    codes = E.fit_label_encoder(x, "o_orderstatus")
    x = E.label_encode(x, "o_orderstatus", codes, out="y")
    dst = E.fit_dirichlet(x, "y", DIR, "ID", n_samples=50, sample_size=0.8, seed=42, mode="expected")
    oh = E.collect_levels(x, ["c_mktsegment", "o_orderpriority"])
    return MultiFlowState(levels, bounds, codes, dst, oh, qst)


def apply_multiclass_flow(batch, batch_child, st: MultiFlowState):
    """Stateless given the fitted state: the new batch's own child rows are summarised with the
    fitted level list, then every fitted lookup / bound / quantile is applied."""
    x = _mc_base(batch, _child_summary(batch_child, st.child_levels))
    x = Q.outlier_flag(x, st.bounds)
    x = E.dirichlet_transform(x, st.dirichlet, ("mean",))
    x = E.one_hot(x, st.levels)
    return Q.quantile_transform(x, st.quantiles, QCOLS, "normal")


def _child_summary(ch, levels):
    ch = ch.withColumn("amt_hist_sum", history_sum(F.col("amt_hist")))
    return child_summary(ch, "ID", sum_cols=["self_indicator"], levels=levels, num_cols=q_child.SUMMARY_NUMS)


_MC_BASE_SQL = f"""(SELECT e.ID, e.c_mktsegment, {_RECODE_SQL.replace('o_orderpriority', 'e.o_orderpriority')} AS o_orderpriority,
  e.o_orderdate, e.o_totalprice, e.c_acctbal FROM {ENTITY_SQL} e WHERE NOT ({_CUT}))"""


def _mc_unseen_sql():
    out = {c: (q_quantile._bound(c, "lo", _TRAIN_SRC), q_quantile._bound(c, "hi", _TRAIN_SRC)) for c in QCOLS}
    di = q_encode.dirichlet_sql(DIR, ("mean",), n_classes=3, target="o_orderstatus", train_where=_CUT)
    return f"""WITH base AS {_MC_BASE_SQL},
  cs AS ({q_child.SUMMARY_SQL}),
  fl AS (SELECT ID, CAST(dayofmonth(o_orderdate) AS INTEGER) AS o_orderdate_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_weekday,
    CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
    {", ".join(f"CAST(coalesce({c} < {lo} OR {c} > {hi}, false) AS INTEGER) AS {c}_outlier" for c, (lo, hi) in out.items())},
    {q_encode._onehot_sql('c_mktsegment', q_encode.SEGMENT_LEVELS)}, {q_encode._onehot_sql('o_orderpriority', _MC_LEVELS)} FROM base),
  di AS ({di}),
  qn AS ({q_quantile._transform_sql('normal', fit_src=_TRAIN_SRC)})
SELECT fl.*, cs.* EXCLUDE (ID), di.* EXCLUDE (ID), qn.* EXCLUDE (ID)
FROM fl LEFT JOIN cs ON fl.ID = cs.ID JOIN di ON fl.ID = di.ID JOIN qn ON fl.ID = qn.ID"""


@query("multiclass_flow_unseen", sql=_mc_unseen_sql())
def q_multiclass_flow_unseen(spark, d):
    """Fit the multi-class flow on training entities (and their child rows), then transform an
    unseen batch of entities with their own child rows."""
    e = entity(spark, d, ["ID", "o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name", "o_orderdate", *QCOLS])
    ch = child(spark, d)
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    train, unseen = e.where(cut), e.where(~cut)
    st = fit_multiclass_flow(train, ch.join(train.select("ID"), "ID", "left_semi"))
    out = apply_multiclass_flow(unseen.drop("o_orderstatus"), ch.join(unseen.select("ID"), "ID", "left_semi"), st)
    return round_doubles(_drop_text(out.drop("o_orderdate")))


@query("multiclass_feature_table", sql=_MC_SQL)
def q_multiclass_features(spark, d):
    return round_doubles(multiclass_features(spark, d))


@query("binary_flow_submission")
def q_binary_flow_submission(spark, d):
    """The full predict path: fit the flow on training rows, train one GBT per fold on the
    training features, transform the unseen batch with the saved flow state and score it with
    all fold models in one scan; output (ID, P(target = 1))."""
    e = entity(spark, d, ["ID", "target", *BIN_CATS, "acctbal_m", *QCOLS, "o_orderdate"])
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    train = e.where(cut).drop("o_orderdate")
    st = fit_binary_flow(train)
    feats = _drop_text(SP.stratified_kfold(apply_binary_flow(train, st), "target", "ID", 5, 42))
    cols = [c for c in feats.columns if c not in ("ID", "target", "kfold")]
    _, fold_models = ML.train_oof(feats, "ID", cols, "target", "kfold", 5, "gbt",
                                  {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}, early_stop=True)
    unseen = _drop_text(apply_binary_flow(e.where(~cut).drop("o_orderdate", "target"), st))
    scored = ML.score_with_folds(unseen, fold_models, cols, n_classes=2)
    return scored.select("ID", F.col("probs")[1].alias("target"))
