"""Trained models and their products (rows-only checks) plus the MissForest fallback (oracle)."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldwise.functions.hashing import poisson_weight_sql, uniform_sql
from foldwise.operators import boost as BO
from foldwise.operators import encode as E
from foldwise.operators import forest as FO
from foldwise.operators import impute as I
from foldwise.operators import metrics as M
from foldwise.operators import models as ML
from foldwise.operators import search as SE
from foldwise.operators import split as SP
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query
from foldwise.sources.tables import table

FEATURES = ["o_totalprice", "c_acctbal", "od_year", "od_month", "od_dow", "seg_code", "prio_code"]
GBT_PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}


def model_frame(spark, d, k=5, stratify="target"):
    e = entity(spark, d, ["ID", "target", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "c_acctbal", "c_mktsegment"])
    code = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    e = e.withColumns({
        "od_year": F.year("o_orderdate"), "od_month": F.month("o_orderdate"), "od_dow": F.weekday("o_orderdate"),
        "y": code,
    })
    for c, out in [("c_mktsegment", "seg_code"), ("o_orderpriority", "prio_code")]:
        e = E.label_encode(e, c, E.fit_label_encoder(e, c), out=out)
    e = e.select("ID", "target", "y", *FEATURES)
    return SP.stratified_kfold(e, stratify, "ID", k, 42)


def _binary_oof(spark, d):
    mf = model_frame(spark, d)
    oof, models = ML.train_oof(mf, "ID", FEATURES, "target", "kfold", 5, "gbt", GBT_PARAMS, early_stop=True)
    return oof, models


@query("train_gbt_oof")
def q_gbt_oof(spark, d):
    oof, _ = _binary_oof(spark, d)
    return oof.select("ID", "kfold", F.col("target").cast("int").alias("target"),
                      F.col("probs")[0].alias("target_pred0"), F.col("probs")[1].alias("target_pred1"))


@query("train_multiclass_oof")
def q_multi_oof(spark, d):
    mf = model_frame(spark, d, k=3, stratify="y")
    oof = ML.train_ovr_gbt_oof(mf, "ID", FEATURES, "y", 3, "kfold", 3, {"maxIter": 10, "maxDepth": 4}, early_stop=True)
    return oof.select("ID", "kfold", "y", *[F.col("probs")[c].alias(f"y_pred{c}") for c in range(3)])


@query(
    "train_joint_oof",
    sql=f"""SELECT ID, CAST((row_number() OVER (ORDER BY y, u, ID) - 1) % 3 AS INTEGER) AS kfold, y, 1.0::DOUBLE AS prob_sum, true AS known
  FROM (SELECT ID, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y, {uniform_sql('ID', seed=42)} AS u FROM {ENTITY_SQL})""",
)
def q_joint_oof(spark, d):
    """All classes boosted together in each fold, stopped on the fold's macro F1; of the result, what does not hang on
    the trees."""
    mf = model_frame(spark, d, k=3, stratify="y").persist()
    mf.count()  # fills the cache once, before the folds run together

    def scored(fold: int):
        train, valid = SP.fold_split(mf, fold)
        state, _ = BO.fit_joint(train, valid, FEATURES, "y", 3, max_rounds=4, patience=2, depth=3)
        return BO.joint_probs(valid, state)

    with ThreadPool(3) as pool:
        parts = pool.map(scored, range(3), 1)
    total = F.round(F.col("probs")[0] + F.col("probs")[1] + F.col("probs")[2], 6)
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("ID", "kfold", "y", total.alias("prob_sum"), F.col("pred").between(0, 2).alias("known"))


@query("train_rf")
def q_rf(spark, d):
    mf = model_frame(spark, d, k=3, stratify="y")
    oof, _ = ML.train_oof(mf, "ID", FEATURES, "y", "kfold", 3, "rf", {"numTrees": 30, "maxDepth": 6})
    return oof.select("ID", "kfold", F.col("y").cast("int").alias("y"), *[F.col("probs")[c].alias(f"y_pred{c}") for c in range(3)])


@query("train_logreg")
def q_logreg(spark, d):
    mf = model_frame(spark, d, k=3, stratify="y")
    oof, _ = ML.train_oof(mf, "ID", FEATURES, "y", "kfold", 3, "logreg",
                          {"regParam": 0.01, "elasticNetParam": 0.0, "maxIter": 50, "family": "multinomial"})
    return oof.select("ID", "kfold", F.col("y").cast("int").alias("y"), *[F.col("probs")[c].alias(f"y_pred{c}") for c in range(3)])


@query("train_oof_metrics")
def q_oof_metrics(spark, d):
    """The reference's per-fold log: accuracy, AUC, log loss of the trained binary model per fold."""
    oof, _ = _binary_oof(spark, d)
    s = oof.withColumn("p1", F.col("probs")[1]).withColumn("pred1", (F.col("p1") >= 0.5).cast("int"))
    s = s.withColumn("target", F.col("target").cast("int"))
    acc = M.accuracy(s, "target", "pred1", ["kfold"])
    ll = M.log_loss_binary(s, "target", "p1", ["kfold"])
    auc = M.grouped_auc(s, ["kfold"], "p1", "target").select("kfold", "auc")
    return acc.join(ll, "kfold").join(auc, "kfold")


@query("random_search")
def q_random_search(spark, d):
    mf = model_frame(spark, d, k=3)
    space = [ML.Space("regParam", 1e-4, 1.0, log=True), ML.Space("elasticNetParam", 0.0, 1.0)]
    return ML.random_search(mf, "ID", FEATURES, "target", "kfold", 3, "logreg", space, n_trials=10, fixed={"maxIter": 30})


SEARCH_FAMILIES = {
    "logreg": [ML.Space("regParam", 1e-4, 1.0, log=True), ML.Space("elasticNetParam", 0.0, 1.0)],
    "rf": [ML.Space("maxDepth", 2, 6, integer=True), ML.Space("numTrees", 5, 20, integer=True), SE.Choice("impurity", ["gini", "entropy"])],
    "gbt": [ML.Space("maxDepth", 2, 4, integer=True), ML.Space("maxIter", 3, 10, integer=True), ML.Space("stepSize", 0.01, 0.3, log=True)],
}


@query(
    "guided_search",
    sql="""SELECT CAST(t AS INTEGER) AS trial, (SELECT count(*) FROM orders) AS n_scored, 3 AS n_folds, true AS mean_of_folds, true AS in_space
  FROM range(10) r(t)""",
)
def q_guided_search(spark, d):
    """Ten trials over three families; of the trial table, what does not hang on the models."""
    found = SE.search_models(model_frame(spark, d, k=3), "ID", FEATURES, "target", "kfold", 3, SEARCH_FAMILIES, n_trials=10,
                             fixed={"logreg": {"maxIter": 30}})
    mean = sum((F.col("scores")[f] for f in range(3)), F.lit(0.0)) / 3
    inside = F.lit(False)
    for family, dims in SEARCH_FAMILIES.items():
        ok = F.col("family") == family
        for s in dims:
            x = F.get_json_object("params", f"$.{s.name}")
            ok &= x.isin(s.options) if isinstance(s, SE.Choice) else x.cast("double").between(s.low, s.high)
        inside |= ok
    return found.select(
        "trial", (F.col("rows")[0] + F.col("rows")[1] + F.col("rows")[2]).alias("n_scored"), F.size("scores").alias("n_folds"),
        (F.abs(mean - F.col("score_mean")) < 1e-9).alias("mean_of_folds"), inside.alias("in_space"),
    )


BAGS = 10


@query(
    "forest_oob",
    sql=f"""SELECT ID, CAST({' + '.join(f"CAST({poisson_weight_sql(uniform_sql('ID', str(b), seed=42), 1.0)} = 0 AS INTEGER)" for b in range(BAGS))} AS INTEGER) AS out_trees,
  {' OR '.join(f"{poisson_weight_sql(uniform_sql('ID', str(b), seed=42), 1.0)} = 0" for b in range(BAGS))} AS predicted,
  3 AS n_classes FROM {ENTITY_SQL}""",
)
def q_forest_oob(spark, d):
    """Out-of-bag predictions of a forest over three classes: which trees never saw a row, and that those alone answer."""
    mf = ML.assemble(model_frame(spark, d, k=3, stratify="y"), FEATURES).select("ID", "y", "features").persist()
    state = FO.fit_bagged(mf, "ID", "features", "y", 3, bags=BAGS, max_depth=5)
    out = FO.oob_predictions(mf, state, "ID", "features")
    return out.select("ID", "out_trees", F.col("oob").isNotNull().alias("predicted"),
                      F.coalesce(F.size("oob"), F.lit(3)).alias("n_classes"))


@query("feature_importance")
def q_importance(spark, d):
    mf = model_frame(spark, d)
    model = ML.estimator("gbt", "target", GBT_PARAMS).fit(ML.assemble(mf, FEATURES))
    rows = ML.feature_importance(model, FEATURES)
    return spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, rank int")


@query("permutation_importance")
def q_permutation(spark, d):
    mf = model_frame(spark, d)
    # every feature reads the scored rows again; the fitted ones are not cached: the trees' row samples hang on their partitions
    train, valid = ML.assemble(mf, FEATURES).where("kfold != 0"), mf.where("kfold == 0").persist()
    model, pred = ML.fit_predict(train, ML.assemble(valid, FEATURES), "gbt", "target", GBT_PARAMS)
    base = M.auc_binary(pred.withColumn("p1", F.col("probs")[1]), "p1", "target").first()["auc"]

    def rescored(feat: str):
        perm = ML.permute_column(valid, "ID", feat)
        scored = model.transform(ML.assemble(perm, FEATURES)).withColumn("p1", vector_to_array("probability")[1])
        auc = M.auc_binary(scored, "p1", "target").first()["auc"]
        return feat, float(base), float(auc), float(base - auc)

    with ThreadPool(3) as pool:  # one re-score per feature: distributed jobs, a few at once
        rows = pool.map(rescored, FEATURES, 1)
    valid.unpersist()
    return spark.createDataFrame(rows, "feature string, auc_base double, auc_permuted double, importance double")


MF_CATS, MF_NUMS = ["priority_m"], ["acctbal_m"]


def _mf_frame(spark, d):
    e = entity(spark, d, ["ID", "priority_m", "acctbal_m", "o_totalprice", "o_orderdate"])
    return e.select("ID", "priority_m", "acctbal_m", "o_totalprice", F.year("o_orderdate").alias("od_year"))


@query("impute_missforest")
def q_missforest(spark, d):
    filled, _ = I.fit_transform_missforest(_mf_frame(spark, d), MF_CATS, MF_NUMS, extra=["o_totalprice", "od_year"],
                                           num_trees=20, max_depth=6)
    return filled.select("ID", "priority_m", "acctbal_m")


@query(
    "impute_missforest_wide",
    sql=f"SELECT ID, priority_m AS priority_observed, round(acctbal_m, 6) AS acctbal_observed, 2 AS n_present FROM {ENTITY_SQL}",
)
def q_missforest_wide(spark, d):
    """Predictors with 25 and 40 levels; of the result, what does not hang on the forests: the rows, the
    observed values (as they were) and that nothing is left NULL."""
    e = entity(spark, d, ["ID", "priority_m", "acctbal_m", "o_totalprice", "n_name", "o_custkey"])
    e = e.withColumns({"was_priority": F.col("priority_m").isNotNull(), "was_acctbal": F.col("acctbal_m").isNotNull(),
                       "cust_group": F.concat(F.lit("g"), (F.col("o_custkey") % 40).cast("string"))}).drop("o_custkey")
    out, _ = I.fit_transform_missforest(e, [*MF_CATS, "n_name", "cust_group"], MF_NUMS, extra=["o_totalprice"],
                                        num_trees=10, max_depth=5)
    return round_doubles(out.select(
        "ID", F.when(F.col("was_priority"), F.col("priority_m")).alias("priority_observed"),
        F.when(F.col("was_acctbal"), F.col("acctbal_m")).alias("acctbal_observed"),
        (F.col("priority_m").isNotNull().cast("int") + F.col("acctbal_m").isNotNull().cast("int")).alias("n_present"),
    ))


@query(
    "class_weights",
    sql="""SELECT o_orderkey, o_orderstatus,
  round(count(*) OVER () * 1.0 / ((SELECT count(DISTINCT o_orderstatus) FROM orders) * count(*) OVER (PARTITION BY o_orderstatus)), 6) AS weight
  FROM orders""",
)
def q_class_weights(spark, d):
    return round_doubles(ML.balanced_weights(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus"))


_TRAIN = "o_orderdate < TIMESTAMP '1997-01-01' AND c_acctbal >= 0 AND priority_m IS NOT NULL"


@query(
    "impute_missforest_fallback",
    sql=f"""SELECT ID, round(coalesce(acctbal_m, (SELECT avg(acctbal_m) FROM {ENTITY_SQL} WHERE {_TRAIN})), 6) AS acctbal_m,
  coalesce(priority_m, (SELECT priority_m FROM {ENTITY_SQL} WHERE {_TRAIN}
    GROUP BY priority_m ORDER BY count(*) DESC, priority_m LIMIT 1)) AS priority_m
  FROM {ENTITY_SQL} WHERE NOT (o_orderdate < TIMESTAMP '1997-01-01')""",
)
def q_missforest_fallback(spark, d):
    """Nothing was missing at fit, so there is no forest: a new batch gets the fitted mean and mode."""
    e = entity(spark, d, ["ID", "acctbal_m", "priority_m", "o_totalprice", "o_orderdate", "c_acctbal"])
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    train = e.where(cut & (F.col("c_acctbal") >= 0) & F.col("priority_m").isNotNull())
    train = train.select("ID", "acctbal_m", "priority_m", "o_totalprice")
    _, st = I.fit_transform_missforest(train, MF_CATS, MF_NUMS, extra=["o_totalprice"])
    test = e.where(~cut).select("ID", "acctbal_m", "priority_m")
    return round_doubles(I.transform_fallback(test, st, MF_CATS, MF_NUMS))
