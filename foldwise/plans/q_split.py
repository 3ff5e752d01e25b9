"""Folds, splits, bootstrap draws and train/test union."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions.hashing import poisson_weight_sql, uniform_sql
from foldwise.operators import split as SP
from foldwise.plans.bindings import ENTITY_SQL, entity
from foldwise.plans.registry import query
from foldwise.sources.tables import table

SEED, K = 42, 5
_U = uniform_sql("ID", seed=SEED)
FOLDS_SQL = (
    f"(SELECT ID, target, CAST((row_number() OVER (ORDER BY target NULLS FIRST, u, ID) - 1) % {K} AS INTEGER) AS kfold "
    f"FROM (SELECT ID, target, {_U} AS u FROM {ENTITY_SQL}))"
)


def folds(spark, d):
    e = entity(spark, d, ["ID", "target"])
    return SP.stratified_kfold(e, "target", "ID", K, SEED)


@query("stratified_kfold", sql=f"SELECT * FROM {FOLDS_SQL}")
def q_skfold(spark, d):
    return folds(spark, d)


@query(
    "stratified_kfold_regression",
    sql=f"""WITH o AS (SELECT o_orderkey AS ID, o_totalprice AS y FROM orders),
  mm AS (SELECT min(y) AS lo, max(y) AS hi FROM o),
  b AS (SELECT ID, y, {_U} AS u, CASE """
    + " ".join(
        f"WHEN y > {'lo - (hi - lo) * 0.001' if i == 0 else f'lo + {i} * ((hi - lo) / {K})'} AND y <= "
        f"{'hi' if i == K - 1 else f'lo + {i + 1} * ((hi - lo) / {K})'} THEN {i}"
        for i in range(K)
    )
    + f""" END AS ybin FROM o, mm)
  SELECT ID, round(y, 6) AS y, CAST((row_number() OVER (ORDER BY ybin NULLS FIRST, u, ID) - 1) % {K} AS INTEGER) AS kfold FROM b""",
)
def q_skfold_reg(spark, d):
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("ID"), F.col("o_totalprice").alias("y"))
    out = SP.stratified_kfold_regression(raw, "y", "ID", K, SEED)
    return out.select("ID", F.round("y", 6).alias("y"), "kfold")


@query(
    "kfold",
    sql=f"SELECT ID, CAST((row_number() OVER (ORDER BY u, ID) - 1) % {K} AS INTEGER) AS kfold FROM (SELECT ID, {_U} AS u FROM {ENTITY_SQL})",
)
def q_kfold(spark, d):
    return SP.kfold(entity(spark, d, ["ID"]), "ID", K, SEED)


@query("fold_split", sql=f"SELECT ID, kfold, CASE WHEN kfold = 0 THEN 'valid' ELSE 'train' END AS split FROM {FOLDS_SQL}")
def q_fold_split(spark, d):
    f = folds(spark, d)
    train, valid = SP.fold_split(f, 0)
    return train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid"))).drop("target")


@query("filter_fold", sql=f"SELECT * FROM {FOLDS_SQL} WHERE kfold = 1")
def q_filter_fold(spark, d):
    return folds(spark, d).where("kfold == 1")


@query(
    "train_test_split",
    sql=f"""SELECT ID, target, CAST(row_number() OVER (PARTITION BY target ORDER BY u, ID) <= ceil(0.25 * count(*) OVER (PARTITION BY target)) AS INTEGER) AS is_test
  FROM (SELECT ID, target, {_U} AS u FROM {ENTITY_SQL})""",
)
def q_tts(spark, d):
    return SP.train_test_split(entity(spark, d, ["ID", "target"]), "ID", 0.25, SEED, stratify="target")


NB, FRAC = 50, 0.8


@query(
    "bootstrap_counts",
    sql=f"""WITH w AS (SELECT r AS replicate, {poisson_weight_sql(uniform_sql('ID', 'r', seed=SEED), FRAC)} AS weight
  FROM (SELECT ID FROM {ENTITY_SQL}), (SELECT unnest(range({NB})) AS r))
  SELECT CAST(replicate AS INTEGER) AS replicate, CAST(sum(weight) AS BIGINT) AS n_drawn, CAST(count_if(weight > 0) AS BIGINT) AS n_distinct
  FROM w GROUP BY replicate""",
)
def q_bootstrap(spark, d):
    w = SP.bootstrap_weights(entity(spark, d, ["ID"]), "ID", NB, FRAC, SEED)
    return w.groupBy("replicate").agg(
        F.sum("weight").cast("bigint").alias("n_drawn"), F.count_if(F.col("weight") > 0).alias("n_distinct")
    )


@query(
    "union_split",
    sql=f"""SELECT ID, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN target END AS target,
  CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'train' ELSE 'test' END AS part FROM {ENTITY_SQL}""",
)
def q_union_split(spark, d):
    e = entity(spark, d, ["ID", "target", "o_orderdate"])
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    train = e.where(cut).select("ID", "target")
    test = e.where(~cut).select("ID")
    _, tr, te = SP.union_split(train, test, "target")
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))
