"""Values survive a lookup on either way; counts of folds and classes are not cut; edges of the metrics."""

import math

import pytest
from pyspark.sql import functions as F

from foldwise.operators import metrics
from foldwise.operators.encode import fit_dirichlet_by_fold
from foldwise.operators.lookup import BOUND_CONF, Lookup
from foldwise.session import checkpoint_dir

BIG = 9007199254740993


@pytest.mark.parametrize("arrow", ["true", "false"])
@pytest.mark.parametrize("bound", [None, "1"])
def test_lookup_keeps_values(spark, arrow, bound):
    rows = [("a", None, BIG), ("b", float("nan"), None), (None, 1.5, 2)]
    old = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
    if bound:
        spark.conf.set(BOUND_CONF, bound)
    try:
        lut = spark.createDataFrame(rows, "k string, x double, n long")
        whole, split = Lookup.fit(lut), Lookup.fit_split(lut.where("k is not null"), "k")
        got = {r["k"]: (r["x"], r["n"]) for r in whole.df.collect()}
        parts = {r["k"]: (r["x"], r["n"]) for lk in split.values() for r in lk.df.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", old)
        spark.conf.unset(BOUND_CONF)
    for own in (got, parts):
        assert own["a"] == (None, BIG) and math.isnan(own["b"][0]) and own["b"][1] is None
    assert got[None] == (1.5, 2) and whole.broadcastable == (bound is None)


def test_fold_priors_use_all_counts(spark, monkeypatch):
    from foldwise.operators import encode

    monkeypatch.setattr(encode, "MAX_LEVELS", 13)
    df = spark.range(1300).select((F.col("id") % 13).cast("int").alias("fold"), F.expr("id div 13 % 10").cast("int").alias("y"), F.lit("a").alias("c"))
    st = fit_dirichlet_by_fold(df, "y", {"c": "c"}, "fold")
    assert len(st.priors) == 13 and all(p[k] == pytest.approx(0.1) for p in st.priors.values() for k in range(10))


def test_metric_edges(spark):
    df = spark.createDataFrame([(1, 1), (0, None), (None, 1), (2, 2), (1, 7)], "y int, p int")
    assert metrics.accuracy(df, "y", "p").first()["accuracy"] == pytest.approx(0.5)
    cm = metrics.confusion_matrix(df, "y", "p", [0, 1])
    assert cm.agg(F.sum("count")).first()[0] == 5
    rep = {r["label"]: r for r in metrics.classification_report(cm, "y", "p").collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(0.5) and rep["accuracy"]["support"] == 4
    one = spark.createDataFrame([(0.5, 1), (0.7, 1)], "s double, y int")
    assert metrics.auc_binary(one, "s", "y").first()["auc"] is None
    assert {r["fpr"] for r in metrics.roc_curve(one, "s", "y").collect()} == {None}
    assert metrics.binary_prf(one.limit(0).withColumn("p", F.lit(1)), "y", "p").first()["accuracy"] is None


def test_cluster_needs_a_shared_folder(spark):
    class Bare:
        conf = spark.conf

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(Bare)
