"""Saved state gives the same rows after a reload and half-written folders are refused; two-level stacking."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators import encode as E
from foldwise.operators import impute as I
from foldwise.operators import quantile as Q
from foldwise.operators import stack as S
from foldwise.operators.lookup import Lookup
from foldwise.sources.state import StateError, load_state, save_state


def rows(df):
    return sorted(map(str, df.collect()))


def small(spark):
    data = [(i, "ab"[i % 2], ["x", "y", None][i % 3], float(i % 7), i % 3, i % 2, i % 4) for i in range(60)]
    return spark.createDataFrame(data, "ID long, k string, m string, v double, y int, t int, kfold int")


def test_every_state_class_comes_back(spark, tmp_path):
    df = small(spark)
    feats = {"k": "k", "both": ["k", "m"]}
    beta, dirichlet = E.fit_beta(df, "t", feats, "ID"), E.fit_dirichlet(df, "y", feats, "ID")
    beta_fold, dirichlet_fold = E.fit_beta_by_fold(df, "t", feats, "kfold"), E.fit_dirichlet_by_fold(df, "y", feats, "kfold")
    quantiles, _ = Q.fit_quantiles(df, ["v"], 10)
    pairs, freq = E.fit_combine_frequency(df, ["k", "m"])
    _, forest = I.fit_transform_missforest(df, ["m"], ["v"], num_trees=3, max_depth=3)
    state = {"beta": beta, "dirichlet": dirichlet, "beta_fold": beta_fold, "dirichlet_fold": dirichlet_fold, "q": quantiles, "freq": (pairs, freq), "codes": E.fit_label_encoder(df, "k"), "forest": forest, "bounds": {"v": (None, float("inf"))}, 7: [1, 2.5, True]}
    path = str(tmp_path / "state")
    assert save_state(spark, state, path) == 1
    fresh = spark.newSession()
    got = load_state(fresh, path)
    df = fresh.createDataFrame(df.toPandas(), df.schema)
    assert rows(E.beta_transform(df, got["beta"])) == rows(E.beta_transform(small(spark), beta))
    assert rows(E.dirichlet_transform(df, got["dirichlet"])) == rows(E.dirichlet_transform(small(spark), dirichlet))
    assert rows(E.beta_transform_by_fold(df, got["beta_fold"])) == rows(E.beta_transform_by_fold(small(spark), beta_fold))
    assert rows(E.dirichlet_transform_by_fold(df, got["dirichlet_fold"])) == rows(E.dirichlet_transform_by_fold(small(spark), dirichlet_fold))
    assert rows(Q.quantile_transform(df, got["q"], ["v"])) == rows(Q.quantile_transform(small(spark), quantiles, ["v"]))
    assert rows(E.combine_frequency(df, *got["freq"])) == rows(E.combine_frequency(small(spark), pairs, freq))
    assert rows(E.label_encode(df, "k", got["codes"])) == rows(E.label_encode(small(spark), "k", state["codes"]))
    assert rows(I.transform_missforest(df, got["forest"], ["m"], ["v"])) == rows(I.transform_missforest(small(spark), forest, ["m"], ["v"]))
    assert got["bounds"] == state["bounds"] and got[7] == state[7]


def test_versions_and_half_written_folders(spark, tmp_path):
    path = str(tmp_path / "state")
    with pytest.raises(StateError):
        load_state(spark, path)
    first = Lookup.fit(spark.range(5))
    assert save_state(spark, first, path) == 1 and save_state(spark, Lookup.fit(spark.range(9)), path) == 2
    assert load_state(spark, path).df.count() == 9 and load_state(spark, path, 1).df.count() == 5
    with pytest.raises(TypeError):  # breaks off after its tables are written
        save_state(spark, [first, object()], path)
    assert load_state(spark, path).df.count() == 9
    assert save_state(spark, Lookup(spark.range(3).repartition(3), False), path) == 4  # 3 was begun
    assert not load_state(spark, path).broadcastable
    spark.range(2).toDF("c0").write.mode("overwrite").parquet(f"{path}/4/tables/1")  # as if a file were lost
    with pytest.raises(StateError):
        load_state(spark, path)
    half = str(tmp_path / "half")
    with pytest.raises(TypeError):
        save_state(spark, [first, object()], half)
    with pytest.raises(StateError):
        load_state(spark, half)


def test_only_states_of_the_package_are_built(spark, tmp_path):
    path = str(tmp_path / "state")
    spark.createDataFrame([('{"format": 1, "version": 1, "tables": [], "state": {"state": "subprocess:Popen", "fields": {}}}',)], "value string").coalesce(1).write.text(f"{path}/1/manifest")
    with pytest.raises(StateError):
        load_state(spark, path)


def stack_rows(spark, n=400):
    u = lambda salt: (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000.0)
    df = spark.range(n).withColumns({"a": u(1), "b": u(2), "kfold": (F.col("id") % 3).cast("int"), "noise": (u(3) > 0.5).cast("int")})
    return df.withColumn("y", ((F.col("a") > 0.5) != (F.col("b") > 0.5)).cast("int"))


STAGE1 = {"rf": ("rf", {"numTrees": 10, "maxDepth": 6}), "lr": ("logreg", {"maxIter": 10})}


def test_stage_two_learns_from_stage_one_and_survives_a_reload(spark, tmp_path):
    df = stack_rows(spark)
    state, oof = S.fit_stack(df, "id", ["a", "b"], "y", "kfold", 3, 2, STAGE1, ("logreg", {"maxIter": 20}), with_features=False)
    got = oof.select("id", "kfold", "y", (F.col("probs")[0] + F.col("probs")[1]).alias("s"), (F.col("probs")[1] > 0.5).cast("int").alias("p")).collect()
    assert len(got) == 400 and all(abs(r["s"] - 1) < 1e-9 and r["kfold"] == r["id"] % 3 for r in got)
    assert sum(r["p"] == r["y"] for r in got) > 340  # a line alone gets half right
    batch = df.select("id", "a", "b", F.lit("extra").alias("probability"))
    want = rows(S.predict_stack(batch, state).select("id", "probability", "probs", "pred"))
    save_state(spark, state, str(tmp_path / "stack"))
    assert rows(S.predict_stack(batch, load_state(spark, str(tmp_path / "stack"))).select("id", "probability", "probs", "pred")) == want
    with pytest.raises(ValueError):
        S.fit_stack(df.withColumn("rf0", F.lit(1)), "id", ["a"], "y", "kfold", 3, 2, STAGE1, ("logreg", {}))


def test_a_row_is_never_scored_by_a_model_that_saw_it(spark):
    deep = {"rf": ("rf", {"numTrees": 5, "maxDepth": 10})}
    _, oof = S.fit_stack(stack_rows(spark), "id", ["a", "b"], "noise", "kfold", 3, 2, deep, ("logreg", {"maxIter": 20}), with_features=False)
    right = oof.where((F.col("probs")[1] > 0.5).cast("int") == F.col("noise").cast("int")).count()
    assert 140 < right < 260  # memorised labels would give some 400
