"""Bagged forests: out-of-bag answers recounted tree by tree. Guided search: seeds, broken-off runs, a planted objective."""

import hashlib
import json
import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from foldwise.operators import forest as FO
from foldwise.operators import impute as I
from foldwise.operators import metrics as M
from foldwise.operators import models as ML
from foldwise.operators import search as SE
from foldwise.operators import trees as TR
from foldwise.operators.models import Space
from foldwise.sources.state import load_state, save_state


def rows(spark, n=400):
    u = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000.0
    df = spark.range(n).withColumns({"a": u(1), "b": u(2)})
    df = df.withColumn("y", F.when(F.col("a") + F.col("b") > 1.2, 2).when(F.col("a") > F.col("b"), 1).otherwise(0))
    df = df.withColumn("t", 3 * F.col("a") - F.col("b"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(df)


def in_bag(key, bag, seed):
    u = int(hashlib.md5(f"{key}|{bag}|{seed}".encode()).hexdigest()[:8], 16) / 2**32
    return u >= math.exp(-1)


@pytest.mark.parametrize(("label", "classes"), [("y", 3), ("t", 0)])
def test_out_of_bag_answers_equal_a_recount(spark, tmp_path, label, classes):
    df = rows(spark)
    state = FO.fit_bagged(df, "id", "x", label, classes, bags=6, max_depth=4, seed=5)
    want = {r["id"]: [] for r in df.collect()}
    for bag, tree in enumerate(state.trees):  # each tree by itself
        own = tree.copy().setFeaturesCol("x")
        for r in own.transform(df).collect():
            if not in_bag(r["id"], bag, 5):
                want[r["id"]].append(list(r["probability"]) if classes else r["prediction"])
    got = {r["id"]: r for r in FO.oob_predictions(df, state, "id", "x").collect()}
    assert len(got) == 400 and {len(w) for w in want.values()} >= {0, 1, 2, 3}
    hits, errors, values = [], [], []
    for key, answers in want.items():
        r = got[key]
        assert r["out_trees"] == len(answers)
        if not answers:
            assert r["oob"] is None
        elif classes:
            mean = [sum(x) / len(answers) for x in zip(*answers, strict=True)]
            assert r["oob"] == pytest.approx(mean)
            hits.append(r["oob"].index(max(r["oob"])) == r["y"])
        else:
            assert r["oob"] == pytest.approx(sum(answers) / len(answers))
            errors.append((r["t"] - sum(answers) / len(answers)) ** 2)
            values.append(r["t"])
    score = FO.oob_score(df, state, "id", "x", label)
    if classes:
        assert score == pytest.approx(sum(hits) / len(hits)) and score > 0.8
    else:
        mean = sum(values) / len(values)
        assert score == pytest.approx(1 - sum(errors) / sum((v - mean) ** 2 for v in values)) and score > 0.8
    save_state(spark, state, str(tmp_path / "forest"))
    again = FO.predict(df, load_state(spark, str(tmp_path / "forest")), "x").select("id", "pred")
    assert sorted(again.collect()) == sorted(FO.predict(df.repartition(5), state, "x").select("id", "pred").collect())


def test_bags_without_rows_labels_without_values(spark):
    df = rows(spark, 2)
    state = FO.fit_bagged(df, "id", "x", "y", 4, bags=8, max_depth=2)
    assert [t is None for t in state.trees] == [not any(in_bag(k, b, 42) for k in range(2)) for b in range(8)]
    twice = df.union(df).withColumn("id", F.when(F.col("id") == 1, F.col("id")))  # repeated rows, a null key
    out = FO.oob_predictions(twice, state, "id", "x").collect()
    assert len(out) == 4 and all(r["oob"] is None or len(r["oob"]) == 4 for r in out)
    gaps = rows(spark, 60).withColumn("t", F.when(F.col("id") < 20, None).when(F.col("id") < 30, float("nan")).otherwise(F.col("t")))
    some = FO.fit_bagged(gaps, "id", "x", "t", 0, bags=4, max_depth=2)
    assert math.isfinite(FO.oob_score(gaps, some, "id", "x", "t"))
    assert FO.predict(gaps, some, "x").where("pred IS NULL").count() == 0
    assert FO.oob_score(gaps.where("id < 30"), some, "id", "x", "t") is None
    assert FO.oob_predictions(gaps.limit(0), some, "id", "x").count() == 0
    with pytest.raises(ValueError):
        FO.fit_bagged(gaps.where("id < 30"), "id", "x", "t", 0)


def test_missforest_reports_out_of_bag_scores(spark, tmp_path):
    df = rows(spark).withColumn("c", F.concat(F.lit("c"), "y")).drop("x", "y")
    holes = df.withColumns({"t": F.when(F.col("id") % 7 != 0, F.col("t")), "c": F.when(F.col("id") % 5 != 0, F.col("c"))})
    filled, state = I.fit_transform_missforest(holes, ["c"], ["t"], ["a", "b"], num_trees=5, max_depth=5, oob_key="id")
    assert set(state.oob) == {"c", "t"} and all(0.7 < s <= 1 for s in state.oob.values())
    truth = {r["id"]: r for r in df.collect()}
    got = filled.collect()
    assert len(got) == 400 and all(r["c"] is not None and r["t"] is not None for r in got)
    assert sum(r["c"] == truth[r["id"]]["c"] for r in got if r["id"] % 5 == 0) / 80 > 0.7
    assert all(r["t"] == truth[r["id"]]["t"] for r in got if r["id"] % 7)
    save_state(spark, state, str(tmp_path / "mf"))
    assert load_state(spark, str(tmp_path / "mf")).oob == state.oob


FAMILIES = {"flat": [Space("p", 0.0, 1.0)], "bowl": [Space("p", 1e-3, 10.0, log=True), Space("q", 0, 20, integer=True), SE.Choice("r", ["u", "v", "w"])]}


def planted(family, params):
    """Best at bowl, p = 0.1, q = 14, r = w."""
    if family == "flat":
        return 3.0 + params["p"], [], []
    far = abs(math.log10(params["p"]) + 1) + abs(params["q"] - 14) / 5 + (params["r"] != "w")
    return far, [], []


def test_guided_trials_repeat_and_beat_random_draws(spark):
    def best(seed, startup):
        return min(t.objective for t in SE.guided_search(planted, FAMILIES, 60, seed, startup))

    first, again = (SE.guided_search(planted, FAMILIES, 30, 3) for _ in range(2))
    assert first == again and first != SE.guided_search(planted, FAMILIES, 30, 4)
    assert SE.guided_search(planted, FAMILIES, 30, 3, past=first[:12][::-1]) == first  # goes on where it broke off
    for t in first:
        assert set(t.params) == {d.name for d in FAMILIES[t.family]}
        if t.family == "bowl":
            assert 1e-3 <= t.params["p"] <= 10 and t.params["q"] in range(21) and t.params["r"] in "uvw"
    guided, drawn = ([best(s, startup) for s in range(12)] for startup in (5, 60))
    assert sum(guided) < 0.7 * sum(drawn)
    assert sum(g <= r for g, r in zip(guided, drawn, strict=True)) >= 9


def test_failed_trials_count_as_worst():
    def sometimes(family, params):
        value, *rest = planted(family, params)
        return (math.nan if family == "flat" else value), *rest

    trials = SE.guided_search(sometimes, FAMILIES, 40, 1)
    assert sum(t.family == "bowl" for t in trials[20:]) >= 15


def test_density_is_one_and_draws_follow_it():
    import numpy as np

    d = SE._Density([0.1, 0.12, 0.9])
    grid = (np.arange(20000) + 0.5) / 20000
    assert sum(math.exp(d.log(u)) for u in grid) / 20000 == pytest.approx(1, abs=1e-4)
    rng = np.random.default_rng(0)
    drawn = [d.draw(rng) for _ in range(20000)]
    low = sum(math.exp(d.log(u)) for u in grid if u < 0.3) / 20000
    assert 0 <= min(drawn) and max(drawn) <= 1 and sum(x < 0.3 for x in drawn) / 20000 == pytest.approx(low, abs=0.02)
    for s in (Space("a", 3, 3), Space("b", 1, 9, integer=True), Space("c", 0.01, 1, log=True)):
        assert all(s.low <= SE._value(s, u) <= s.high for u in (0.0, 0.4, 1.0)) and 0 <= SE._unit(s, s.high) <= 1


def test_models_of_several_families_are_searched_and_resumed(spark, tmp_path):
    df = rows(spark, 300).drop("x").withColumns({"k": (F.col("id") % 2).cast("int"), "two": (F.col("y") > 0).cast("int")})
    families = {"logreg": [Space("regParam", 1e-3, 1.0, log=True)], "rf": [Space("maxDepth", 1, 4, integer=True)]}
    fixed = {"rf": {"numTrees": 3}, "logreg": {"maxIter": 5}}
    run = lambda n, path=None: SE.search_models(df, "id", ["a", "b"], "two", "k", 2, families, n, 7, fixed=fixed, path=path, startup=2)
    whole = run(4).drop("seed").collect()
    path = str(tmp_path / "trials")
    run(2, path)
    assert spark.read.parquet(path).count() == 2
    assert [r[:3] for r in run(4, path).drop("seed").collect()] == [r[:3] for r in whole]
    assert spark.read.parquet(path).count() == 4
    assert all(sum(r["rows"]) == 300 and r["objective"] == -r["score_mean"] for r in whole)
    assert max(r["score_mean"] for r in whole) > 0.8
    three = SE.search_models(df, "id", ["a", "b"], "y", "k", 2, {"gbt": [Space("maxIter", 1, 3, integer=True)]}, 1, n_classes=3).collect()
    assert three[0]["score_mean"] > 0.6 and json.loads(three[0]["params"])["maxIter"] in (1, 2, 3)


def test_random_trials_run_together(spark):
    """The start's trials wait for each other here, so they must run at the same time; the table is that of one at a time."""
    import threading

    together = threading.Barrier(5, timeout=30)

    def waiting(family, params):
        if len(started) < 5:
            started.append(family)
            together.wait()
        return planted(family, params)

    started, seen = [], []
    found = SE.guided_search(waiting, FAMILIES, 12, 3, done=seen.append, at_once=5)
    assert found == seen == SE.guided_search(planted, FAMILIES, 12, 3)


def test_folds_are_fitted_together(spark, monkeypatch):
    import threading

    from foldwise.operators import models as ML

    together, plain = threading.Barrier(3, timeout=60), ML.fit_predict

    def waiting(*args):
        together.wait()
        return plain(*args)

    monkeypatch.setattr(ML, "fit_predict", waiting)
    df = rows(spark, 90).withColumnsRenamed({"x": "features"}).withColumns({"kfold": F.col("id") % 3, "b1": (F.col("a") > 0.5).cast("double")})
    out, models = ML._oof_of(df, "id", "b1", "kfold", 3, "logreg", {"maxIter": 5})
    assert len(models) == 3 and out.count() == 90


def test_all_bag_weights_at_once(spark):
    df = spark.range(50).withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    each = df.select(FO.bag_weights("id", 6, 5).alias("all"), F.array(*[FO.bag_weight("id", b, 5) for b in range(6)]).alias("one"),
                     F.array(*[FO._left_out("id", b, 5) for b in range(6)]).alias("out")).collect()
    assert all(r["all"] == r["one"] and r["out"] == [w == 0 for w in r["one"]] for r in each)


def _search_rows(spark, n=900):
    df = rows(spark, n).drop("x").withColumns({"k": (F.col("id") % 3).cast("int"), "c": F.pmod(F.xxhash64("id", F.lit(9)), F.lit(5)) / 1.0})
    noisy = F.col("a") + F.col("b") + (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(100)) / 100.0) > 1.5
    return ML._training_frame(df.withColumn("two", noisy.cast("int")), "id", ["a", "b", "c"], "two", "k", None).cache()


def _answers(oof):
    return sorted((r["k"], r["two"], round(r["probs"][1], 6)) for r in oof.collect() for _ in range(r["_rows"] if "_rows" in r else 1))


@pytest.mark.parametrize("params", [{"maxDepth": 3, "maxIter": 4, "stepSize": 0.3}, {"maxDepth": 1, "maxIter": 2}])
def test_boosted_trees_on_bins_equal_sparks(spark, monkeypatch, params):
    monkeypatch.setattr(TR, "BLOCK", 70)
    data = _search_rows(spark)
    bins = TR.binned(data, "two", "k", 3)
    want, models = ML._oof_of(data, "id", "two", "k", 3, "gbt", params)
    got, none = ML._oof_of(data, "id", "two", "k", 3, "gbt", params, bins=bins)
    assert len(models) == 3 and none == [] and _answers(got) == _answers(want)
    assert bins.blocks.count() >= 900 // 70


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_forests_on_bins_score_like_sparks(spark, monkeypatch, impurity):
    data = _search_rows(spark)
    bins = TR.binned(data, "two", "k", 3)
    params = {"maxDepth": 4, "numTrees": 15, "impurity": impurity}
    auc = lambda oof, rows=None: {r["k"]: (r["auc"], r["n_pos"], r["n_neg"]) for r in M.grouped_auc(oof.withColumn("p1", F.col("probs")[1]), ["k"], "p1", "two", rows).collect()}
    want, _ = ML._oof_of(data, "id", "two", "k", 3, "rf", params)
    got, _ = ML._oof_of(data, "id", "two", "k", 3, "rf", params, bins=bins)
    mine, sparks = auc(got, "_rows"), auc(want)
    assert all(mine[f][0] == pytest.approx(sparks[f][0], abs=0.03) and mine[f][1:] == sparks[f][1:] for f in range(3))
    monkeypatch.setattr(TR, "HISTOGRAM_BYTES", 1)  # one tree a job
    assert _answers(bins.oof("rf", params)) == _answers(got)
    for f in TR.BinnedRows._forests(bins, {**TR.USUAL["rf"], **params}):
        assert len({t.value.tobytes() for t in f}) > 10  # other bags, other trees


def test_one_split_is_the_best_one_of_the_bag():
    """A node's split by brute force over rows and bins, and siblings of the same class put together."""
    import numpy as np

    rng = np.random.default_rng(1)
    x, y, w = rng.integers(0, 6, (2, 300)), rng.integers(0, 2, 300), rng.poisson(1, 300)
    stats = np.zeros((1, 2, TR.BINS, 2))
    for j in range(2):
        np.add.at(stats[0, j], (x[j], y), w)
    feature, cut, gain, left, right = TR._best(stats, "gini", np.ones((1, 2), dtype=bool))
    gini = lambda on: 1 - sum((w[on & (y == c)].sum() / w[on].sum()) ** 2 for c in (0, 1))
    every = np.ones(300, dtype=bool)
    gains = {(j, b): gini(every) - sum(w[on].sum() / w.sum() * gini(on) for on in (x[j] <= b, x[j] > b)) for j in range(2) for b in range(5)}
    assert gain[0] == pytest.approx(max(gains.values())) and gains[feature[0], cut[0]] == pytest.approx(gain[0])
    assert left[0].sum() + right[0].sum() == w.sum()
    tree = TR.Tree(1)
    tree.cut[0] = 2
    TR._joined(tree, np.array([[4.0, 2.0], [3.0, 1.0], [1.0, 1.0]]))
    assert tree.cut[0] == TR.STAY and tree.value[0] == pytest.approx(1 / 3)


def test_search_fits_trees_of_all_folds_on_bins(spark, monkeypatch):
    """No trial of trees fits Spark's models; rows that bins cannot stand for, and parameters they do not know, go to Spark's."""
    fitted, plain = [], ML.fit_predict
    monkeypatch.setattr(ML, "fit_predict", lambda train, valid, kind, *rest: (fitted.append(kind), plain(train, valid, kind, *rest))[1])
    df = rows(spark, 240).drop("x").withColumns({"k": (F.col("id") % 3).cast("int"), "two": (F.col("y") > 0).cast("int")})
    families = {"gbt": [Space("maxIter", 1, 3, integer=True)], "rf": [Space("maxDepth", 1, 4, integer=True)]}
    run = lambda rows, fixed: SE.search_models(rows, "id", ["a", "b"], "two", "k", 3, families, 4, 7, fixed=fixed).collect()
    found = run(df, {"rf": {"numTrees": 4}})
    assert fitted == [] and all(sum(r["rows"]) == 240 and 0.6 < r["score_mean"] <= 1 for r in found)
    with pytest.raises(Exception, match="MUST NOT be NaN"):  # as Spark's
        run(df.withColumn("a", F.when(F.col("id") % 50 != 7, F.col("a"))), {"rf": {"numTrees": 4}})
    assert fitted == []
    run(df, {"gbt": {"subsamplingRate": 0.5}, "rf": {"numTrees": 4}})
    assert set(fitted) == {"gbt"}
    data = ML._training_frame(df, "id", ["a", "b"], "two", "k", None)
    assert TR.binned(data.withColumn("two", F.col("two") * 2.0), "two", "k", 3) is None and TR.binned(data.limit(0), "two", "k", 3) is None
    assert TR.binned(data.withColumn("two", F.when(F.col("id") > 3, F.col("two"))), "two", "k", 3) is None


def test_grouped_auc_of_ranges_nulls_and_counted_rows(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    some = [(g, float(s), int(y)) for g in ("a", "b") for s, y in zip(rng.integers(0, 40, 300) / 8, rng.integers(0, 2, 300), strict=True)]
    odd = [(None, 1.0, 1), (None, 2.0, 0), ("c", 1.0, None), ("c", None, 1), ("d", 0.0, 1), ("d", -0.0, 0), ("d", float("nan"), 1)]
    df = spark.createDataFrame(some + odd, "g string, s double, y int")
    want = {}
    for g in ("a", "b"):
        p, n = ([s for h, s, y in some if h == g and y == c] for c in (1, 0))
        want[g] = sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n)), len(p), len(n)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # ranges of many batches
    try:
        got = {r["g"]: (r["auc"], r["n_pos"], r["n_neg"]) for r in M.grouped_auc(df, ["g"], "s", "y").collect()}
        counted = df.groupBy("g", "s", "y").agg(F.count(F.lit(1)).alias("n"))
        assert got == {r["g"]: (r["auc"], r["n_pos"], r["n_neg"]) for r in M.grouped_auc(counted, ["g"], "s", "y", "n").collect()}
        assert M.grouped_auc(df.where("g < 'c'"), [], "s", "y").count() == 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {"a", "b", "c", "d"} and got["c"] == (None, 1, 0) and got["d"] == (0.75, 2, 1)
    assert all(got[g] == pytest.approx(want[g]) for g in want)
