"""Exact quantiles by bracket refinement, against numpy; missing values; the plan stays free of data-size sorts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import quantile as Q
from foldwise.operators import stats as S
from foldwise.operators.lookup import Lookup

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


def frames(rng):
    n = 6000
    return {
        "normal": rng.normal(size=n), "hot": np.where(rng.random(n) < 0.7, 5.0, rng.integers(0, 9, n)), "one": np.full(n, 3.25),
        "two": np.where(rng.random(n) < 0.3, -1.0, 2.0), "heavy": np.exp(rng.normal(0, 8, n)), "whole": rng.integers(-50, 50, n).astype(float),
    }


@pytest.mark.parametrize("rows", [1 << 20, 50])
def test_columns_equal_numpy_ranked_or_refined(spark, rows):
    cols = frames(np.random.default_rng(1))
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in cols.values()], strict=True)), ", ".join(f"{c} double" for c in cols))
    got = {(r["column"], r["prob"]): r["quantile"] for r in S.column_quantiles(df.repartition(5), list(cols), PROBS, rows=rows).collect()}
    assert len(got) == len(cols) * len(PROBS)
    for c, v in cols.items():
        for p in PROBS:
            assert got[c, p] == pytest.approx(np.quantile(v, p), rel=1e-12, abs=1e-300), (c, p)


@pytest.mark.parametrize("rows", [1 << 20, 40])
def test_groups_equal_numpy_with_a_hot_group_and_null_keys(spark, rows):
    rng = np.random.default_rng(2)
    data = [("hot", float(v)) for v in rng.normal(size=4000)] + [("same", 1.5)] * 500 + [(None, float(v)) for v in rng.integers(0, 4, 300)]
    data += [("few", 1.0), ("few", 4.0), ("gone", None), ("gone", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    got = {(r["k"], r["prob"]): r["quantile"] for r in S.grouped_quantiles(df, ["k"], "v", PROBS, rows=rows).collect()}
    want = {}
    for key in ("hot", "same", None, "few"):
        values = [v for k, v in data if k == key]
        want |= {(key, p): np.quantile(values, p) for p in PROBS}
    assert got.keys() == want.keys()
    for key, v in want.items():
        assert got[key] == pytest.approx(v, rel=1e-12), key


def test_many_quantiles_of_refined_columns(spark):
    v = np.random.default_rng(3).gamma(0.3, size=9000)
    probs = Q.references(500)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = {r["prob"]: r["quantile"] for r in S.column_quantiles(df, ["x"], probs, rows=100).collect()}
    assert [got[p] for p in probs] == pytest.approx(np.quantile(v, probs).tolist(), rel=1e-12)


def test_infinite_values_and_signed_zero(spark):
    inf = float("inf")
    v = [-inf, -1.0, -0.0, 0.0, 0.0, 2.0, inf, inf, inf]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    for rows in (1 << 20, 1):
        got = {r["prob"]: r["quantile"] for r in S.column_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.875, 1.0], rows=rows).collect()}
        assert got == {0.0: -inf, 0.25: 0.0, 0.5: 0.0, 0.875: inf, 1.0: inf}


def test_missing_values_and_empty_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1.0, None, nan), (2, nan, None, None), (3, 3.0, None, nan), (4, None, None, None), (5, 100.0, None, nan)], "id int, x double, none double, nans double")
    cols = ["x", "none", "nans"]
    st, fitted = Q.fit_quantiles(df, cols, 5)
    assert fitted.select("column").distinct().collect() == [("x",)]
    for output in ("uniform", "normal"):
        out = {r["id"]: r for r in Q.quantile_transform(df, st, cols, output).collect()}
        assert out[2]["x"] is None and out[4]["x"] is None and out[1]["x"] < out[3]["x"] < out[5]["x"]
        assert all(r["none"] is None for r in out.values()) and np.isnan(out[1]["nans"]) and out[2]["nans"] is None
    back = {r["id"]: r["x"] for r in Q.quantile_inverse(Q.quantile_transform(df, st, cols), st, cols).collect()}
    assert back[3] == pytest.approx(3.0) and back[2] is None
    bounds = Q.fit_outlier_bounds(df, cols)
    assert bounds["none"] == bounds["nans"] == (None, None)
    assert [r[0] for r in Q.outlier_flag(df, bounds | {"x": (0.0, 50.0)}).orderBy("id").select("x_outlier").collect()] == [0, 0, 0, 0, 1]
    assert Q.quantile_transform(df.select("id", "none"), st, ["none"]).count() == 5
    assert S.column_quantiles(df.limit(0), cols, [0.5]).count() == 0 and S.grouped_quantiles(df.limit(0), ["id"], "x", [0.5]).count() == 0


def test_no_data_size_checkpoint_or_sort(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr("foldwise.operators.lookup.cut_lineage", lambda df: written.append(df) or df)
    monkeypatch.setattr("foldwise.operators.ordering.cut_lineage", lambda df: written.append(df) or df)
    df = spark.range(20000).select(F.xxhash64("id").cast("double").alias("x"), (F.col("id") % 3).alias("k"))
    S.column_quantiles(df, ["x"], [0.25, 0.75], rows=500).collect()
    S.box_stats(df, ["k"], "x").collect()
    assert not written


def test_lookups_are_local_relations_bounded_by_rows_and_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k int, s string")
    small = Lookup.fit(df)
    assert small.broadcastable and "LocalTableScan" in small.df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("foldwise.lookup.maxLocalBytes", "10000")
    try:
        assert not Lookup.fit(df).broadcastable and Lookup.fit(df.select("k")).broadcastable
        parts = Lookup.fit_split(df.withColumn("f", F.when(F.col("k") < 3, "a").otherwise("b")), "f")
        assert parts["a"].broadcastable and not parts["b"].broadcastable and parts["b"].df.count() == 47
    finally:
        spark.conf.unset("foldwise.lookup.maxLocalBytes")
