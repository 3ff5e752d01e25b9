"""Folds and splits from hash buckets, level tables of any width, forests over wide categories."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators import clean as C
from foldwise.operators import impute as I
from foldwise.operators import models as ML
from foldwise.operators import split as SP
from foldwise.operators.lookup import BOUND_CONF


@pytest.fixture
def rows(spark):
    """A hot class, a NULL class, repeated and NULL ids, full copies, a map column."""
    data = [(i if i % 7 else None, "hot" if i % 3 else ["a", None][i % 2], i % 50) for i in range(600)]
    df = spark.createDataFrame([*data, *data[:40], (5, "a", 1), (5, "hot", 2)], "id long, label string, x int")
    return df.withColumn("m", F.create_map(F.lit("k"), F.col("x")))


def _all(df):
    return sorted(map(str, df.select("id", "label", "x", *[c for c in df.columns if c not in ("id", "label", "x", "m")]).collect()))


@pytest.mark.parametrize("strata", [[], ["label"]])
def test_ranks_are_whole_and_the_same_for_any_buckets_and_bound(spark, rows, strata):
    n = rows.count()
    got = SP.ranked(rows, strata, "id", seed=3)
    assert sorted(r["_r"] for r in got.collect()) == list(range(1, n + 1))
    assert all(1 <= r["_in"] <= r["_n"] for r in got.collect())
    assert _all(SP.ranked(rows, strata, "id", seed=3, buckets=1)) == _all(got)
    spark.conf.set(BOUND_CONF, "1")
    try:
        assert _all(SP.ranked(rows, strata, "id", seed=3, buckets=5)) == _all(got)
    finally:
        spark.conf.unset(BOUND_CONF)


def test_folds_keep_every_row_and_spread_every_class(rows):
    out = SP.stratified_kfold(rows, "label", "id", 5)
    assert out.columns == [*rows.columns, "kfold"]
    assert _all(out.drop("kfold")) == _all(rows)
    by = {}
    for r in out.groupBy("label", "kfold").count().collect():
        by.setdefault(r["label"], []).append(r["count"])
    assert set(by) == {"hot", "a", None}
    assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in by.values())


def test_hold_out_counts_the_null_class_too(rows):
    out = SP.train_test_split(rows, "id", 0.25, stratify="label")
    assert out.count() == rows.count()
    for r in out.groupBy("label").agg(F.sum("is_test").alias("t"), F.count("*").alias("n")).collect():
        assert r["t"] == -(-r["n"] // 4)
    assert SP.train_test_split(rows, "id", 0.25).agg(F.sum("is_test")).first()[0] == -(-rows.count() // 4)


def test_splits_of_an_empty_table(rows):
    none = rows.where("false")
    assert SP.kfold(none, "id", 5).count() == 0
    assert SP.train_test_split(none, "id", stratify="label").count() == 0


def test_permuted_column_has_the_same_values(rows):
    ids = rows.withColumn("id", F.monotonically_increasing_id())
    out = ML.permute_column(ids, "id", "x")
    assert sorted(r["x"] for r in out.collect()) == sorted(r["x"] for r in ids.collect())
    assert sorted(r["id"] for r in out.collect()) == sorted(r["id"] for r in ids.collect())
    assert out.columns and set(out.columns) == set(ids.columns)


def test_type_conversion_of_more_levels_than_a_list_would_hold(spark):
    wide = spark.range(12_000).select(F.concat(F.lit("v"), "id").alias("c"), F.lit(None).cast("string").alias("none"))
    levels = C.fit_levels(wide.where("c <> 'v7'"), ["c", "none"])
    out = C.type_conversion(wide, levels, category_cols=["c", "none"])
    assert out.columns == ["c", "none"]
    assert (out.count(), out.where("c is null").count(), out.where("none is not null").count()) == (12_000, 1, 0)


def test_dates_of_each_column(spark):
    df = spark.createDataFrame([(None, None)], "a timestamp_ntz, b date")
    got = C.fill_dates(df, {"a": "2019-05-01", "b": "2018-02-03"}).first()
    assert (str(got["a"].date()), str(got["b"])) == ("2019-05-01", "2018-02-03")


def test_forest_over_wide_and_unseen_categories(spark):
    base = spark.range(400).select(
        "id", F.concat(F.lit("c"), F.col("id") % 45).alias("city"),
        F.when(F.col("id") % 9 > 0, F.when(F.col("id") % 45 < 20, "low").otherwise("high")).alias("kind"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 45).cast("double")).alias("num"),
        F.lit(None).cast("double").alias("void"))
    out, st = I.fit_transform_missforest(base, ["city", "kind"], ["num", "void"], num_trees=5, max_depth=4)
    assert out.count() == 400 and st.order == ["num", "kind"]
    assert out.where("kind is null or num is null").count() == 0
    known = base.where("num is not null").join(out.select("id", F.col("num").alias("after")), "id")
    assert known.where("num <> after").count() == 0
    new = base.limit(5).withColumns({"city": F.lit("elsewhere"), "kind": F.lit(None).cast("string")})
    assert I.transform_missforest(new, st, ["city", "kind"], ["num", "void"]).where("kind is null").count() == 0


def test_class_weights_balance_and_pass_to_the_fit(spark):
    df = spark.createDataFrame([(i, None if i == 0 else float(i % 4 == 0), float(i), i % 2) for i in range(41)],
                               "id long, y double, x double, kfold int")
    w = ML.balanced_weights(df, "y")
    by = {r["y"]: r["s"] for r in w.groupBy("y").agg(F.sum("weight").alias("s")).collect()}
    assert by[None] is None and by[0.0] == pytest.approx(20) and by[1.0] == pytest.approx(20)
    oof, _ = ML.train_oof(w.where("y is not null"), "id", ["x"], "y", "kfold", 2, "logreg", {"weightCol": "weight", "maxIter": 5})
    assert oof.count() == 40
