"""Steps of the multi-class flows that must stay cheap at size."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from foldwise.functions.normal import norm_ppf, norm_ppf_at, ppf_point
from foldwise.functions.text import clean_category
from foldwise.operators import child as CH
from foldwise.operators import impute as I
from foldwise.operators import quantile as Q
from foldwise.session import stored


@pytest.mark.parametrize("output", ["normal", "uniform"])
def test_quantiles_of_many_columns_stay_compiled(spark, output):
    """The JVM does not compile methods of more than 8,000 bytes of code."""
    cols = [f"c{i}" for i in range(6)]
    df = spark.range(200).select("id", *[((F.col("id") * (i + 3)) % 31).cast("double").alias(c) for i, c in enumerate(cols)])
    st, _ = Q.fit_quantiles(df, cols, 20)
    out = Q.quantile_transform(df, st, cols, output)
    text = io.StringIO()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(text):
            out.select("*").explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
    assert out.columns == df.columns and out.count() == 200


def test_ppf_in_two_steps_is_the_same(spark):
    p = spark.range(1, 2000).select((F.col("id") / 2000).alias("p"))
    p = p.unionByName(spark.createDataFrame([(1e-9,), (0.02425,), (0.97575,), (1 - 1e-9,), (None,)], "p double"))
    got = p.select(norm_ppf(F.col("p")).alias("a"), norm_ppf_at(F.col("p"), ppf_point(F.col("p"))).alias("b"))
    assert got.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_plain_words_and_others_are_cleaned_alike(spark):
    words = [("a",), ("A_9",), ("",), (None,), ("x y",), ("Zürich-1",), ("--",), ("日本 語",), ("a\n",)]
    df = spark.createDataFrame(words, "t string")
    wrong = df.where(~clean_category(F.col("t")).eqNullSafe(F.regexp_replace("t", r"(?U)\W+", "_")))
    assert wrong.count() == 0
    levels = CH.fit_child_levels(df.withColumn("n", F.length("t")), ["t", "n"])
    assert levels == {"t": sorted({"a", "A_9", "", "x_y", "Zürich_1", "_", "日本_語", "a_"}), "n": sorted({"0", "1", "2", "3", "4", "8"})}


def test_stored_keeps_rows_and_names(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 2.5, None), (None, 0.0, "x")], "a long, `b c` double, A string")
    out = stored(df.toDF("a", "b c", "A;"))
    assert out.columns == ["a", "b c", "A;"] and sorted(map(repr, out.collect())) == sorted(map(repr, df.toDF("a", "b c", "A;").collect()))
    assert "ReadSchema: struct<c0:bigint>" in out.select("a")._jdf.queryExecution().toString()


def test_a_batch_is_read_once_by_all_forests(spark):
    rows = [(i, None if i % 5 == 0 else "ab"[i % 2], None if i % 7 == 0 else float(i % 4), float(i)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, m string, v double, w double")
    _, st = I.fit_transform_missforest(df, ["m"], ["v", "w"], num_trees=2, max_depth=3)
    out = I.transform_missforest(df, st, ["m"], ["v", "w"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    found = {r["id"]: r for r in out.collect()}
    assert len(found) == 80 and all(r["m"] in ("a", "b") and r["v"] is not None for r in found.values())
    assert all((m is None or found[i]["m"] == m) and (v is None or found[i]["v"] == v) for i, m, v, _ in rows)
