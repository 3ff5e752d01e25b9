"""Edge inputs: NULL keys, unseen levels, one-row groups, empty histories, zero denominators,
constant columns, mode ties, colliding cleaned levels, non-ASCII text, bin edges."""

from pyspark.sql import functions as F

from foldwise.functions.history import history_date_gap, history_sum
from foldwise.functions.text import clean_category
from foldwise.operators import child as CH
from foldwise.operators import clean as C
from foldwise.operators import encode as E
from foldwise.operators import features as FT
from foldwise.operators import quantile as Q
from foldwise.operators import stats as S


def test_null_and_unseen_keys_get_prior(spark):
    train = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "b", 1), (4, None, 1)], "ID long, k string, y int")
    test = spark.createDataFrame([(10, "a"), (11, "zzz"), (12, None)], "ID long, k string")
    st = E.fit_beta(train, "y", {"k": "k"}, "ID", mode="expected", sample_size=1.0)
    out = {r["ID"]: r["k__M"] for r in E.beta_transform(test, st).collect()}
    prior = 3 / 4
    assert out[11] == prior and out[12] == prior
    assert abs(out[10] - (prior + 1) / (prior + 1 + (1 - prior) + 1)) < 1e-12


def test_one_row_group_std_is_zero(spark):
    child = spark.createDataFrame([(1, 5.0), (1, 7.0), (2, 3.0)], "ID long, x double")
    out = {r["ID"]: r for r in CH.child_summary(child, "ID", num_cols=["x"]).collect()}
    assert out[2]["x__std"] == 0.0 and out[2]["x__mean"] == 3.0


def test_empty_and_null_history(spark):
    df = spark.createDataFrame([(",,,",), (None,), ("1,,2.5",), ("x,3",)], "h string")
    assert [r[0] for r in df.select(history_sum(F.col("h"))).collect()] == [0.0, 0.0, 3.5, 3.0]


def test_history_date_gap_rules(spark):
    df = spark.createDataFrame(
        [("2020-03-01", "20200130,,abc"), ("2020-03-01", "1,2"), ("2020-03-01", None), ("2020-03-01", "2020013x")],
        "r string, h string",
    ).withColumn("r", F.to_timestamp("r"))
    got = [r[0] for r in df.select(history_date_gap(F.col("r"), F.col("h"))).collect()]
    assert abs(got[0] - 31 / 30) < 1e-12 and got[1] is None and got[2] == 0.0 and got[3] == 0.0


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(10.0, 5.0, 0.0)], "p double, u double, l double")
    r = df.select(*[c.alias(n) for n, c in FT.ratio_features(F.col("p"), F.col("u"), F.col("l")).items()]).first()
    assert r["premium_to_age2"] is None and r["age_dist"] is None and r["premium_to_age1"] == 2.0


def test_constant_column_scaler_and_quantiles(spark):
    df = spark.createDataFrame([(i, 3.0) for i in range(20)], "ID long, x double")
    params = Q.fit_standard(df, ["x"])
    assert params["x"] == (3.0, 1.0)
    st, _ = Q.fit_quantiles(df, ["x"], 10)
    out = Q.quantile_transform(df, st, ["x"], "uniform").select("x").distinct().collect()
    assert [r[0] for r in out] == [0.0]  # lower bound wins when both bounds hold


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert C.mode_value(df, "c") == "a"


def test_colliding_cleaned_levels_merge(spark):
    child = spark.createDataFrame([(1, "Credit Card"), (1, "Credit-Card"), (1, "Loan")], "ID long, t string")
    levels = CH.fit_child_levels(child, ["t"])
    assert levels == {"t": ["Credit_Card", "Loan"]}
    r = CH.child_summary(child, "ID", levels=levels).first()
    assert r["t__Credit_Card"] == 2 and r["t__Loan"] == 1


def test_non_ascii_cleaning(spark):
    df = spark.createDataFrame([("Zürich Straße-1",), ("日本 語",)], "t string")
    assert [r[0] for r in df.select(clean_category(F.col("t"))).collect()] == ["Zürich_Straße_1", "日本_語"]


def test_bin_edges_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (20.0,), (20.5,), (30.0,), (60.0,), (100.0,), (150.0,)], "x double")
    d = FT.bin_dummies(F.col("x"), "A", FT.AGE_EDGES)
    rows = df.select(*[c.alias(n) for n, c in d.items()]).collect()
    assert list(d) == ["A__2", "A__3", "A__4"]
    assert [tuple(r) for r in rows] == [(0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 1), (0, 0, 0), (0, 0, 0)]


def test_all_null_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b double")
    rows = {r["column"]: r for r in S.profile_missing(df).collect()}
    assert rows["b"]["n_missing"] == 2 and rows["b"]["share_missing"] == 1.0 and rows["a"]["n_missing"] == 0


def test_unseen_pair_key_frequency_zero(spark):
    train = spark.createDataFrame([("x", "y"), ("x", "y"), ("x", None)], "a string, b string")
    pairs, enc = E.fit_combine_frequency(train, ["a", "b"])
    test = spark.createDataFrame([("x", "y"), ("q", "q"), ("x", None)], "a string, b string")
    got = [r["a_b"] for r in E.combine_frequency(test, pairs, enc).collect()]
    assert sorted(got) == sorted([2 / 3, 0.0, 1 / 3])


def test_hot_key_child_summary_matches_brute_force(spark):
    """A third of the child rows belong to one entity: the one-pass summary still matches pandas,
    and the hot key reaches the reducer as pre-aggregated rows (one per map partition)."""
    from foldwise.plans.bindings import child
    from tests.conftest import SMALL

    ch = child(spark, SMALL).select("ID", "l_returnflag", "l_quantity", "l_extendedprice")
    ch = ch.withColumn("ID", F.when(F.col("l_extendedprice") < F.lit(30000.0), F.lit(0)).otherwise(F.col("ID")))
    levels = CH.fit_child_levels(ch, ["l_returnflag"])
    out = CH.child_summary(ch, "ID", levels=levels, num_cols=["l_quantity"]).toPandas().set_index("ID").sort_index()
    pdf = ch.toPandas()
    assert (pdf["ID"] == 0).mean() > 0.25
    g = pdf.groupby("ID")
    exp_mean = g["l_quantity"].mean()
    exp_std = g["l_quantity"].std().fillna(0.0)
    assert (abs(out["l_quantity__mean"] - exp_mean) < 1e-9).all()
    assert (abs(out["l_quantity__std"] - exp_std) < 1e-9).all()
    for lv in levels["l_returnflag"]:
        exp = pdf.assign(h=(pdf["l_returnflag"] == lv).astype(int)).groupby("ID")["h"].sum()
        assert (out[f"l_returnflag__{lv}"] == exp).all()
    plan = CH.child_summary(ch, "ID", levels=levels, num_cols=["l_quantity"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan  # map-side combine before the shuffle


def test_reference_fixed_values(spark):
    df = spark.createDataFrame([("Cheque",), ("ECS Reject",), ("Escrow",), ("Billed",), (None,)], "m string")
    got = [r[0] for r in df.select(C.recode(F.col("m"), C.PAYMENT_MODE_MAP)).collect()]
    assert got == ["PDC", "Reject", "Direct Debit", "Billed", None]
    dur = spark.createDataFrame([("14+",), ("3",), (None,), ("x",)], "d string")
    assert [r[0] for r in dur.select(C.recode_censored(F.col("d"))).collect()] == [15.0, 3.0, 0.0, 0.0]
