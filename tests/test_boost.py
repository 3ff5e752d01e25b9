"""Joint boosting: the round it stops at equals a curve counted by hand; probabilities; odd input."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators import boost as BO
from foldwise.sources.state import load_state, save_state


def rows(spark, n=900):
    u = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000.0
    df = spark.range(n).withColumns({"a": u(1), "b": u(2), "noise": u(3)})
    y = F.when(F.col("a") + F.col("b") > 1.2, 2).when(F.col("a") > F.col("b"), 1).otherwise(0)
    return df.withColumn("y", F.when(F.col("noise") < 0.15, F.pmod(F.xxhash64("id"), F.lit(3)).cast("int")).otherwise(y))


def test_the_stop_equals_the_curve_of_every_round(spark, tmp_path):
    df = rows(spark)
    train, valid = df.where("id % 3 <> 0"), df.where("id % 3 = 0")
    state, curve = BO.fit_joint(train, valid, ["a", "b"], "y", 3, max_rounds=8, patience=2, depth=3)
    by_hand = []
    for r in range(1, len(state.rounds) + 1):  # each round's own model, scored and counted row by row
        own = BO.JointState(state.features, 3, state.start, state.step, state.rounds[:r])
        got = [(x["y"], x["pred"]) for x in BO.joint_probs(valid, own).select("y", "pred").collect()]
        f1 = []
        for c in range(3):
            tp = sum(y == c and p == c for y, p in got)
            fp, fn = sum(y != c and p == c for y, p in got), sum(y == c and p != c for y, p in got)
            f1.append(2 * tp / (2 * tp + fp + fn))
        by_hand.append(sum(f1) / 3)
    assert by_hand == pytest.approx(curve[: len(by_hand)])
    best = curve.index(max(curve))
    assert len(state.rounds) == best + 1 and len(curve) == min(8, best + 3) and max(curve) > 0.7
    out = BO.joint_probs(valid.withColumn("probs", F.lit("clash")).drop("probs"), state)
    assert all(abs(sum(r["probs"]) - 1) < 1e-9 and min(r["probs"]) >= 0 for r in out.collect())
    save_state(spark, state, str(tmp_path / "joint"))
    again = BO.joint_probs(valid, load_state(spark, str(tmp_path / "joint")))
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_missing_labels_classes_and_validation_rows(spark):
    df = rows(spark, 200).withColumn("y", F.when(F.col("id") % 10 == 0, None).when(F.col("y") < 2, F.col("y")))
    state, curve = BO.fit_joint(df, df.limit(0), ["a", "b"], "y", 3, max_rounds=2, depth=2)
    assert len(state.rounds) == 2 and curve == [0.0, 1.0]
    assert {r["pred"] for r in BO.joint_probs(df, state).select("pred").distinct().collect()} <= {0, 1}
    with pytest.raises(ValueError):
        BO.fit_joint(df.limit(0), df, ["a"], "y", 3)
    assert BO.macro_f1_of({(0, 0): 3, (1, 0): 1, (1, 1): 2}, 5) == pytest.approx((6 / 7 + 4 / 5) / 2)
