"""Joint multi-class boosting with a macro-F1 stop.

All classes advance round by round on one softmax: a round fits one regression tree for each class to the difference
between its indicator and its probability, and adds the tree, shrunk, to the class's margin. After each round the argmax over
the classes is taken on the validation rows and their macro F1 is read from the confusion counts, a classes x classes
aggregate. Boosting stops when ``patience`` rounds bring nothing better, and the model is that of the best round (the first
of equal ones).

Margins stay beside the rows; they are written to the shared folder every ``CUT`` rounds, so that neither lineage nor plan
grows with the rounds. The driver holds trees and the confusion counts only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators import blend as B
from foldwise.operators.models import assemble
from foldwise.session import cut_lineage

CUT = 3


@dataclass
class JointState:
    features: list
    n_classes: int
    start: list  # a margin for each class: the log of its share
    step: float
    rounds: list  # of the best round and those before: a tree for each class


def macro_f1_of(counts: dict, n_classes: int) -> float:
    """Mean F1 of the classes that occur as label or prediction, from {(label, prediction): rows}."""
    scores = []
    for c in range(n_classes):
        hit = counts.get((c, c), 0)
        said = sum(n for (_, p), n in counts.items() if p == c)
        true = sum(n for (y, _), n in counts.items() if y == c)
        if said or true:
            scores.append(2 * hit / (said + true))
    return sum(scores) / len(scores) if scores else 0.0


def _softmax(margins: list[Column]) -> list[Column]:
    top = F.greatest(*margins)
    each = [F.exp(m - top) for m in margins]
    total = sum(each[1:], each[0])
    return [e / total for e in each]


def _advanced(df: DataFrame, trees: list, step: float) -> DataFrame:
    """Adds each class's tree to its margin ``_m{class}``."""
    for c, tree in enumerate(trees):
        own = tree.copy().setFeaturesCol("_x").setPredictionCol("_tree")
        df = own.transform(df).withColumn(f"_m{c}", F.col(f"_m{c}") + F.lit(step) * F.col("_tree")).drop("_tree")
    return df


def fit_joint(train: DataFrame, valid: DataFrame, features: list[str], label: str, n_classes: int, max_rounds: int = 100,
              patience: int = 20, step: float = 0.3, depth: int = 4, seed: int = 42) -> tuple[JointState, list[float]]:
    """The model of the best round, and the validation rows' macro F1 after each round that was run. Labels are
    0 .. ``n_classes`` - 1; rows with another or a missing label take no part. Without validation rows all rounds are run
    and kept."""
    names = [f"_m{c}" for c in range(n_classes)]
    y = F.col(label).cast("int")
    both = train.withColumn("_fit", F.lit(True)).unionByName(valid.withColumn("_fit", F.lit(False)))
    both = assemble(both.where(y.between(0, n_classes - 1)), features, "_x").select("_x", "_fit", y.alias("_y"))
    sizes = {r["_y"]: r["n"] for r in both.where("_fit").groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        raise ValueError("no training row has a label")
    start = [math.log((sizes.get(c, 0) + 1) / (total + n_classes)) for c in range(n_classes)]
    now = cut_lineage(both.withColumns({m: F.lit(v) for m, v in zip(names, start, strict=True)}))
    rounds, curve = [], []
    for r in range(max_rounds):
        probs = _softmax([F.col(m) for m in names])
        rows = now.where("_fit").select("_x", *[((F.col("_y") == c).cast("double") - p).alias(f"_r{c}") for c, p in enumerate(probs)]).persist()
        rows.count()  # fills the cache once, before the classes' trees grow together

        def grown(c: int):
            return DecisionTreeRegressor(featuresCol="_x", labelCol=f"_r{c}", maxDepth=depth, seed=seed + r).fit(rows)  # noqa: B023

        with ThreadPool(min(n_classes, 4)) as pool:
            trees = pool.map(grown, range(n_classes), 1)
        rows.unpersist()
        rounds.append(trees)
        now = _advanced(now, trees, step * n_classes)
        if (r + 1) % CUT == 0:
            now = cut_lineage(now)
        said = B.argmax(F.array(*[F.col(m) for m in names]))
        found = now.where(~F.col("_fit")).groupBy("_y", said.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # classes x classes
        curve.append(macro_f1_of({(x["_y"], x["p"]): x["n"] for x in found}, n_classes))
        if found and r - curve.index(max(curve)) >= patience:
            break
        if not found:
            curve[-1] = float(r)  # nothing to judge by: the last round counts
    best = curve.index(max(curve)) + 1 if curve else 0
    return JointState(list(features), n_classes, start, step * n_classes, rounds[:best]), curve


def joint_probs(df: DataFrame, st: JointState) -> DataFrame:
    """Adds ``probs`` and ``pred``. One scan; columns of ``df`` keep their names."""
    keep = [f"_in_{c}" for c in df.columns]
    named = df.toDF(*keep).withColumns({c: F.col(f"_in_{c}") for c in st.features})
    x = assemble(named, st.features, "_x").withColumns({f"_m{c}": F.lit(v) for c, v in enumerate(st.start)})
    for trees in st.rounds:
        x = _advanced(x, trees, st.step)
    probs = F.array(*_softmax([F.col(f"_m{c}") for c in range(st.n_classes)]))
    x = x.select(*[F.col(k).alias(c) for k, c in zip(keep, df.columns, strict=True)], probs.alias("probs"))
    return x.withColumn("pred", B.argmax(F.col("probs")))
