"""Bagged trees whose left-out rows are known: out-of-bag predictions and scores.

How often a row is in the bag of a tree is a Poisson(1) draw from a hash of (row key, tree, seed), so any later
scan knows which trees never saw a row, whatever the partitioning and after a lost executor. Each tree is one Spark ML fit
on the rows of its bag, weighted by their counts. The driver loops over trees only, a few at once. Predictions of all
trees are chained in one scan.

Rows of one key share their bags; a NULL key counts as the empty text. Rows without a label, or with a NaN one, train nothing
and have no part in a score, but get predictions. A row that is in every bag has a NULL out-of-bag prediction. A bag
without rows (tiny tables) has no tree; without any labelled row ``fit_bagged`` raises ``ValueError``.
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.hashing import poisson_thresholds, poisson_weight, uniform


@dataclass
class BaggedForest:
    trees: list  # a Spark ML model for each bag, None for a bag without rows
    seed: int
    n_classes: int  # 0: regression


def _draw(key: str, bag: int, seed: int) -> Column:
    return uniform(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(bag), seed=seed)


def bag_weight(key: str, bag: int, seed: int = 42) -> Column:
    """How often the row is in the bag."""
    return poisson_weight(_draw(key, bag, seed), 1.0)


def bag_weights(key: str, bags: int, seed: int = 42) -> Column:
    """The weights of all bags; each draw is hashed once, however many thresholds it is held against."""
    return F.transform(F.array(*[_draw(key, b, seed) for b in range(bags)]), lambda u: poisson_weight(u, 1.0).cast("tinyint"))


def _left_out(key: str, bag: int, seed: int) -> Column:
    """Whether the row's weight is 0."""
    return _draw(key, bag, seed) < F.lit(poisson_thresholds(1.0)[0])


def _labelled(label: str) -> Column:
    y = F.col(label).cast("double")
    return y.isNotNull() & ~F.isnan(y)


def fit_bagged(df: DataFrame, key: str, features: str, label: str, n_classes: int = 0, bags: int = 20, max_depth: int = 8,
               seed: int = 42, at_once: int = 4) -> BaggedForest:
    """One tree for each bag over the vector column ``features``. ``n_classes``: labels are 0 to n_classes - 1 and each
    split looks at the square root of the features; 0 is regression over all features."""
    # a bag may lack the last class: the number of classes goes with the column
    known = {"metadata": {"ml_attr": {"type": "nominal", "num_vals": n_classes}}} if n_classes else {}
    y = F.col(label).cast("double").alias("_y", **known)
    data = df.where(_labelled(label)).select(F.col(features).alias("_v"), y, bag_weights(key, bags, seed).alias("_bags")).persist(StorageLevel.MEMORY_AND_DISK)
    filled = data.agg(*[F.count_if(F.col("_bags")[b] > 0).alias(f"b{b}") for b in range(bags)]).first()
    if not any(filled):
        data.unpersist()
        raise ValueError("no labelled row is in any bag")

    def grown(bag: int):
        if not filled[bag]:
            return None
        own = data.select("_v", "_y", F.col("_bags")[bag].cast("double").alias("_w")).where("_w > 0")
        kind, subset = (RandomForestClassifier, "sqrt") if n_classes else (RandomForestRegressor, "all")
        return kind(featuresCol="_v", labelCol="_y", weightCol="_w", numTrees=1, bootstrap=False, subsamplingRate=1.0,
                    featureSubsetStrategy=subset, maxDepth=max_depth, seed=seed + bag).fit(own)

    with ThreadPool(max(1, at_once)) as pool:
        trees = pool.map(grown, range(bags))
    data.unpersist()
    return BaggedForest(trees, seed, n_classes)


def _answers(df: DataFrame, forest: BaggedForest, features: str) -> tuple[DataFrame, dict[int, str]]:
    """One column a tree: its class shares, or its value."""
    cols = {}
    for bag, tree in enumerate(forest.trees):
        if tree is None:
            continue
        tree, cols[bag] = tree.copy(), f"_tree{bag}"
        tree.setFeaturesCol(features).setPredictionCol(f"_value{bag}")
        if forest.n_classes:
            tree.setProbabilityCol(f"_share{bag}").setRawPredictionCol(f"_raw{bag}")
            answer = vector_to_array(F.col(f"_share{bag}"))
        else:
            answer = F.col(f"_value{bag}")
        df = tree.transform(df).withColumn(cols[bag], answer).drop(f"_share{bag}", f"_raw{bag}", f"_value{bag}")
    return df, cols


def _mean(cols: dict[int, str], counts: dict[int, Column], n_classes: int) -> Column:
    """Mean over the trees that count, NULL without one."""
    total = sum(counts.values(), F.lit(0))

    def one(pick) -> Column:
        return F.try_divide(sum((F.when(counts[b] == 1, pick(F.col(c))).otherwise(0.0) for b, c in cols.items()), F.lit(0.0)), total)

    if not n_classes:
        return one(lambda c: c)
    return F.when(total > 0, F.array(*[one(lambda c, i=i: c[i]) for i in range(n_classes)]))


def predict(df: DataFrame, forest: BaggedForest, features: str, out: str = "pred") -> DataFrame:
    """Adds ``out``: the class of the largest mean share as a double (ties: the smaller class), or the mean value."""
    scored, cols = _answers(df, forest, features)
    answer = _mean(cols, {b: F.lit(1) for b in cols}, forest.n_classes)
    return scored.withColumn(out, _class_of(answer) if forest.n_classes else answer).drop(*cols.values())


def _class_of(shares: Column) -> Column:
    return (F.array_position(shares, F.array_max(shares)) - 1).cast("double")


def oob_predictions(df: DataFrame, forest: BaggedForest, key: str, features: str, out: str = "oob") -> DataFrame:
    """Adds ``out_trees`` (how many trees never saw the row's key) and ``out``: their mean class shares
    (array) or mean value, NULL where every tree saw it."""
    scored, cols = _answers(df, forest, features)
    counts = {b: _left_out(key, b, forest.seed).cast("int") for b in cols}
    scored = scored.withColumns({f"_out{b}": c for b, c in counts.items()})
    counts = {b: F.col(f"_out{b}") for b in cols}
    found = scored.withColumns({"out_trees": sum(counts.values(), F.lit(0)).cast("int"), out: _mean(cols, counts, forest.n_classes)})
    return found.drop(*cols.values(), *[f"_out{b}" for b in cols])


def oob_score(df: DataFrame, forest: BaggedForest, key: str, features: str, label: str) -> float | None:
    """Accuracy, or for regression 1 - squared error / variance, over labelled rows with an out-of-bag prediction;
    None without such a row, or where the values do not vary. One aggregate."""
    known = oob_predictions(df.where(_labelled(label)), forest, key, features).where("oob IS NOT NULL")
    y = F.col(label).cast("double")
    if forest.n_classes:
        return known.agg(F.avg((_class_of(F.col("oob")) == y).cast("double"))).first()[0]
    error, spread = F.avg((y - F.col("oob")) ** 2), F.var_pop(y)
    return known.agg(F.when(spread > 0, 1 - error / spread)).first()[0]
