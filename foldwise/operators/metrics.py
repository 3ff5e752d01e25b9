"""Classification metrics (V1-V11) as aggregates.

AUC is exact and tie aware: scores are aggregated to (group, score, pos, neg), a global
running sum of negatives in (group, score) order is taken with a range shuffle
(``with_global_cumsum``; for groups, sums of each range), and AUC = sum(pos * (neg below + neg tied / 2)) / (P * N) per group.
Counts stay integers, so the result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators.lookup import Lookup, local_table
from foldwise.operators.ordering import with_global_cumsum

LOG_LOSS_EPS = 1e-15


def accuracy(df: DataFrame, label: str, pred: str, groups: list[str] = ()) -> DataFrame:
    # a missing prediction is a wrong one; rows without a label are not judged
    hit = F.when(F.col(label).isNotNull(), F.coalesce(F.col(label) == F.col(pred), F.lit(False)))
    acc = F.avg(hit.cast("double"))
    out = df.groupBy(*groups).agg(acc.alias("accuracy"))
    return out.withColumn("accuracy_pct", F.round(F.col("accuracy") * 100, 2))


def clip_p(p: Column, eps: float = LOG_LOSS_EPS) -> Column:
    return F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))


def binary_loss(label: str, p1: str) -> Column:
    """Log loss of a row from the probability of class 1."""
    p = clip_p(F.col(p1))
    return F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))


def multi_loss(label: str, probs: str) -> Column:
    """Log loss of a row; probs: array<double> in class-index order, renormalised after clipping."""
    clipped = F.transform(F.col(probs), lambda x: clip_p(x))
    total = F.aggregate(clipped, F.lit(0.0), lambda a, x: a + x)
    return -F.log(F.element_at(clipped, F.col(label) + 1) / total)


def log_loss_binary(df: DataFrame, label: str, p1: str, groups: list[str] = ()) -> DataFrame:
    return df.groupBy(*groups).agg(F.avg(binary_loss(label, p1)).alias("log_loss"))


def log_loss_multi(df: DataFrame, label: str, probs: str, groups: list[str] = ()) -> DataFrame:
    return df.groupBy(*groups).agg(F.avg(multi_loss(label, probs)).alias("log_loss"))


def grouped_auc(df: DataFrame, groups: list[str], score: str, label: str, rows: str | None = None) -> DataFrame:
    """Exact ROC-AUC per group (label 1 = positive). Groups with one class give NULL. ``rows``: how many rows a row stands for.

    Each range of the scores in order gives a row for each group in it: its positives and negatives, and the pairs won inside it. The negatives of
    the ranges before are added to those; no score is written or numbered."""
    one = F.lit(1).cast("long") if rows is None else F.col(rows)
    pos = F.sum((F.col(label) == 1).cast("long") * one).alias("_pos")
    neg = F.sum((F.col(label) != 1).cast("long") * one).alias("_neg")
    known = df
    for g in groups:
        known = known.where(F.col(g).isNotNull())
    agg = known.groupBy(*groups, score).agg(pos, neg)
    ranged = agg.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *groups, score)
    ranged = ranged.sortWithinPartitions(*groups, score).select(*groups, "_pos", "_neg", F.spark_partition_id().cast("long").alias("_pid"))

    def won(batches):
        for at, batch in enumerate(batches):
            batch["_at"] = at
            keys = [*groups, "_pid", "_at"]
            below = batch.groupby(keys, dropna=False)["_neg"].cumsum() - batch["_neg"]
            batch["_won"] = batch["_pos"] * (below + 0.5 * batch["_neg"])
            yield batch.groupby(keys, dropna=False, sort=False)[["_pos", "_neg", "_won"]].sum(min_count=1).reset_index()

    shape = T.StructType([f for f in agg.schema.fields if f.name in groups] + [T.StructField(c, T.LongType()) for c in ("_pid", "_at")]
                         + [T.StructField(c, T.DoubleType()) for c in ("_pos", "_neg", "_won")])
    parts = ranged.mapInPandas(won, shape)
    before = F.coalesce(F.sum("_neg").over(Window.partitionBy(*groups).orderBy("_pid", "_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    parts = parts.withColumn("_s", F.col("_won") + F.col("_pos") * before)
    res = parts.groupBy(*groups).agg(F.sum("_s").alias("_s"), F.sum("_pos").cast("long").alias("n_pos"), F.sum("_neg").cast("long").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("_s") / (F.col("n_pos") * F.col("n_neg")))
    return res.select(*groups, auc.alias("auc"), "n_pos", "n_neg")


def auc_binary(df: DataFrame, score: str, label: str) -> DataFrame:
    agg = df.groupBy(score).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
    )
    cum = with_global_cumsum(agg, [score], ["neg"])
    contrib = F.col("pos") * (F.col("neg_cum") - F.col("neg") + 0.5 * F.col("neg"))
    res = cum.agg(F.sum(contrib).alias("_s"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return res.select(F.try_divide(F.col("_s"), F.col("n_pos") * F.col("n_neg")).alias("auc"), "n_pos", "n_neg")


def auc_ovr(df: DataFrame, label: str, probs: str, n_classes: int, groups: list[str] = ()) -> DataFrame:
    """Macro one-vs-rest AUC: explode classes, exact AUC per class, average."""
    ex = df.select(*groups, F.col(label), F.posexplode(F.col(probs)).alias("cls", "score"))
    ex = ex.withColumn("_y", (F.col(label) == F.col("cls")).cast("int"))
    per = grouped_auc(ex, [*groups, "cls"], "score", "_y")
    return per.groupBy(*groups).agg(F.avg("auc").alias("auc_ovr"))


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, tps, fps, tpr, fpr) at every distinct score, cumulative from the top."""
    agg = df.groupBy(score).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
    )
    cum = with_global_cumsum(agg, [score], ["pos", "neg"])
    tot = agg.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = tot["P"] or 0, tot["N"] or 0
    tps = F.lit(P) - (F.col("pos_cum") - F.col("pos"))
    fps = F.lit(N) - (F.col("neg_cum") - F.col("neg"))
    return cum.select(
        F.col(score).alias("threshold"), tps.cast("long").alias("tps"), fps.cast("long").alias("fps"),
        F.try_divide(tps, F.lit(float(P))).alias("tpr"), F.try_divide(fps, F.lit(float(N))).alias("fpr"),
    )


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list) -> DataFrame:
    """counts for every (label, pred) pair that occurs, missing values included, and zeros for the
    other pairs of ``classes`` and for the diagonal of any other class."""
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("count"))
    seen = counts.select(F.explode(F.array(label, pred)).alias(label)).where(F.col(label).isNotNull()).distinct()
    diagonal = seen.select(label, F.col(label).alias(pred), F.lit(0).cast("long").alias("count"))
    kinds = df.select(label, pred).schema
    rows = local_table(df.sparkSession, [(c,) for c in classes], T.StructType([T.StructField(label, kinds[label].dataType)]))
    named = F.array(*[F.lit(c).cast(kinds[pred].dataType) for c in classes]) if classes else F.array().cast(T.ArrayType(kinds[pred].dataType))
    grid = rows.withColumn(pred, F.explode(named))  # made where it is counted
    zeros = grid.select(label, pred, F.lit(0).cast("long").alias("count")).unionByName(diagonal)
    return counts.unionByName(zeros).groupBy(label, pred).agg(F.sum("count").alias("count"))


def classification_report(cm: DataFrame, label: str, pred: str) -> DataFrame:
    """precision / recall / f1 / support per class, an accuracy row (value in f1, as in the usual
    report layout), and macro and weighted averages (0/0 -> 0)."""
    cm = Lookup.fit(cm).df  # classes x classes rows: materialise once, read three times
    tp = cm.where(F.col(label) == F.col(pred)).select(F.col(label).alias("cls"), F.col("count").alias("tp"))
    pred_tot = cm.groupBy(F.col(pred).alias("cls")).agg(F.sum("count").alias("pred_n"))
    true_tot = cm.groupBy(F.col(label).alias("cls")).agg(F.sum("count").alias("support"))
    per = tp.join(pred_tot, "cls").join(true_tot, "cls")
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("label"), prec.alias("precision"), rec.alias("recall"), "support")
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    per = per.withColumn("f1", f1)
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    tot.alias("support"), F.avg("f1").alias("f1"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"), tot.alias("support"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
    )
    acc = per.agg(
        F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"), tot.alias("support"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("f1"),  # sum of true positives / n
    )
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def macro_f1(cm: DataFrame, label: str, pred: str) -> DataFrame:
    rep = classification_report(cm, label, pred)
    return rep.where(F.col("label") == "macro avg").select(F.col("f1").alias("macro_f1"))


def binary_prf(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    c = df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return c.select(
        "tn", "fp", "fn", "tp",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )
