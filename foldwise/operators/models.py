"""Spark ML training per fold.

Each fold fit is one distributed Spark ML job over a cached assembled frame; the driver loop
runs over folds / trials / classes only (a handful of iterations), never over rows. Class
probabilities come back as ``array<double>`` via ``vector_to_array``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import blend as B
from foldwise.operators import metrics as M
from foldwise.operators.lookup import Lookup
from foldwise.operators.split import ranked
from foldwise.operators.trees import BinnedRows
from foldwise.session import cut_lineage


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


def estimator(kind: str, label: str, params: dict | None = None):
    p = dict(params or {})
    common = {"featuresCol": "features", "labelCol": label, "seed": p.pop("seed", 42)} if kind != "logreg" else {
        "featuresCol": "features", "labelCol": label}
    if kind == "gbt":
        return GBTClassifier(**common, **p)
    if kind == "rf":
        return RandomForestClassifier(**common, **p)
    if kind == "logreg":
        p.pop("seed", None)
        return LogisticRegression(**common, **p)
    raise ValueError(kind)


def _probs(df: DataFrame) -> DataFrame:
    return df.withColumn("probs", vector_to_array(F.col("probability")))


def fit_predict(train: DataFrame, valid: DataFrame, kind: str, label: str, params: dict,
                early_stop: bool = False) -> tuple[object, DataFrame]:
    """Fit on train, score valid. GBT early stopping uses the valid rows as the validation set."""
    if kind == "gbt" and early_stop:
        both = train.withColumn("_is_valid", F.lit(False)).unionByName(valid.withColumn("_is_valid", F.lit(True)))
        model = estimator(kind, label, {**params, "validationIndicatorCol": "_is_valid"}).fit(both)
    else:
        model = estimator(kind, label, params).fit(train)
    return model, _probs(model.transform(valid))


def train_oof(df: DataFrame, id_col: str, features: list[str], label: str, fold_col: str, k: int,
              kind: str = "gbt", params: dict | None = None, early_stop: bool = False) -> tuple[DataFrame, list]:
    """Out-of-fold probabilities (id, fold, label, probs) and the k fold models. ``params`` may name a
    ``weightCol`` of the input, as ``balanced_weights`` adds."""
    data = _training_frame(df, id_col, features, label, fold_col, params).persist(StorageLevel.MEMORY_AND_DISK)
    oof, models = _oof_of(data, id_col, label, fold_col, k, kind, params, early_stop)
    return _released(oof, data), models


def _released(oof: DataFrame, data: DataFrame) -> DataFrame:
    """The table written to the shared folder (an id, a fold, a label and the probabilities a row), the frame it came
    from dropped from the cache."""
    oof = cut_lineage(oof)
    data.unpersist()
    return oof


def _training_frame(df: DataFrame, id_col: str, features: list[str], label: str, fold_col: str, params: dict | None) -> DataFrame:
    weights = [params["weightCol"]] if params and "weightCol" in params else []
    return assemble(df, features).select(id_col, fold_col, F.col(label).cast("double").alias(label), *weights, "features")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Adds n / (classes * rows of the row's class): every class weighs the same in all. Rows with a NULL
    label count for nothing and get a NULL weight. One aggregation; classes come as a size-checked lookup."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows"), F.count(F.lit(1))).first()
    weight = F.lit(float(total[0] or 0)) / (F.lit(total[1]) * F.col("_rows"))
    return Lookup.fit(counts.select(label, weight.alias(out))).join(df, label).select(*[c for c in df.columns if c != out], out)


def _oof_of(data: DataFrame, id_col: str, label: str, fold_col: str, k: int, kind: str, params: dict | None,
            early_stop: bool = False, at_once: int = 3, bins: BinnedRows | None = None) -> tuple[DataFrame, list]:
    """The folds are independent fits of many short jobs; ``at_once`` of them run together. With ``bins`` (``trees.binned`` of the
    data) the trees of all folds are fitted on those, where they can do what ``params`` say: then no models come back, and rows alike are put
    together (``BinnedRows.oof``)."""
    if bins is not None and not early_stop and bins.takes(kind, params or {}):
        return bins.oof(kind, params or {}), []

    def fitted(f: int):
        return fit_predict(data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f), kind, label, params or {}, early_stop)

    with ThreadPool(max(1, min(at_once, k))) as pool:
        found = pool.map(fitted, range(k), 1)
    models = [model for model, _ in found]
    parts = [pred.select(id_col, fold_col, label, "probs") for _, pred in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, models


def train_ovr_gbt_oof(df: DataFrame, id_col: str, features: list[str], label: str, n_classes: int,
                      fold_col: str, k: int, params: dict | None = None, early_stop: bool = False) -> DataFrame:
    """Multi-class boosting from binary GBTs: one model per (fold, class), class-1 probabilities
    stacked in class order and renormalised per row (Spark's GBT is binary only). With
    ``early_stop`` each per-class model stops on the fold's validation rows, as in the binary case."""
    data = assemble(df, features).select(id_col, fold_col, F.col(label).cast("int").alias(label), "features")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    for f in range(k):
        train, valid = data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f)
        scored = valid
        for c in range(n_classes):
            tr = train.withColumn("_yc", (F.col(label) == c).cast("double"))
            if early_stop:
                va = valid.withColumn("_yc", (F.col(label) == c).cast("double"))
                both = tr.withColumn("_is_valid", F.lit(False)).unionByName(va.withColumn("_is_valid", F.lit(True)))
                m = estimator("gbt", "_yc", {**(params or {}), "validationIndicatorCol": "_is_valid"}).fit(both)
            else:
                m = estimator("gbt", "_yc", params).fit(tr)
            s = m.transform(scored).withColumn(f"_p{c}", vector_to_array(F.col("probability"))[1])
            scored = s.drop("rawPrediction", "probability", "prediction")
        probs = B.normalise(F.array(*[F.col(f"_p{c}") for c in range(n_classes)]), n_classes)
        parts.append(scored.select(id_col, fold_col, label, probs.alias("probs")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _released(out, data)


# ---- random search -----------------------------------------------------------------------------

@dataclass
class Space:
    name: str
    low: float
    high: float
    log: bool = False
    integer: bool = False


def sample_params(space: list[Space], trial: int, seed: int = 42) -> dict:
    """Seeded, reproducible draw per (trial, parameter) from an md5 uniform."""
    out = {}
    for s in space:
        h = hashlib.md5(f"{trial}|{s.name}|{seed}".encode()).hexdigest()[:8]
        u = int(h, 16) / 2**32
        if s.log:
            import math

            v = math.exp(math.log(s.low) + u * (math.log(s.high) - math.log(s.low)))
        else:
            v = s.low + u * (s.high - s.low)
        out[s.name] = int(round(v)) if s.integer else v
    return out


def random_search(df: DataFrame, id_col: str, features: list[str], label: str, fold_col: str, k: int,
                  kind: str, space: list[Space], n_trials: int = 10, seed: int = 42, fixed: dict | None = None) -> DataFrame:
    """Trial table: params, AUC per fold and mean AUC (the reference minimises -mean score). All trials
    train on one cached frame, which is released at the end."""
    spark = df.sparkSession
    rows = []
    data = _training_frame(df, id_col, features, label, fold_col, fixed).persist(StorageLevel.MEMORY_AND_DISK)
    for t in range(n_trials):
        params = {**(fixed or {}), **sample_params(space, t, seed)}
        oof, _ = _oof_of(data, id_col, label, fold_col, k, kind, params)
        scored = oof.withColumn("p1", F.col("probs")[1])
        per = M.grouped_auc(scored, [fold_col], "p1", label).select(fold_col, "auc").collect()  # k rows
        aucs = {r[fold_col]: r["auc"] for r in per}
        mean = sum(aucs.values()) / len(aucs)
        rows.append((t, str(params), *[float(aucs.get(f, float("nan"))) for f in range(k)], mean, -mean))
    data.unpersist()
    cols = ["trial", "params", *[f"auc_fold{f}" for f in range(k)], "auc_mean", "objective"]
    return spark.createDataFrame(rows, cols)


def feature_importance(model, features: list[str]) -> list[tuple[str, float]]:
    imp = model.featureImportances.toArray()
    return sorted(zip(features, [float(x) for x in imp]), key=lambda t: (-t[1], t[0]))


def permute_column(df: DataFrame, id_col: str, col: str, seed: int = 7) -> DataFrame:
    """Replace ``col`` by the value of another row: rows ranked by a hash, value taken from the
    next rank (cyclic). An equi-join on rank; no row is dropped or duplicated, and nothing is written:
    the donor side ranks only the id and the column."""
    rows = ranked(df, [], id_col, F.lit(col), seed=seed).drop("_in", "_n")
    donor = ranked(df.select(*{id_col: 0, col: 0}), [], id_col, F.lit(col), seed=seed)
    donor = donor.select((F.col("_r") % F.col("_n") + 1).alias("_r"), F.col(col).alias("_donor"))
    return rows.join(donor, "_r").withColumn(col, F.col("_donor")).drop("_donor", "_r")


def score_with_folds(df: DataFrame, fold_models: list, features: list[str], n_classes: int,
                     out: str = "probs") -> DataFrame:
    """Score a batch with every fold model in ONE scan: the k ``transform`` calls are chained
    (each writes its own output columns), then the probability vectors are averaged and
    renormalised per row and the argmax class is added. No per-fold scan, no join."""
    x = assemble(df, features)
    cols = []
    for i, m in enumerate(fold_models):
        m = m.copy()
        m.setProbabilityCol(f"_prob{i}").setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_pred{i}")
        x = m.transform(x).withColumn(f"_p{i}", vector_to_array(F.col(f"_prob{i}")))
        x = x.drop(f"_prob{i}", f"_raw{i}", f"_pred{i}")
        cols.append(f"_p{i}")
    return B.fold_average(x, cols, out=out, n_classes=n_classes).drop(*cols, "features")
