"""Two-level stacking (M14): stage-1 fold models of several kinds feed stage-2 fold models.

Both stages use the same folds. A training row's stage-1 probabilities come from the models of its own fold, which never
saw it, so stage 2 learns from out-of-fold probabilities. The row is scored by all fold models of a kind in one scan and
keeps its own fold's: no join by id, no scan for each fold, and repeated ids keep their rows. An unseen batch has no fold:
each kind's fold models are averaged, and so are the stage-2 fold models on top of them, all in one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import blend as B
from foldwise.operators import models as ML


@dataclass
class StackState:
    features: list  # of stage 1
    n_classes: int
    stage1: dict  # kind's name -> its fold models
    stage2: list  # fold models
    with_features: bool


def _columns(name: str, n_classes: int) -> list[str]:
    return [f"{name}{c}" for c in range(n_classes)]


def _with_probs(df: DataFrame, models: list, features: list[str], name: str, n_classes: int, fold_col: str | None) -> DataFrame:
    """Adds ``{name}{class}``: of the row's own fold's model, or without ``fold_col`` the average of all."""
    keep = [f"_{name}_{c}" for c in df.columns]
    x = ML.assemble(df.toDF(*keep).withColumns({c: F.col(f"_{name}_{c}") for c in features}), features, "_x")
    for i, model in enumerate(models):
        own = model.copy().setFeaturesCol("_x").setProbabilityCol(f"_prob{i}").setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_pred{i}")
        x = own.transform(x).withColumn(f"_p{i}", vector_to_array(f"_prob{i}")).drop(f"_prob{i}", f"_raw{i}", f"_pred{i}")
    folds = [f"_p{i}" for i in range(len(models))]
    if fold_col:
        probs = F.element_at(F.array(*folds), F.col(f"_{name}_{fold_col}").cast("int") + 1)
    else:
        probs = B.normalise(B.add_arrays([F.col(c) for c in folds], n_classes), n_classes)
    x = x.select(*keep, probs.alias("_probs"))
    return x.select(*[F.col(k).alias(c) for k, c in zip(keep, df.columns, strict=True)], *[F.col("_probs")[c].alias(n) for c, n in enumerate(_columns(name, n_classes))])


def fit_stack(df: DataFrame, id_col: str, features: list[str], label: str, fold_col: str, k: int, n_classes: int,
              stage1: dict[str, tuple[str, dict]], stage2: tuple[str, dict], with_features: bool = True) -> tuple[StackState, DataFrame]:
    """``stage1``: name -> (kind of estimator, its parameters); ``stage2``: the same, of the model on top, which sees the
    features too unless ``with_features`` is off. Labels are 0 .. ``n_classes`` - 1, folds 0 .. ``k`` - 1. Returns the
    state and the stage-2 out-of-fold table: id, fold, label and ``probs``."""
    if clash := {c for name in stage1 for c in _columns(name, n_classes)} & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} are names of stage-1 probabilities")
    needed = df.select(*dict.fromkeys([id_col, fold_col, label, *features])).persist(StorageLevel.MEMORY_AND_DISK)
    level1 = {}
    for name, (kind, params) in stage1.items():
        data = ML._training_frame(needed, id_col, features, label, fold_col, params).persist(StorageLevel.MEMORY_AND_DISK)
        _, level1[name] = ML._oof_of(data, id_col, label, fold_col, k, kind, params)
        data.unpersist()
    stacked = needed
    for name, models in level1.items():
        stacked = _with_probs(stacked, models, features, name, n_classes, fold_col)
    inputs = (features if with_features else []) + [c for name in stage1 for c in _columns(name, n_classes)]
    data = ML._training_frame(stacked, id_col, inputs, label, fold_col, stage2[1]).persist(StorageLevel.MEMORY_AND_DISK)
    _, level2 = ML._oof_of(data, id_col, label, fold_col, k, *stage2)
    data.unpersist()
    needed.unpersist()
    state = StackState(list(features), n_classes, level1, level2, with_features)
    second = _with_probs(stacked, level2, inputs, "stage2_", n_classes, fold_col)
    return state, second.select(id_col, fold_col, label, F.array(*_columns("stage2_", n_classes)).alias("probs"))


def predict_stack(df: DataFrame, state: StackState) -> DataFrame:
    """Adds ``probs`` and ``pred`` (the first most probable class) to an unseen batch. One scan."""
    out = df
    for name, models in state.stage1.items():
        out = _with_probs(out, models, state.features, name, state.n_classes, None)
    first = [c for name in state.stage1 for c in _columns(name, state.n_classes)]
    inputs = (state.features if state.with_features else []) + first
    out = _with_probs(out, state.stage2, inputs, "stage2_", state.n_classes, None)
    probs = F.array(*_columns("stage2_", state.n_classes))
    out = out.withColumn("probs", probs).drop(*first, *_columns("stage2_", state.n_classes))
    return out.withColumn("pred", B.argmax(F.col("probs")))
