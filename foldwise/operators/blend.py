"""Scoring algebra (M11-M16): fold averaging, blending, stacking joins, submissions.

Class probabilities are ``array<double>`` columns in class-index order. With the number of
classes known (it is fitted), every step is a per-class element expression, which stays in
whole-stage codegen; array higher-order functions (interpreted) are only the fallback when it
is not given. Scoring k fold models over a batch is one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_arrays(cols: list[Column], n_classes: int | None = None) -> Column:
    if n_classes:
        parts = []
        for k in range(n_classes):
            acc = cols[0][k]
            for c in cols[1:]:
                acc = acc + c[k]
            parts.append(acc)
        return F.array(*parts)
    acc = cols[0]
    for c in cols[1:]:
        acc = F.zip_with(acc, c, lambda x, y: x + y)
    return acc


def normalise(arr: Column, n_classes: int | None = None) -> Column:
    """Divide by the row sum (summed left to right, as ((0 + p0) + p1) + ...)."""
    if n_classes:
        total = arr[0]
        for k in range(1, n_classes):
            total = total + arr[k]
        return F.array(*[arr[k] / total for k in range(n_classes)])
    total = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
    return F.transform(arr, lambda x: x / total)


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum (numpy ``argmax`` tie rule)."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def fold_average(df: DataFrame, fold_cols: list[str], out: str = "probs", n_classes: int | None = None) -> DataFrame:
    """Sum the folds' probability vectors, renormalise by the row sum, add the argmax class."""
    summed = df.withColumn(out, add_arrays([F.col(c) for c in fold_cols], n_classes))
    return summed.withColumn(out, normalise(F.col(out), n_classes)).withColumn("pred", argmax(F.col(out)))


def mean_blend(df: DataFrame, model_cols: list[str], out: str = "probs", n_classes: int | None = None) -> DataFrame:
    """Per-class mean over models (no renormalisation), then argmax."""
    n = float(len(model_cols))
    summed = add_arrays([F.col(c) for c in model_cols], n_classes)
    if n_classes:
        mean = F.array(*[summed[k] / F.lit(n) for k in range(n_classes)])
    else:
        mean = F.transform(summed, lambda x: x / F.lit(n))
    return df.withColumn(out, mean).withColumn("pred", argmax(F.col(out)))


def side_by_side(df: DataFrame, models: dict[str, str], n_classes: int) -> DataFrame:
    """``{model}{class}`` columns from each model's probability array."""
    return df.withColumns({
        f"{m}{k}": F.element_at(F.col(c), k + 1) for m, c in models.items() for k in range(n_classes)
    })


def stacking_join(train: DataFrame, preds: dict[str, DataFrame], keys=("ID", "kfold")) -> DataFrame:
    """Train LEFT JOIN each model's out-of-fold predictions on (ID, kfold), columns prefixed by model."""
    out = train
    for model, p in preds.items():
        renamed = p.select(*keys, *[F.col(c).alias(f"{model}_{c}") for c in p.columns if c not in keys])
        out = out.join(renamed, list(keys), "left")
    return out


def submission_binary(df: DataFrame, id_col: str, p1: str, target: str) -> DataFrame:
    return df.select(id_col, F.col(p1).alias(target))


def constant_submission(df: DataFrame, id_col: str, target: str, value) -> DataFrame:
    return df.select(id_col, F.lit(value).alias(target))
