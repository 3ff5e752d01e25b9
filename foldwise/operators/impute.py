"""MissForest-style iterative imputation.

Columns are imputed in ascending order of missing count. For each column: the other columns
are pre-filled with their mean / mode, a random forest is trained on the rows where the column
is observed and predicts the rows where it is missing; later columns see the earlier fills.
The driver loops over columns only; each step is a Spark ML job and its output is written to
the shared checkpoint folder to cut lineage. Columns without a model (nothing missing, or nothing
observed, at fit) fall back to the fitted mean / mode at transform.

With ``oob_key`` the forests are bagged by a hash of that key (``forest.py``), and the state holds each column's
out-of-bag score: the accuracy of a category, 1 - squared error / variance of a number.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import forest as FO
from foldwise.operators.clean import fit_means, mode_value
from foldwise.session import cut_lineage


@dataclass
class MissForestState:
    order: list[str]
    means: dict
    modes: dict
    models: dict = field(default_factory=dict)  # column -> (predictor pipeline, model, decoder)
    oob: dict = field(default_factory=dict)  # column -> out-of-bag score, with bagged forests only


def _features(df, cat_cols, num_cols, target, means, modes, extra):
    """The pre-filled predictors of ``target``; a column without an observed value predicts nothing."""
    nums = [c for c in num_cols if c != target and means[c] is not None]
    cats = [c for c in cat_cols if c != target and modes[c] is not None]
    cols = {f"_f_{c}": F.coalesce(F.col(c), F.lit(means[c])) for c in nums}
    cols |= {f"_s_{c}": F.coalesce(F.col(c), F.lit(modes[c])) for c in cats}
    return df.withColumns(cols) if cols else df, [f"_f_{c}" for c in nums] + extra, cats


def fit_transform_missforest(df: DataFrame, cat_cols: list[str], num_cols: list[str], extra: list[str] = (),
                             num_trees: int = 20, max_depth: int = 8, seed: int = 42, oob_key: str | None = None) -> tuple[DataFrame, MissForestState]:
    extra = list(extra)
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cat_cols + num_cols]).first()
    order = sorted([c for c in cat_cols + num_cols if 0 < counts[c] < counts["_all"]], key=lambda c: (counts[c], c))
    means = fit_means(df, num_cols) if num_cols else {}
    modes = {c: mode_value(df, c) for c in cat_cols}
    st = MissForestState(order, means, modes)
    parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    current = df
    for target in order:
        feats, numeric, cats = _features(current, cat_cols, num_cols, target, means, modes, extra)
        prep = _predictors(numeric, cats).fit(feats)
        feats = prep.transform(feats)
        observed = feats.where(F.col(target).isNotNull())
        if target in cat_cols:
            label_ix = StringIndexer(inputCol=target, outputCol="_y", handleInvalid="skip").fit(observed)
            decoder = IndexToString(inputCol="_pred", outputCol="_fill", labels=label_ix.labels)
            observed = label_ix.transform(observed)
            if not oob_key:
                model = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=num_trees, maxDepth=max_depth,
                                               seed=seed, predictionCol="_pred").fit(observed)
        elif not oob_key:
            model = RandomForestRegressor(featuresCol="_x", labelCol=target, numTrees=num_trees, maxDepth=max_depth,
                                          seed=seed, predictionCol="_pred").fit(observed)
        if target in num_cols:
            decoder = None
        if oob_key:
            y, n = ("_y", len(label_ix.labels)) if target in cat_cols else (target, 0)
            model = FO.fit_bagged(observed, oob_key, "_x", y, n, num_trees, max_depth, seed)
            st.oob[target] = FO.oob_score(observed, model, oob_key, "_x", y)
        st.models[target] = (prep, model, decoder)
        # the forest scores the rows that miss the column; the others are taken over as they are
        filled = _predicted(feats.where(F.col(target).isNull()), model, decoder)
        filled = filled.withColumn(target, F.col("_fill")).select(*df.columns)
        known = current.where(F.col(target).isNotNull()).select(*df.columns)
        current = cut_lineage(known.unionByName(filled).coalesce(parts))
    return current, st


def _predictors(numeric: list[str], cats: list[str]) -> Pipeline:
    """Numbers as they are, categories one-hot in sparse vectors: any number of levels (a category index
    would need as many bins in the trees as there are levels). A level unseen at fit is one more column."""
    stages = []
    if cats:
        indexed = [f"_i_{c}" for c in cats]
        stages.append(StringIndexer(inputCols=[f"_s_{c}" for c in cats], outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=[f"_o_{c}" for c in cats], dropLast=False))
    x = VectorAssembler(inputCols=numeric + [f"_o_{c}" for c in cats], outputCol="_x", handleInvalid="keep")
    return Pipeline(stages=[*stages, x])


def _predicted(feats: DataFrame, model, decoder) -> DataFrame:
    pred = FO.predict(feats, model, "_x", "_pred") if isinstance(model, FO.BaggedForest) else model.transform(feats)
    return decoder.transform(pred) if decoder else pred.withColumn("_fill", F.col("_pred"))


def transform_fallback(df: DataFrame, st: MissForestState, cat_cols: list[str], num_cols: list[str]) -> DataFrame:
    """Columns without a fitted model are filled with the fitted mean / mode."""
    fills = {c: st.means[c] for c in num_cols if c not in st.models}
    fills.update({c: st.modes[c] for c in cat_cols if c not in st.models})
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def transform_missforest(df: DataFrame, st: MissForestState, cat_cols: list[str], num_cols: list[str]) -> DataFrame:
    """Apply the fitted per-column forests to a new batch in the fitted order; a forest scores only the rows that
    miss its column, in one pass over the batch (bagged forests read it twice). Columns without a model use the mean / mode fallback. Stateless per row, so valid on a stream too."""
    current = df
    for target in st.order:
        prep, model, decoder = st.models[target]
        lacking = current.where(F.col(target).isNull()) if isinstance(model, FO.BaggedForest) else current
        feats, _, _ = _features(lacking, cat_cols, num_cols, target, st.means, st.modes, [])
        fill = _predicted(prep.transform(feats), model, decoder)
        if lacking is current:  # the prediction stands inside the condition, so that it is made only where it counts
            current = fill.withColumn(target, F.when(F.col(target).isNull(), F.col("_fill")).otherwise(F.col(target))).select(*df.columns)
        else:
            fill = fill.withColumn(target, F.col("_fill")).select(*df.columns)
            current = current.where(F.col(target).isNotNull()).unionByName(fill)
    return transform_fallback(current, st, cat_cols, num_cols)
