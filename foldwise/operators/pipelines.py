"""The two ready pipelines, whole: every step fitted on the training rows, kept as one state that can be saved
(``sources.state``), and applied to training rows, an unseen batch or a stream without another fit.

Lead scoring (binary): extract, fill, type conversion, pair frequencies, Beta encoding, ratios, bins, dummies, quantiles to
normal (ratio columns included), drop. Top-up (multi-class): extract, recode and log1p, dates, outlier flags, type conversion,
MissForest, Dirichlet encoding, dummies, loan features, quantiles, drop; and beside it the child history with its own type
conversion, summary and quantiles, joined by id.

Steps that need nothing from each other's output are fitted from the same typed rows: one scan for all category levels,
one for all pairs, one for each encoder, and the quantile brackets of all columns in one aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.dates import date_parts, months_30d
from foldwise.operators import child as CH
from foldwise.operators import clean as C
from foldwise.operators import encode as E
from foldwise.operators import features as FT
from foldwise.operators import impute as I
from foldwise.operators import quantile as Q
from foldwise.session import stored


def drop_text(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if f.name in keep or not isinstance(f.dataType, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType))])


# ---- lead scoring ------------------------------------------------------------------------------

@dataclass
class LeadConfig:
    """Column names of the entity table, by what they are."""

    id_col: str
    target: str
    categories: list  # converted, and combined in pairs
    mode_fill: list  # categories filled by the fitted mode
    constant_fill: dict  # category -> the text for a missing value
    censored: str  # a number as text, with the censored text and missing as 0
    beta: dict  # feature -> key column or columns
    dummies: list
    premium: str
    upper: str
    lower: str
    bins: dict  # column -> edges
    quantiles: list  # of the columns above and the ratios
    n_quantiles: int = 1000
    beta_samples: int = 50
    beta_share: float = 0.8
    seed: int = 42


@dataclass
class LeadState:
    config: LeadConfig
    modes: dict
    levels: dict
    pairs: list
    freq: dict
    beta: E.BetaState
    dummies: dict
    quantiles: Q.QuantileState


def _lead_typed(df: DataFrame, c: LeadConfig, modes: dict) -> DataFrame:
    x = C.fill(df, {k: v for k, v in {**modes, **c.constant_fill}.items() if v is not None})
    x = x.withColumn(c.censored, C.recode_censored(F.col(c.censored)))
    return x.withColumns({n: F.col(n).cast("double") for n in (c.premium, c.upper, c.lower)})


def _lead_ratios(df: DataFrame, c: LeadConfig) -> DataFrame:
    return df.withColumns(FT.ratio_features(F.col(c.premium), F.col(c.upper), F.col(c.lower)))


def fit_lead(train: DataFrame, c: LeadConfig) -> LeadState:
    modes = {k: C.mode_value(train, k) for k in c.mode_fill}
    x = _lead_typed(train, c, modes)
    levels = C.fit_levels(x, c.categories)
    pairs, freq = E.fit_combine_frequency(x.withColumns({k: F.col(k).cast("string") for k in c.categories}), c.categories)
    beta = E.fit_beta(x, c.target, c.beta, c.id_col, n_samples=c.beta_samples, sample_size=c.beta_share, seed=c.seed, mode="expected")
    dummies = E.collect_levels(x, c.dummies)
    quantiles, _ = Q.fit_quantiles(_lead_ratios(x, c), c.quantiles, c.n_quantiles)
    return LeadState(c, modes, levels, pairs, freq, beta, dummies, quantiles)


def apply_lead(batch: DataFrame, st: LeadState) -> DataFrame:
    """The batch may lack the target. Unseen levels become missing, and then 0, the prior or no dummy."""
    c = st.config
    x = _lead_typed(batch, c, st.modes)
    x = C.type_conversion(x, st.levels, category_cols=c.categories)
    x = E.combine_frequency(x, st.pairs, st.freq)
    x = E.beta_transform(x, st.beta, ("mean",))
    x = _lead_ratios(x, c)
    for name, edges in c.bins.items():
        x = x.withColumns(FT.bin_dummies(F.col(name), name, edges))
    x = E.one_hot(x, st.dummies)
    return drop_text(Q.quantile_transform(x, st.quantiles, c.quantiles, "normal"), [c.id_col])


# ---- top-up timing -----------------------------------------------------------------------------

@dataclass
class TopupConfig:
    id_col: str
    target: str
    recode: dict  # category -> {text: text}
    log1p: list
    start: str  # a date; parts of it, and months from it to ``end``
    end: str
    outliers: list
    categories: list  # converted
    forest_categories: list  # imputed by MissForest, with the numbers below
    forest_numbers: list
    dirichlet: dict
    dummies: list
    loan: dict  # emi, income, tenure, disbursal, asset, finance -> column
    quantiles: list
    child_categories: list
    child_sums: list
    child_numbers: list
    child_quantiles: list  # of the summary's columns
    n_quantiles: int = 1000
    child_n_quantiles: int = 1000
    trees: int = 10
    depth: int = 5
    samples: int = 50
    share: float = 0.8
    seed: int = 42


@dataclass
class TopupState:
    config: TopupConfig
    bounds: dict
    levels: dict
    forest: I.MissForestState
    codes: object
    dirichlet: E.DirichletState
    dummies: dict
    quantiles: Q.QuantileState
    child_levels: dict
    child_quantiles: Q.QuantileState
    classes: list = field(default_factory=list)


def _topup_dated(df: DataFrame, c: TopupConfig) -> DataFrame:
    x = df.withColumns({k: C.recode(F.col(k), m) for k, m in c.recode.items()})
    x = x.withColumns({k: F.log1p(F.col(k).cast("double")) for k in c.log1p})
    x = C.fill_dates(x, [c.start, c.end])
    return x.withColumns({**date_parts(F.col(c.start), c.start), f"{c.start}_months": months_30d(F.col(c.end), F.col(c.start))})


def _loan(df: DataFrame, c: TopupConfig) -> DataFrame:
    return df.withColumns(FT.loan_features(**{k: F.col(v).cast("double") for k, v in c.loan.items()}))


def _summary(rows: DataFrame, c: TopupConfig, levels: dict) -> DataFrame:
    """Numbers that are missing count as 0; a category level that was not fitted counts nowhere."""
    typed = rows.withColumns({k: F.coalesce(F.col(k).cast("double"), F.lit(0.0)) for k in c.child_numbers})
    return CH.child_summary(typed, c.id_col, sum_cols=c.child_sums, levels=levels, num_cols=c.child_numbers)


def fit_history(own: DataFrame, history: DataFrame, c: TopupConfig) -> tuple[dict, DataFrame]:
    """The category levels of the training rows' ``own`` history, and with them the summary of all of ``history``, one
    row an id, stored: fit and any batch take their entities from it."""
    levels = CH.fit_child_levels(own, c.child_categories)
    return levels, stored(_summary(history, c, levels))


def fit_topup(train: DataFrame, history: DataFrame, c: TopupConfig, summarised: tuple[dict, DataFrame] | None = None) -> TopupState:
    """``summarised``: what ``fit_history`` gave for the training rows' ``history`` and a history that contains it."""
    x = _topup_dated(train, c)
    bounds = Q.fit_outlier_bounds(x, c.outliers)
    levels = C.fit_levels(x, c.categories)
    x = C.type_conversion(Q.outlier_flag(x, bounds), levels, category_cols=c.categories)
    x, forest = I.fit_transform_missforest(x, c.forest_categories, c.forest_numbers, num_trees=c.trees, max_depth=c.depth, seed=c.seed)
    x = stored(x)  # read by every fit below, some columns each
    codes = E.fit_label_encoder(x, c.target)
    y = E.label_encode(x, c.target, codes, out="_y")
    dirichlet = E.fit_dirichlet(y, "_y", c.dirichlet, c.id_col, n_samples=c.samples, sample_size=c.share, seed=c.seed, mode="expected")
    dummies = E.collect_levels(x, c.dummies)
    quantiles, _ = Q.fit_quantiles(_loan(x, c), c.quantiles, c.n_quantiles)
    child_levels, summary = summarised or fit_history(history, history, c)
    if summarised:
        summary = summary.join(train.select(c.id_col), c.id_col, "left_semi").select(c.id_col, *c.child_quantiles)
    child_quantiles, _ = Q.fit_quantiles(summary, c.child_quantiles, c.child_n_quantiles)
    classes = [r[c.target] for r in codes.df.orderBy("code").collect()]  # one of each class
    return TopupState(c, bounds, levels, forest, codes, dirichlet, dummies, quantiles, child_levels, child_quantiles, classes)


def apply_topup(batch: DataFrame, history: DataFrame, st: TopupState, summary: DataFrame | None = None) -> DataFrame:
    """The batch may lack the target; entities without history get missing child columns. ``summary``: that of a history
    that contains ``history``, by the state's levels, if it was made before."""
    c = st.config
    x = Q.outlier_flag(_topup_dated(batch, c), st.bounds)
    x = C.type_conversion(x, st.levels, category_cols=c.categories)
    x = I.transform_missforest(x, st.forest, c.forest_categories, c.forest_numbers)
    x = E.dirichlet_transform(x, st.dirichlet, ("mean",))
    x = E.one_hot(x, st.dummies)
    x = Q.quantile_transform(_loan(x, c), st.quantiles, c.quantiles, "normal")
    summary = _summary(history, c, st.child_levels) if summary is None else summary
    x = Q.quantile_transform(CH.attach(x, summary, c.id_col), st.child_quantiles, c.child_quantiles, "normal")  # of the batch's entities only
    return drop_text(x, [c.id_col, c.target])
