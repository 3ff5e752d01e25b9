"""Category encoders.

Every fit is one aggregation whose output is keyed by category level(s); transforms are
expressions (one-hot) or joins against a size-checked lookup (label, frequency, target
encoders). Bayesian target encoders fit all bootstrap replicates in ONE pass: each row carries
deterministic Poisson weights (hash of row key, replicate and seed), and the per-level sums of
weighted counts equal the average of the replicate posteriors.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.hashing import poisson_weight, uniform
from foldwise.operators.features import combine_key
from foldwise.operators.lookup import MAX_LEVELS, Lookup, collect_levels
from foldwise.operators.ordering import with_global_rank


# ---- one-hot ---------------------------------------------------------------------------

def one_hot(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = True) -> DataFrame:
    """``{col}_{level}`` 0/1 columns for the fitted sorted levels; NULL/unseen -> all 0."""
    exprs = {}
    for c, lv in levels.items():
        for level in (lv[1:] if drop_first else lv):
            exprs[f"{c}_{level}"] = F.coalesce((F.col(c).cast("string") == F.lit(level)).cast("int"), F.lit(0))
    return df.withColumns(exprs)


# ---- label encoding ----------------------------------------------------------------------

def fit_label_encoder(df: DataFrame, col: str, code_col: str = "code") -> Lookup:
    """Sorted distinct levels -> 0..n-1. Distributed rank, so any cardinality works."""
    levels = df.select(F.col(col).cast("string").alias(col)).where(F.col(col).isNotNull()).distinct()
    small = Lookup.fit(levels)
    if small.broadcastable:  # bounded level set: sort on the driver
        names = sorted(r[0] for r in small.df.collect())
        lut = df.sparkSession.createDataFrame(list(zip(names, range(len(names)))), f"{col} string, {code_col} int")
        return Lookup(lut, True)
    ranked = with_global_rank(small.df, [col], name="_r")  # any cardinality: distributed rank
    return Lookup.fit(ranked.select(col, (F.col("_r") - 1).cast("int").alias(code_col)))


def label_encode(df: DataFrame, col: str, enc: Lookup, out: str | None = None) -> DataFrame:
    lut = enc.df.withColumnRenamed("code", "_code").withColumnRenamed(col, "_lvl")
    right = F.broadcast(lut) if enc.broadcastable else lut
    j = df.join(right, F.col(col).cast("string") == F.col("_lvl"), "left").drop("_lvl")
    return j.withColumn(out or col, F.col("_code")).drop("_code") if (out or col) != "_code" else j


def label_decode(df: DataFrame, code_col: str, enc: Lookup, col: str, out: str) -> DataFrame:
    lut = enc.df.select(F.col("code").alias("_code"), F.col(col).alias(out))
    right = F.broadcast(lut) if enc.broadcastable else lut
    return df.join(right, F.col(code_col) == F.col("_code"), "left").drop("_code")


# ---- frequency encoding --------------------------------------------------------------------

def fit_frequency(df: DataFrame, col: str) -> Lookup:
    """share of rows per non-null level (denominator counts every row, NULL keys included)."""
    n = df.count()  # row count (Parquet answers it from footers when unfiltered)
    counts = df.groupBy(F.col(col).alias("_lvl")).agg(F.count(F.lit(1)).alias("_n"))
    lut = counts.select("_lvl", (F.col("_n") / F.lit(float(max(n, 1)))).alias("_freq")).where(F.col("_lvl").isNotNull())
    return Lookup.fit(lut)


def frequency_encode(df: DataFrame, col: str, enc: Lookup, out: str, unseen: float = 0.0) -> DataFrame:
    lut = enc.df
    right = F.broadcast(lut) if enc.broadcastable else lut
    j = df.join(right, df[col] == right["_lvl"], "left")
    val = F.when(F.col(col).isNull(), F.lit(None).cast("double")).otherwise(F.coalesce("_freq", F.lit(unseen)))
    return j.withColumn(out, val).drop("_lvl", "_freq")


def fit_combine_frequency(df: DataFrame, cols: list[str]) -> tuple[list[tuple[str, str]], dict]:
    """Frequencies of all 2-column combination keys. Rows are counted by their whole tuple first (combined map-side), so that
    only distinct tuples are exploded, once for each pair."""
    pairs = list(combinations(cols, 2))
    tuples = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
    stacked = tuples.select("_rows",
        F.explode(
            F.array(*[F.struct(F.lit(f"{a}_{b}").alias("_pair"), combine_key([a, b]).alias("_key")) for a, b in pairs])
        ).alias("s")
    ).select("s._pair", "s._key", "_rows")
    n = df.count()
    counts = stacked.groupBy("_pair", "_key").agg(F.sum("_rows").alias("_n"))
    lut = counts.select("_pair", "_key", (F.col("_n") / F.lit(float(max(n, 1)))).alias("_freq"))
    return pairs, Lookup.fit_split(lut, "_pair")  # one size check per pair


def combine_frequency(df: DataFrame, pairs, enc: dict, unseen: float = 0.0) -> DataFrame:
    out = df
    for a, b in pairs:
        name = f"{a}_{b}"
        lk = enc.get(name)
        if lk is None:  # empty fit: every key is unseen
            out = out.withColumn(name, F.lit(unseen))
            continue
        lut = lk.df.select(F.col("_key").alias(f"_k_{name}"), F.col("_freq").alias(f"_f_{name}"))
        right = F.broadcast(lut) if lk.broadcastable else lut
        out = out.join(right, combine_key([a, b]) == F.col(f"_k_{name}"), "left")
        out = out.withColumn(name, F.coalesce(F.col(f"_f_{name}"), F.lit(unseen))).drop(f"_k_{name}", f"_f_{name}")
    return out


def all_not_null(keys: list[str]) -> Column:
    """pandas group-by drops rows with a NULL key; so do the encoder fits."""
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


# ---- Bayesian target encoders ----------------------------------------------------------------

def sample_weight(key: Column, n_samples: int, sample_size: float, seed: int, mode: str,
                  n_rows: int) -> tuple[Column, float]:
    """(integer per-row weight, scale) such that scale * sum(weight * x) = the replicate average.

    expected: weight 1, scale int(n * f) / n (the bootstrap mean, exact and noise free).
    bootstrap: a row's total weight over R replicates of Poisson(f) resampling is a sum of R
    independent Poisson(f) draws, i.e. one Poisson(R * f) draw; it is taken from
    uniform(key | seed), scale 1 / R. One hash per row instead of R, same distribution.
    Integer sums keep the fit exact and order independent.
    """
    if mode == "expected":
        return F.lit(1), (int(n_rows * sample_size) / n_rows if n_rows else 0.0)
    if mode != "bootstrap":
        raise ValueError(f"unknown mode {mode}")
    return poisson_weight(uniform(key, seed=seed), n_samples * sample_size), 1.0 / n_samples


def fit_stacked(df: DataFrame, features: dict[str, list[str]], carry: list[str], aggs: list[Column]) -> dict[str, Lookup]:
    """Fit per-level statistics of SEVERAL features in one scan and one shuffle.

    Each row is exploded into one (feature, key) pair per feature (the key is the array of the
    key columns as text; rows with a NULL key part are dropped, as pandas does), aggregated by
    (feature, key) with map-side combining, and split back into per-feature lookups with the
    original key columns and types.
    """
    structs = [
        F.struct(F.lit(name).alias("_f"),
                 F.when(all_not_null(keys), F.array(*[F.col(k).cast("string") for k in keys])).alias("_k"))
        for name, keys in features.items()
    ]
    long = df.select(*carry, F.explode(F.array(*structs)).alias("_s")).select(*carry, "_s._f", "_s._k")
    stats = long.where(F.col("_k").isNotNull()).groupBy("_f", "_k").agg(*aggs)
    per_feature = Lookup.fit_split(stats, "_f")  # each feature's lookup gets its own size check
    value_cols = [c for c in stats.columns if c not in ("_f", "_k")]
    out = {}
    for name, keys in features.items():
        lk = per_feature.get(name) or Lookup(df.sparkSession.createDataFrame([], stats.schema), True)
        sub = lk.df.select(
            *[F.element_at("_k", i + 1).cast(df.schema[k].dataType).alias(k) for i, k in enumerate(keys)],
            *[F.col(c).alias(f"{c}_{name}") for c in value_cols],
        )
        out[name] = Lookup(sub, lk.broadcastable)
    return out


def _keys(features: dict[str, object]) -> dict[str, list[str]]:
    return {name: ([cols] if isinstance(cols, str) else list(cols)) for name, cols in features.items()}


@dataclass
class BetaState:
    alpha0: float
    beta0: float
    lookups: dict[str, Lookup] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)


def fit_beta(df: DataFrame, target: str, features: dict[str, object], id_col: str,
             n_samples: int = 10, sample_size: float = 0.7, seed: int = 42, mode: str = "expected") -> BetaState:
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("p")).first()
    n, alpha0 = stats["n"], float(stats["p"] or 0.0)
    w, scale = sample_weight(F.col(id_col), n_samples, sample_size, seed, mode, n)
    keys = _keys(features)
    key_cols = sorted({k for ks in keys.values() for k in ks})
    weighted = df.select(*key_cols, F.col(target).alias("_y"), w.alias("_w"))
    fitted = fit_stacked(weighted, keys, ["_y", "_w"], [
        (F.lit(alpha0) + F.lit(scale) * F.sum(F.col("_w") * F.col("_y"))).alias("_a"),
        (F.lit(1.0 - alpha0) + F.lit(scale) * F.sum(F.col("_w") * (1 - F.col("_y")))).alias("_b"),
    ])
    return BetaState(alpha0, 1.0 - alpha0, fitted, keys)


def beta_transform(df: DataFrame, st: BetaState, moments=("mean",)) -> DataFrame:
    out = df
    for name, lk in st.lookups.items():
        out = lk.join(out, st.keys[name], "left")
        a = F.coalesce(F.col(f"_a_{name}"), F.lit(st.alpha0))
        b = F.coalesce(F.col(f"_b_{name}"), F.lit(st.beta0))
        exprs = {}
        if "mean" in moments:
            exprs[f"{name}__M"] = a / (a + b)
        if "variance" in moments or "var" in moments:
            exprs[f"{name}__V"] = (a * b) / ((a + b) * (a + b) * (a + b + 1))
        out = out.withColumns(exprs).drop(f"_a_{name}", f"_b_{name}")
    return out


@dataclass
class DirichletState:
    classes: list
    prior: dict
    lookups: dict[str, Lookup] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)


def fit_dirichlet(df: DataFrame, target: str, features: dict[str, object], id_col: str,
                  n_samples: int = 50, sample_size: float = 0.8, seed: int = 42, mode: str = "expected") -> DirichletState:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LEVELS + 1).collect()  # one row per class
    if len(counts) > MAX_LEVELS:
        raise ValueError(f"target {target} has more than {MAX_LEVELS} classes")
    n = sum(r["n"] for r in counts if r[target] is not None)
    classes = sorted(r[target] for r in counts if r[target] is not None)
    prior = {r[target]: r["n"] / n for r in counts if r[target] is not None}
    w, scale = sample_weight(F.col(id_col), n_samples, sample_size, seed, mode, n)
    keys = _keys(features)
    key_cols = sorted({k for ks in keys.values() for k in ks})
    weighted = df.select(*key_cols, F.col(target).alias("_y"), w.alias("_w"))
    aggs = [
        (F.lit(prior[k]) + F.lit(scale) * F.sum(F.when(F.col("_y") == F.lit(k), F.col("_w")).otherwise(F.lit(0))))
        .alias(f"_a_{k}")
        for k in classes
    ]
    fitted = fit_stacked(weighted, keys, ["_y", "_w"], aggs)
    # per-feature columns are named _a_{class}_{feature}
    return DirichletState(classes, prior, fitted, keys)


def dirichlet_transform(df: DataFrame, st: DirichletState, moments=("mean",), drop_last: bool = True) -> DataFrame:
    out = df
    for name, lk in st.lookups.items():
        out = lk.join(out, st.keys[name], "left")
        alphas = {k: F.coalesce(F.col(f"_a_{k}_{name}"), F.lit(st.prior[k])) for k in st.classes}
        a0 = None
        for a in alphas.values():
            a0 = a if a0 is None else a0 + a
        keep = st.classes[:-1] if drop_last else st.classes
        exprs = {}
        for k in keep:
            if "mean" in moments:
                exprs[f"{name}_M_{k}"] = alphas[k] / a0
            if "var" in moments:
                exprs[f"{name}_V_{k}"] = alphas[k] * (a0 - alphas[k]) / (a0 * a0 * (a0 + 1))
        out = out.withColumns(exprs).drop(*[f"_a_{k}_{name}" for k in st.classes])
    return out


def class_levels(df: DataFrame, col: str) -> list:
    return collect_levels(df, [col])[col]


# ---- out-of-fold (leakage-free) Beta encoding --------------------------------------------------

@dataclass
class BetaFoldState:
    fold_col: str
    priors: dict  # fold -> (alpha0, beta0) of the rows outside the fold
    lookups: dict[str, Lookup] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)


def fit_beta_by_fold(df: DataFrame, target: str, features: dict[str, object], fold_col: str,
                     sample_size: float = 0.8) -> BetaFoldState:
    """Rows of fold f are encoded from the rows outside fold f (expected-bootstrap posterior).

    One aggregation by (feature, level, fold); out-of-fold counts are level totals minus the
    fold's own counts, so the k fits cost a single pass.
    """
    per_fold = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target)).alias("p")).limit(MAX_LEVELS + 1).collect()
    if len(per_fold) > MAX_LEVELS:
        raise ValueError(f"{fold_col} has more than {MAX_LEVELS} folds")
    n_all = sum(r["n"] for r in per_fold)
    p_all = sum(r["p"] or 0 for r in per_fold)
    priors, scales = {}, {}
    for r in per_fold:
        n_out = n_all - r["n"]
        a0 = (p_all - (r["p"] or 0)) / n_out if n_out else 0.0
        priors[r[fold_col]] = (a0, 1.0 - a0)
        scales[r[fold_col]] = int(n_out * sample_size) / n_out if n_out else 0.0
    keys = _keys(features)
    key_cols = sorted({k for ks in keys.values() for k in ks})
    data = df.select(*key_cols, F.col(fold_col).alias("_fold"), F.col(target).alias("_y"))
    structs = [
        F.struct(F.lit(name).alias("_f"),
                 F.when(all_not_null(ks), F.array(*[F.col(k).cast("string") for k in ks])).alias("_k"))
        for name, ks in keys.items()
    ]
    long = data.select("_fold", "_y", F.explode(F.array(*structs)).alias("_s")).select("_fold", "_y", "_s._f", "_s._k")
    cnt = long.where(F.col("_k").isNotNull()).groupBy("_f", "_k", "_fold").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_pos"))
    stats = Lookup.fit(cnt)  # levels x folds rows: size checked before any broadcast
    tot = stats.df.groupBy("_f", "_k").agg(F.sum("_n").alias("_tot_n"), F.sum("_pos").alias("_tot_pos"))
    j = stats.df.join(tot, ["_f", "_k"])
    a0 = F.element_at(F.create_map(*[x for f, (a, _) in priors.items() for x in (F.lit(f), F.lit(a))]), F.col("_fold"))
    sc = F.element_at(F.create_map(*[x for f, s in scales.items() for x in (F.lit(f), F.lit(s))]), F.col("_fold"))
    pos_out = F.col("_tot_pos") - F.col("_pos")
    neg_out = (F.col("_tot_n") - F.col("_n")) - pos_out
    j = j.select("_f", "_k", "_fold", (a0 + sc * pos_out).alias("_a"), ((1 - a0) + sc * neg_out).alias("_b"))
    fitted = Lookup.fit(j)
    st = BetaFoldState(fold_col, priors, {}, keys)
    for name, ks in keys.items():
        sub = fitted.df.where(F.col("_f") == name).select(
            *[F.element_at("_k", i + 1).cast(df.schema[k].dataType).alias(k) for i, k in enumerate(ks)],
            F.col("_fold").alias(fold_col), F.col("_a").alias(f"_a_{name}"), F.col("_b").alias(f"_b_{name}"))
        st.lookups[name] = Lookup(sub, fitted.broadcastable)
    return st


def beta_transform_by_fold(df: DataFrame, st: BetaFoldState, moments=("mean",)) -> DataFrame:
    out = df
    pa = F.create_map(*[x for f, (a, _) in st.priors.items() for x in (F.lit(f), F.lit(a))])
    for name, lk in st.lookups.items():
        out = lk.join(out, st.keys[name] + [st.fold_col], "left")
        a0 = F.element_at(pa, F.col(st.fold_col))
        a = F.coalesce(F.col(f"_a_{name}"), a0)
        b = F.coalesce(F.col(f"_b_{name}"), 1 - a0)
        exprs = {}
        if "mean" in moments:
            exprs[f"{name}__M"] = a / (a + b)
        if "variance" in moments or "var" in moments:
            exprs[f"{name}__V"] = (a * b) / ((a + b) * (a + b) * (a + b + 1))
        out = out.withColumns(exprs).drop(f"_a_{name}", f"_b_{name}")
    return out


@dataclass
class DirichletFoldState:
    fold_col: str
    classes: list
    priors: dict  # fold -> {class: prior of the rows outside the fold}
    lookups: dict[str, Lookup] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)


def fit_dirichlet_by_fold(df: DataFrame, target: str, features: dict[str, object], fold_col: str,
                          sample_size: float = 0.8) -> DirichletFoldState:
    """Rows of fold f are encoded from the rows outside fold f (expected-bootstrap posterior):
    one aggregation by (feature, level, fold); out-of-fold class counts = totals - fold counts."""
    known = df.where(F.col(target).isNotNull())
    for c in (target, fold_col):
        if known.select(c).distinct().limit(MAX_LEVELS + 1).count() > MAX_LEVELS:
            raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
    counts: dict = {}
    for r in known.groupBy(fold_col, target).agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r[fold_col], {})[r[target]] = r["n"]
    tot: dict = {}
    for own in counts.values():
        for k, n in own.items():
            tot[k] = tot.get(k, 0) + n
    classes, folds = sorted(tot), sorted(counts)
    n_all = sum(tot.values())
    priors, scales = {}, {}
    for f in folds:
        n_out = n_all - sum(counts[f].values())
        priors[f] = {k: (tot[k] - counts[f].get(k, 0)) / n_out if n_out else 0.0 for k in classes}
        scales[f] = int(n_out * sample_size) / n_out if n_out else 0.0
    keys = _keys(features)
    key_cols = sorted({k for ks in keys.values() for k in ks})
    data = df.select(*key_cols, F.col(fold_col).alias("_fold"), F.col(target).alias("_y"))
    structs = [
        F.struct(F.lit(name).alias("_f"),
                 F.when(all_not_null(ks), F.array(*[F.col(k).cast("string") for k in ks])).alias("_k"))
        for name, ks in keys.items()
    ]
    long = data.select("_fold", "_y", F.explode(F.array(*structs)).alias("_s")).select("_fold", "_y", "_s._f", "_s._k")
    cnt = long.where(F.col("_k").isNotNull()).groupBy("_f", "_k", "_fold").agg(
        *[F.count_if(F.col("_y") == F.lit(k)).alias(f"_c{i}") for i, k in enumerate(classes)])
    stats = Lookup.fit(cnt)
    totals = stats.df.groupBy("_f", "_k").agg(*[F.sum(f"_c{i}").alias(f"_t{i}") for i in range(len(classes))])
    j = stats.df.join(totals, ["_f", "_k"])

    def fold_map(values: dict):
        return F.create_map(*[x for f, v in values.items() for x in (F.lit(f), F.lit(v))])

    sc = F.element_at(fold_map(scales), F.col("_fold"))
    alphas = [
        (F.element_at(fold_map({f: priors[f][k] for f in folds}), F.col("_fold")) + sc * (F.col(f"_t{i}") - F.col(f"_c{i}")))
        .alias(f"_a{i}")
        for i, k in enumerate(classes)
    ]
    fitted = Lookup.fit(j.select("_f", "_k", "_fold", *alphas))
    st = DirichletFoldState(fold_col, classes, priors, {}, keys)
    for name, ks in keys.items():
        sub = fitted.df.where(F.col("_f") == name).select(
            *[F.element_at("_k", i + 1).cast(df.schema[k].dataType).alias(k) for i, k in enumerate(ks)],
            F.col("_fold").alias(fold_col), *[F.col(f"_a{i}").alias(f"_a{i}_{name}") for i in range(len(classes))])
        st.lookups[name] = Lookup(sub, fitted.broadcastable)
    return st


def dirichlet_transform_by_fold(df: DataFrame, st: DirichletFoldState, drop_last: bool = True) -> DataFrame:
    out = df
    for name, lk in st.lookups.items():
        out = lk.join(out, st.keys[name] + [st.fold_col], "left")
        alphas = []
        for i, k in enumerate(st.classes):
            prior = F.element_at(F.create_map(*[x for f, p in st.priors.items() for x in (F.lit(f), F.lit(p[k]))]),
                                 F.col(st.fold_col))
            alphas.append(F.coalesce(F.col(f"_a{i}_{name}"), prior))
        a0 = alphas[0]
        for a in alphas[1:]:
            a0 = a0 + a
        keep = st.classes[:-1] if drop_last else st.classes
        out = out.withColumns({f"{name}_M_{k}": alphas[i] / a0 for i, k in enumerate(st.classes) if k in keep})
        out = out.drop(*[f"_a{i}_{name}" for i in range(len(st.classes))])
    return out
