"""Hyper-parameter search over model families, guided by past trials (M8).

The first trials are random. After that the finished ones are split into the best quarter and the rest. The next
family and its parameters are the candidate, of a few drawn from the density of the best, whose ratio of that
density to the density of the rest is largest (a tree-structured Parzen estimator). A parameter belongs to its
family and is judged by that family's trials alone. Proposal t depends on (seed, t, trials before t), so a seed
gives the same trials again, and a search that broke off goes on where it was.

Objectives are minimised. A trial without a finite objective counts as the worst. Equal objectives are ordered by trial.
Training and scoring are Spark jobs; the driver holds the trial table only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from statistics import NormalDist

import numpy as np
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import metrics as M
from foldwise.operators import models as ML
from foldwise.operators.boost import macro_f1_of
from foldwise.operators.models import Space
from foldwise.operators.trees import binned
from foldwise.sources.sinks import append_log

STARTUP, GOOD, DRAWS, AT_ONCE = 5, 0.25, 24, 5
TRIALS = "seed long, trial int, family string, params string, scores array<double>, rows array<long>, score_mean double, objective double"


@dataclass
class Choice:
    name: str
    options: list


@dataclass
class Trial:
    number: int
    family: str
    params: dict
    objective: float
    scores: list
    rows: list


def _unit(s: Space, value: float) -> float:
    """Where a value lies in its range, 0 to 1."""
    low, high, value = (math.log(x) for x in (s.low, s.high, value)) if s.log else (s.low, s.high, value)
    return min(1.0, max(0.0, (value - low) / (high - low))) if high > low else 0.0


def _value(s: Space, u: float):
    v = math.exp(math.log(s.low) + u * (math.log(s.high) - math.log(s.low))) if s.log else s.low + u * (s.high - s.low)
    v = min(s.high, max(s.low, v))
    return int(round(v)) if s.integer else v


class _Density:
    """Parzen density on 0 to 1: a normal of its own width at each point, and a broad one; all cut off at 0 and 1."""

    def __init__(self, points: list[float]):
        at = sorted(points)
        edges = [0.0, *at, 1.0]
        narrow = 1.0 / min(100, len(at) + 2)
        widths = [min(1.0, max(narrow, edges[i + 1] - edges[i], edges[i + 2] - edges[i + 1])) for i in range(len(at))]
        self.parts = [NormalDist(m, s) for m, s in zip([*at, 0.5], [*widths, 1.0], strict=True)]
        self.inside = [(d.cdf(0.0), d.cdf(1.0)) for d in self.parts]

    def draw(self, rng) -> float:
        k = int(rng.integers(len(self.parts)))
        a, b = self.inside[k]
        p = a + float(rng.random()) * (b - a)
        return min(1.0, max(0.0, self.parts[k].inv_cdf(min(max(p, 1e-12), 1 - 1e-12))))

    def log(self, u: float) -> float:
        return math.log(sum(d.pdf(u) / (b - a) for d, (a, b) in zip(self.parts, self.inside, strict=True)) / len(self.parts))


class _Shares:
    """Shares of a choice's options among trials, each option counted once more."""

    def __init__(self, options: list, seen: list):
        n = np.array([1.0 + sum(x == o for x in seen) for o in options])
        self.shares = n / n.sum()

    def draw(self, rng) -> int:
        return int(rng.choice(len(self.shares), p=self.shares))

    def log(self, i: int) -> float:
        return math.log(self.shares[i])


def _guide(dim, trials: list[dict]):
    seen = [t[dim.name] for t in trials]
    return _Shares(dim.options, seen) if isinstance(dim, Choice) else _Density([_unit(dim, x) for x in seen])


def _picked(dims: list, good: list[dict], rest: list[dict], rng, draws: int) -> dict:
    """The draw from the good trials' density that stands out most against the rest's."""
    below, above = [_guide(d, good) for d in dims], [_guide(d, rest) for d in dims]
    best = None
    for _ in range(draws):
        at = [g.draw(rng) for g in below]
        gain = sum(g.log(x) - r.log(x) for g, r, x in zip(below, above, at, strict=True))
        if best is None or gain > best[0]:
            best = gain, at
    return {d.name: d.options[x] if isinstance(d, Choice) else _value(d, x) for d, x in zip(dims, best[1], strict=True)}


def propose(families: dict[str, list], past: list[Trial], number: int, seed: int = 42, startup: int = STARTUP) -> tuple[str, dict]:
    """Family and parameters of trial ``number``. ``families``: the dimensions (``Space`` or ``Choice``) of each family."""
    rng = np.random.default_rng([seed, number])
    family = Choice("family", list(families))
    if len(past) < startup:
        name = _picked([family], [], [], rng, 1)["family"]
        return name, _picked(families[name], [], [], rng, 1)
    order = sorted(past, key=lambda t: (t.objective if math.isfinite(t.objective) else math.inf, t.number))
    cut = math.ceil(GOOD * len(order))
    good, rest = order[:cut], order[cut:]
    name = _picked([family], [{"family": t.family} for t in good], [{"family": t.family} for t in rest], rng, DRAWS)["family"]
    own = [[t.params for t in side if t.family == name] for side in (good, rest)]
    return name, _picked(families[name], *own, rng, DRAWS)


def guided_search(evaluate: Callable, families: dict[str, list], n_trials: int = 10, seed: int = 42, startup: int = STARTUP,
                  past: list[Trial] = (), done: Callable | None = None, at_once: int = 1) -> list[Trial]:
    """Trials up to ``n_trials``, the ``past`` ones included. ``evaluate(family, params)`` gives (objective, score of
    each fold, rows of each fold); ``done(trial)`` is called after each new one, in order. The random trials of the start do
    not look at others: ``at_once`` of them are evaluated together, with the same proposals and the same table."""
    trials = sorted(past, key=lambda t: t.number)[:n_trials]

    def run(number: int) -> Trial:
        family, params = propose(families, trials[:number], number, seed, startup)
        objective, scores, rows = evaluate(family, params)
        return Trial(number, family, params, objective, list(scores), list(rows))

    def add(trial: Trial):
        trials.append(trial)
        if done:
            done(trial)

    first = range(len(trials), min(startup, n_trials)) if at_once > 1 else ()
    if first:
        with ThreadPool(min(at_once, len(first))) as pool:
            for trial in pool.imap(run, first, 1):
                add(trial)
    for number in range(len(trials), n_trials):
        add(run(number))
    return trials


def search_models(df: DataFrame, id_col: str, features: list[str], label: str, fold_col: str, k: int, families: dict[str, list],
                  n_trials: int = 10, seed: int = 42, n_classes: int = 2, fixed: dict[str, dict] | None = None,
                  path: str | None = None, startup: int = STARTUP) -> DataFrame:
    """Trial table: family ("logreg", "rf", "gbt"), parameters (JSON, Spark's names), score and rows of each fold's out-of-fold
    predictions, their mean and the objective (minus the mean). The score is AUC for two classes, macro F1 for more
    (there "gbt" is one model a class). A fold with one class has no AUC and does not count in the mean. ``fixed``: parameters
    of a family that are not searched.

    With ``path`` each finished trial is appended to a table there, and a later call with the same seed goes on
    after its unbroken run of trials; the caller keeps one folder for one search space."""
    spark, fixed = df.sparkSession, fixed or {}
    data = ML._training_frame(df, id_col, features, label, fold_col, None).persist(StorageLevel.MEMORY_AND_DISK)
    data.count()  # fills the cache once, before trials and folds run together
    bins = binned(data, label, fold_col, k, seed) if n_classes == 2 and {"rf", "gbt"} & set(families) else None

    def evaluate(family: str, params: dict):
        params = {**fixed.get(family, {}), **params}
        if n_classes > 2 and family == "gbt":
            oof = ML.train_ovr_gbt_oof(df, id_col, features, label, n_classes, fold_col, k, params)
        else:
            oof, _ = ML._oof_of(data, id_col, label, fold_col, k, family, params, bins=bins)
        scores, rows = _binary_scores(oof, label, fold_col) if n_classes == 2 else _class_scores(oof, label, fold_col, n_classes)
        known = [s for s in scores.values() if s is not None]
        objective = -sum(known) / len(known) if known else math.nan
        return objective, [scores.get(f) for f in range(k)], [rows.get(f, 0) for f in range(k)]

    past = saved_trials(spark, path, seed) if path else []
    trials = guided_search(evaluate, families, n_trials, seed, startup, past, (lambda t: append_log(_table(spark, [t], seed), path)) if path else None, at_once=AT_ONCE)
    data.unpersist()
    if bins is not None:
        bins.unpersist()
    return _table(spark, trials, seed)


def _binary_scores(oof: DataFrame, label: str, fold_col: str) -> tuple[dict, dict]:
    found = M.grouped_auc(oof.withColumn("p1", F.col("probs")[1]), [fold_col], "p1", label, "_rows" if "_rows" in oof.columns else None).collect()  # a row for each fold
    return {r[fold_col]: r["auc"] for r in found}, {r[fold_col]: r["n_pos"] + r["n_neg"] for r in found}


def _class_scores(oof: DataFrame, label: str, fold_col: str, n_classes: int) -> tuple[dict, dict]:
    pred = F.array_position("probs", F.array_max("probs")).cast("int") - 1
    found = oof.groupBy(fold_col, F.col(label).cast("int").alias("y"), pred.alias("p")).count().collect()  # folds x classes x classes
    counts = {}
    for f, y, p, n in found:
        counts.setdefault(f, {})[y, p] = n
    return {f: macro_f1_of(c, n_classes) for f, c in counts.items()}, {f: sum(c.values()) for f, c in counts.items()}


def _table(spark, trials: list[Trial], seed: int) -> DataFrame:
    rows = [(seed, t.number, t.family, json.dumps(t.params, sort_keys=True), t.scores, t.rows, -t.objective, t.objective) for t in trials]
    return spark.createDataFrame(rows, TRIALS)


def saved_trials(spark, path: str, seed: int) -> list[Trial]:
    """Trials 0, 1, ... of this seed as far as they are all there; a trial written twice counts once."""
    try:
        rows = spark.read.schema(TRIALS).parquet(path).where(F.col("seed") == seed).collect()  # a row for each trial
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    found = {r["trial"]: Trial(r["trial"], r["family"], json.loads(r["params"]), r["objective"], r["scores"], r["rows"]) for r in rows}
    out = []
    while len(out) in found:
        out.append(found[len(out)])
    return out
