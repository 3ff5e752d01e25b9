"""Query registry: name -> Spark query (spark, sf_dir) -> DataFrame, and its oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROWS_ONLY: set[str] = set()

MODULES = (
    "q_child", "q_clean", "q_encode", "q_features", "q_stats", "q_split",
    "q_quantile", "q_metrics", "q_scoring", "q_models", "q_flows", "q_knn", "q_pipelines", "q_sparse",
)


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        else:
            ROWS_ONLY.add(name)
        return fn

    return deco


_loaded = False


def load_all() -> None:
    global _loaded
    if _loaded:
        return
    for m in MODULES:
        try:
            importlib.import_module(f"foldwise.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"foldwise.plans.{m}":
                raise
    _loaded = True
