"""Sinks: feature/fold tables, prediction tables, metric logs and fitted lookups.

Writes are plain DataFrame writes so they are retried per task by Spark and land atomically
through the committer. Fold tables are partitioned by ``kfold`` so a fold split is a
partition-pruned read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_folds(df: DataFrame, path: str, fold_col: str = "kfold", fmt: str = "parquet") -> None:
    df.write.mode("overwrite").partitionBy(fold_col).format(fmt).option("header", True).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).option("header", True).save(path)


def append_log(df: DataFrame, path: str) -> None:
    """Metric / trial log: one appended Parquet batch per call."""
    df.write.mode("append").parquet(path)


def save_lookup(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
