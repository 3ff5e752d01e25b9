"""Table scans.

Parquet is the default source: Catalyst prunes columns and pushes filters into the scan.
CSV is supported with an explicit schema (never ``inferSchema`` on large inputs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema, limit: int | None = None) -> DataFrame:
    """CSV scan with a fixed schema and an optional row cap (the reference's ``nrows``)."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.limit(limit) if limit is not None else df
