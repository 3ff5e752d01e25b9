"""Session helpers.

Library code never creates its own session; it receives one. ``local_session``
exists for tests and the bench. ``checkpoint_dir`` reads the cluster's shared
``spark.checkpoint.dir``; without it a ``local[...]`` master, where driver and tasks
are one process, gets a fresh scratch folder, and any other master is refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_ENV = "FOLDWISE_SCRATCH"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "foldwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = os.environ.get(SCRATCH_ENV) or tempfile.mkdtemp(prefix="foldwise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Written once to the shared folder as Parquet and read back: unlike those of a checkpoint, its readers take only
    the columns they need. Columns are kept by place, as names may hold what files refuse or clash but for case."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    plain.write.parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)
