"""Score a stream with fitted lookups.

Scoring is stateless: fitted encoder lookups (small, size-checked, broadcast) are joined to
each micro-batch and the model is a column expression, so the same ``score_batch`` works on a
batch DataFrame and on a streaming one. Output goes to any sink; ``foreachBatch`` gives
exactly-once Parquet output keyed by the batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str) -> StreamingQuery:
    """Append scored rows to Parquet; the checkpoint folder must be on shared storage."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # overwrite of a batch-specific folder: a replayed batch rewrites the same output (idempotent)
        scorer(batch).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).start()
