"""The batch scorer runs unchanged on a streaming DataFrame."""

import os
import tempfile

from pyspark.sql import functions as F

from foldwise.plans.bindings import entity
from foldwise.plans.q_scoring import fit_scorer, score_batch
from foldwise.streaming.score import read_stream, score_stream
from tests.conftest import SMALL


def test_stream_scores_equal_batch_scores(spark):
    e = entity(spark, SMALL)
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    st = fit_scorer(e.where(cut))
    new = e.where(~cut)
    scratch = tempfile.mkdtemp(prefix="fw-stream-", dir="/tmp")
    src = os.path.join(scratch, "in")
    new.write.parquet(src)
    q = score_stream(read_stream(spark, src, new.schema), lambda b: score_batch(b, st),
                     os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    q.processAllAvailable()
    q.stop()
    streamed = spark.read.parquet(os.path.join(scratch, "out", "*")).orderBy("ID").collect()
    batch = score_batch(new, st).orderBy("ID").collect()
    assert [tuple(r) for r in streamed] == [tuple(r) for r in batch]


def test_fitted_binary_flow_runs_on_a_stream(spark):
    from foldwise.plans.q_flows import BIN_CATS, QCOLS, apply_binary_flow, fit_binary_flow

    e = entity(spark, SMALL).select("ID", "target", *BIN_CATS, "acctbal_m", *QCOLS, "o_orderdate")
    cut = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp")
    st = fit_binary_flow(e.where(cut).drop("o_orderdate"))
    new = e.where(~cut).drop("o_orderdate", "target")
    scratch = tempfile.mkdtemp(prefix="fw-flow-", dir="/tmp")
    src = os.path.join(scratch, "in")
    new.write.parquet(src)
    q = score_stream(read_stream(spark, src, new.schema), lambda b: apply_binary_flow(b, st),
                     os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    q.processAllAvailable()
    q.stop()
    streamed = spark.read.parquet(os.path.join(scratch, "out", "*"))
    batch = apply_binary_flow(new, st)
    cols = sorted(batch.columns)
    assert sorted(streamed.columns) == cols
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
