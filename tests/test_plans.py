"""Plan checks: no Python in deterministic plans, pruned scans, pushed filters, one aggregate."""

import pytest

import __spark_entry__ as entry
from foldwise.plans import ORACLE
from tests.conftest import SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")
# exact AUC / ROC use an Arrow-batched running sum per sorted range partition
ALLOWED_PY = {"metric_auc", "metric_auc_ovr", "roc_curve", "metrics_by_fold", "metrics_report"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


entry.queries()  # registers all

CROSS_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_python_and_no_cross_join_in_plan(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    if name not in ALLOWED_PY:
        assert not any(n in plan for n in PY_NODES), name
    assert not any(n in plan for n in CROSS_NODES), name


def test_child_summary_is_one_partial_aggregate(spark):
    plan = _plan(entry.queries()["child_summary"](spark, SMALL))
    assert plan.count("HashAggregate") == 2  # partial + final: one shuffle for all statistics
    assert "SortMergeJoin" not in plan


def test_scan_is_pruned(spark):
    df = entry.queries()["log1p_transform"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_filter_pushed_to_scan(spark):
    from foldwise.sources.tables import table
    from pyspark.sql import functions as F

    df = table(spark, SMALL, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in _plan(df)
