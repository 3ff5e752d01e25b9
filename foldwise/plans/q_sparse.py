"""Sparse one-hot rows and level counts over columns of many levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators.sparse import fit_sparse_levels, one_hot_sparse, sparse_counts
from foldwise.plans.registry import query
from foldwise.sources.tables import table


def _places_sql(name, table, col, after=None):
    begin = f" + (SELECT count(*) FROM {after})" if after else ""
    return (
        f"{name} AS (SELECT l, row_number() OVER (ORDER BY l) - 1{begin} AS place FROM "
        f"(SELECT DISTINCT CAST({col} AS VARCHAR) AS l FROM {table} WHERE {col} IS NOT NULL))"
    )


@query(
    "one_hot_sparse",
    sql=f"""WITH {_places_sql('a', 'orders', 'o_custkey')}, {_places_sql('b', 'orders', 'o_orderpriority', 'a')}
SELECT o_orderkey AS ID, CAST((SELECT count(*) FROM a) + (SELECT count(*) FROM b) AS INTEGER) AS width,
  concat_ws(',', a.place, b.place) AS indices
FROM orders LEFT JOIN a ON CAST(o_custkey AS VARCHAR) = a.l LEFT JOIN b ON o_orderpriority = b.l""",
)
def q_one_hot_sparse(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("ID"), "o_custkey", "o_orderpriority")
    found = one_hot_sparse(orders, fit_sparse_levels(orders, ["o_custkey", "o_orderpriority"]))
    return found.select("ID", F.col("one_hot.size").alias("width"), F.array_join("one_hot.indices", ",").alias("indices"))


@query(
    "pivot_counts_sparse",
    sql=f"""WITH {_places_sql('a', 'lineitem', 'l_partkey')}, {_places_sql('b', 'lineitem', 'l_returnflag', 'a')},
n AS (SELECT l_orderkey AS ID, place, count(*) AS n FROM lineitem JOIN a ON CAST(l_partkey AS VARCHAR) = a.l GROUP BY ALL
  UNION ALL SELECT l_orderkey, place, count(*) FROM lineitem JOIN b ON l_returnflag = b.l GROUP BY ALL)
SELECT ID, CAST((SELECT count(*) FROM a) + (SELECT count(*) FROM b) AS INTEGER) AS width,
  string_agg(place, ',' ORDER BY place) AS indices, string_agg(n, ',' ORDER BY place) AS counts
FROM n GROUP BY ID""",
)
def q_pivot_counts_sparse(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ID"), "l_partkey", "l_returnflag")
    st = fit_sparse_levels(lines, ["l_partkey", "l_returnflag"], clean=True)
    found = sparse_counts(lines, "ID", st)
    return found.select(
        "ID", F.col("counts.size").alias("width"),
        F.array_join("counts.indices", ",").alias("indices"), F.array_join("counts.values", ",").alias("counts"),
    )
