"""Binding of the reference's concepts to the driver's tables.

Every binding is a lazy DataFrame over the given Parquet tables (so its work grows with the
tables) and has a SQL twin used by the DuckDB oracle.

* entity (one row per ID): orders LEFT JOIN customer LEFT JOIN nation, ID = o_orderkey.
  Two derived columns carry NULLs (the tables have none): ``priority_m`` and ``acctbal_m``.
* child history (many rows per ID): lineitem, one row per line. Each line also carries two
  comma-separated history strings built from its own fields, so history parsing is a per-row
  expression and never needs a per-entity list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.sources.tables import table

BINARY_TARGET = "target"       # o_orderstatus = 'F'
MULTI_TARGET = "o_orderpriority"


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round float/double columns for the oracle value hash (query layer only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


ORDERS_COLS = {"ID", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
               BINARY_TARGET, "priority_m"}
CUSTOMER_COLS = {"c_acctbal", "c_mktsegment", "acctbal_m"}
NATION_COLS = {"n_name"}


def entity(spark: SparkSession, d: str, cols: list[str] | None = None) -> DataFrame:
    """The entity table; with ``cols`` only the joins those columns need are planned.

    customer and nation keys are unique, so a LEFT JOIN never changes the row set: when no
    customer / nation column is requested the join is skipped (Catalyst cannot drop it by
    itself without a uniqueness constraint, and at scale it is a sort-merge join of the two
    largest entity tables).
    """
    wanted = set(cols) if cols is not None else ORDERS_COLS | CUSTOMER_COLS | NATION_COLS
    o = table(spark, d, "orders")
    e = o
    if wanted & (CUSTOMER_COLS | NATION_COLS):
        c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        e = e.join(c, o.o_custkey == c.c_custkey, "left")
        if wanted & NATION_COLS:
            # nation has 25 rows by definition of the schema: a proven broadcast bound
            n = F.broadcast(table(spark, d, "nation").select("n_nationkey", "n_name"))
            e = e.join(n, F.col("c_nationkey") == n.n_nationkey, "left")
    exprs = {
        "ID": F.col("o_orderkey").alias("ID"),
        BINARY_TARGET: F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias(BINARY_TARGET),
        "priority_m": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority_m"),
        "acctbal_m": F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("acctbal_m"),
    }
    order = ["ID", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
             "c_acctbal", "c_mktsegment", "n_name", BINARY_TARGET, "priority_m", "acctbal_m"]
    names = order if cols is None else list(cols)
    return e.select(*[exprs.get(c, F.col(c)) for c in names])


ENTITY_SQL = """(SELECT o.o_orderkey AS ID, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
  o.o_orderpriority, c.c_acctbal, c.c_mktsegment, n.n_name,
  CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
  NULLIF(o.o_orderpriority, '4-NOT SPECIFIED') AS priority_m,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS acctbal_m
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def child(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    qty = F.col("l_quantity")
    amt_hist = F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit(None)).otherwise(
        F.concat_ws(
            ",",
            F.when(qty >= 5, qty.cast("bigint").cast("string")).otherwise(F.lit("")),
            F.floor("l_extendedprice").cast("bigint").cast("string"),
            F.lit(""),
        )
    )
    ship = F.col("l_shipdate")
    date_hist = F.when(qty < 3, F.lit(None)).otherwise(
        F.concat_ws(
            ",",
            F.date_format(F.date_sub(ship, 31), "yyyyMMdd"),
            F.lit(""),
            F.date_format(F.date_sub(ship, F.col("l_linenumber") * 45), "yyyyMMdd"),
            F.col("l_linenumber").cast("string"),
        )
    )
    return li.select(
        F.col("l_orderkey").alias("ID"),
        "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("self_indicator"),
        "l_returnflag", "l_linestatus",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        amt_hist.alias("amt_hist"),
        date_hist.alias("date_hist"),
    )


CHILD_SQL = """(SELECT l_orderkey AS ID, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS self_indicator,
  l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate,
  CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE
    concat_ws(',', CASE WHEN l_quantity >= 5 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE '' END,
              CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR), '') END AS amt_hist,
  CASE WHEN l_quantity < 3 THEN NULL ELSE
    concat_ws(',', strftime(CAST(l_shipdate AS DATE) - 31, '%Y%m%d'), '',
              strftime(CAST(l_shipdate AS DATE) - l_linenumber * 45, '%Y%m%d'),
              CAST(l_linenumber AS VARCHAR)) END AS date_hist
  FROM lineitem)"""
