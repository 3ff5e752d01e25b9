"""Sources, projection, cleaning, type conversion (S1, P1-P12) and simple fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions.dates import date_parts
from foldwise.functions.text import clean_category, clean_numeric
from foldwise.operators import clean as C
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query
from foldwise.sources.tables import TABLES, table

CLEAN = r"regexp_replace({c}, '[^\p{{L}}\p{{N}}_]+', '_', 'g')"

# test binding of the value-map operator (the reference's own 7-entry map is C.PAYMENT_MODE_MAP)
PRIORITY_MAP = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "4-NOT SPECIFIED": "UNKNOWN"}


@query("scan_limit", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000")
def q_scan_limit(spark, d):
    # the row cap is the feature here (the reference's nrows); a key order makes it deterministic
    return round_doubles(table(spark, d, "orders").orderBy("o_orderkey").limit(1000))


_SHAPE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS n_cols FROM {t}"
    for t in TABLES
)


@query("table_shape", sql=_SHAPE_SQL)
def q_table_shape(spark, d):
    parts = []
    for t in TABLES:
        df = table(spark, d, t)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(t).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("extract_columns", sql=f"SELECT ID, o_totalprice, c_mktsegment FROM {ENTITY_SQL}")
def q_extract(spark, d):
    return C.extract_columns(entity(spark, d), ["ID", "o_totalprice", "c_mktsegment"])


@query("drop_columns", sql="SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def q_drop(spark, d):
    return C.drop_columns(table(spark, d, "orders"), ["o_orderdate", "o_orderpriority"])


_MAP_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_MAP.items()) + " ELSE o_orderpriority END"


@query("recode_values", sql=f"SELECT o_orderkey, {_MAP_SQL} AS priority_recoded FROM orders")
def q_recode(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", C.recode(F.col("o_orderpriority"), PRIORITY_MAP).alias("priority_recoded"))


_SIZE_TEXT = "CASE WHEN p_size > 40 THEN '40+' WHEN p_size < 5 THEN NULL ELSE CAST(p_size AS VARCHAR) END"


@query(
    "recode_censored",
    sql=f"SELECT p_partkey, size_text, coalesce(CASE WHEN size_text = '40+' THEN 41.0 ELSE TRY_CAST(size_text AS DOUBLE) END, 0.0) AS size_value "
    f"FROM (SELECT p_partkey, {_SIZE_TEXT} AS size_text FROM part)",
)
def q_recode_censored(spark, d):
    p = table(spark, d, "part")
    size_text = F.when(F.col("p_size") > 40, F.lit("40+")).when(F.col("p_size") < 5, F.lit(None)).otherwise(
        F.col("p_size").cast("string")
    )
    p = p.select("p_partkey", size_text.alias("size_text"))
    return p.withColumn("size_value", C.recode_censored(F.col("size_text"), "40+", 41, 0.0))


@query("log1p_transform", sql="SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS o_totalprice_log1p FROM orders")
def q_log1p(spark, d):
    o = table(spark, d, "orders")
    return round_doubles(o.select("o_orderkey", F.log1p("o_totalprice").alias("o_totalprice_log1p")))


@query(
    "type_conversion",
    sql="""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS INTEGER) AS p_size,
  round(CAST(p_retailprice AS DOUBLE), 6) AS p_retailprice,
  CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size <= 25) THEN p_brand END AS p_brand,
  CASE WHEN p_type IN (SELECT p_type FROM part WHERE p_size <= 25) THEN p_type END AS p_type
  FROM part""",
)
def q_type_conversion(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand", "p_type")
    levels = C.fit_levels(p.where(F.col("p_size") <= 25), ["p_brand", "p_type"])
    return round_doubles(
        C.type_conversion(p, levels, double_cols=["p_retailprice"], int_cols=["p_size"], string_cols=["p_partkey"])
    )


@query(
    "clean_category",
    sql=f"SELECT p_partkey, {CLEAN.format(c='p_type')} AS p_type, {CLEAN.format(c='p_name')} AS p_name, "
    f"{CLEAN.format(c='p_brand')} AS p_brand FROM part",
)
def q_clean_category(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", *[clean_category(F.col(c)).alias(c) for c in ["p_type", "p_name", "p_brand"]])


@query(
    "clean_numeric",
    sql=r"""SELECT event_id, props,
  coalesce(TRY_CAST(regexp_replace(props, '[^0-9.\-]', '', 'g') AS DOUBLE), 0.0) AS props_value,
  coalesce(TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS DOUBLE), 0.0) AS props_digits
  FROM events""",
)
def q_clean_numeric(spark, d):
    ev = table(spark, d, "events")
    return ev.select(
        "event_id", "props",
        clean_numeric(F.col("props")).alias("props_value"),
        clean_numeric(F.col("props"), digits_only=True).alias("props_digits"),
    )


@query(
    "feature_union",
    sql="""SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS price_log1p,
  CAST(dayofmonth(o_orderdate) AS INTEGER) AS od_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS od_weekday, CAST(month(o_orderdate) AS INTEGER) AS od_month,
  CAST(year(o_orderdate) AS INTEGER) AS od_year, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_final FROM orders""",
)
def q_feature_union(spark, d):
    o = table(spark, d, "orders")
    parts = [
        {"price_log1p": F.log1p("o_totalprice")},
        date_parts(F.col("o_orderdate"), "od"),
        {"is_final": (F.col("o_orderstatus") == "F").cast("int")},
    ]
    out = C.feature_union(o, parts)
    return round_doubles(out.select("o_orderkey", "price_log1p", "od_day", "od_weekday", "od_month", "od_year", "is_final"))


_MODE_SQL = f"""(SELECT priority_m FROM {ENTITY_SQL} WHERE priority_m IS NOT NULL
  GROUP BY priority_m ORDER BY count(*) DESC, priority_m LIMIT 1)"""


@query("impute_mode", sql=f"SELECT ID, priority_m, coalesce(priority_m, {_MODE_SQL}) AS priority_filled FROM {ENTITY_SQL}")
def q_impute_mode(spark, d):
    e = entity(spark, d, ["ID", "priority_m"])
    mode = C.mode_value(e, "priority_m")
    return e.withColumn("priority_filled", F.coalesce(F.col("priority_m"), F.lit(mode)))


@query(
    "impute_constant",
    sql=f"SELECT ID, coalesce(priority_m, 'no_policy') AS priority_m, round(coalesce(acctbal_m, 0.0), 6) AS acctbal_m FROM {ENTITY_SQL}",
)
def q_impute_constant(spark, d):
    e = entity(spark, d, ["ID", "priority_m", "acctbal_m"])
    return round_doubles(C.fill(e, {"priority_m": "no_policy", "acctbal_m": 0.0}))


@query(
    "impute_mean",
    sql=f"SELECT ID, round(coalesce(acctbal_m, (SELECT avg(acctbal_m) FROM {ENTITY_SQL})), 6) AS acctbal_m FROM {ENTITY_SQL}",
)
def q_impute_mean(spark, d):
    e = entity(spark, d, ["ID", "acctbal_m"])
    return round_doubles(C.fill(e, C.fit_means(e, ["acctbal_m"])))


@query(
    "impute_date",
    sql="SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END, "
    "TIMESTAMP '2020-12-31') AS o_orderdate FROM orders",
)
def q_impute_date(spark, d):
    o = table(spark, d, "orders")
    o = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderdate")).alias("o_orderdate"))
    return C.fill_dates(o, ["o_orderdate"], C.REFERENCE_DATE)
