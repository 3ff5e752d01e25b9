"""Group statistics, correlation, windows-as-aggregates and data profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions.hashing import uniform, uniform_sql
from foldwise.operators import stats as S
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query
from foldwise.sources.tables import table

GROUP_SPECS = {
    "a": (["c_mktsegment"], {"n_name": ["nunique", "count"], "priority_m": ["nunique", "count"],
                              "o_totalprice": ["sum", "max", "min", "mean"], "acctbal_m": ["mean", "max"]}),
    "b": (["c_mktsegment", "n_name"], {"priority_m": ["nunique", "count"],
                                        "o_totalprice": ["sum", "max", "min", "mean"], "acctbal_m": ["mean", "max"]}),
    "c": (["n_name", "o_orderstatus"], {"n_name": ["nunique", "count"], "priority_m": ["size", "nunique"],
                                         "o_totalprice": ["sum", "max", "min", "mean"]}),
    "d": (["c_mktsegment", "o_orderstatus", "o_orderpriority"], {
        "n_name": ["size", "nunique"], "o_orderpriority": ["size", "nunique"], "acctbal_m": ["mean", "max"],
        "o_totalprice": ["sum", "max", "min", "mean"]}),
}
_SQL_AGG = {
    "nunique": "CAST(count(DISTINCT {c}) AS BIGINT)",
    "count": "CAST(count({c}) AS BIGINT)",
    "size": "CAST(count(*) AS BIGINT)",
    "mean": "round(favg({c}), 6)",
    "max": "round(max({c}), 6)",
    "min": "round(min({c}), 6)",
    "sum": "round(coalesce(sum({c}), 0), 6)",
}


def _group_sql(letter):
    keys, spec = GROUP_SPECS[letter]
    prefix = letter.upper()
    aggs = ", ".join(f"{_SQL_AGG[f].format(c=c)} AS {prefix}_{c}_{f}" for c, fs in spec.items() for f in fs)
    kl = ", ".join(keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    on = " AND ".join(f"e.{k} = g.{k}" for k in keys)
    return (
        f"SELECT e.ID, g.* EXCLUDE ({kl}) FROM {ENTITY_SQL} e LEFT JOIN "
        f"(SELECT {kl}, {aggs} FROM {ENTITY_SQL} WHERE {nn} GROUP BY {kl}) g ON {on}"
    )


def _group_query(letter):
    def run(spark, d):
        keys, spec = GROUP_SPECS[letter]
        e = entity(spark, d)
        out = S.join_group_stats(e, keys, spec, letter.upper())
        stat_cols = [f"{letter.upper()}_{c}_{f}" for c, fs in spec.items() for f in fs]
        return round_doubles(out.select("ID", *stat_cols))

    return run


for _l in GROUP_SPECS:
    query(f"group_stats_{_l}", sql=_group_sql(_l))(_group_query(_l))

PROFILE_COLS = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name", "priority_m", "acctbal_m", "o_custkey"]


@query(
    "profile_nunique",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS nunique FROM {ENTITY_SQL}" for c in PROFILE_COLS
    ),
)
def q_nunique(spark, d):
    return S.profile_nunique(entity(spark, d), PROFILE_COLS)


@query(
    "profile_missing",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing, "
        f"round(count_if({c} IS NULL) / count(*), 6) AS share_missing FROM {ENTITY_SQL}" for c in PROFILE_COLS
    ),
)
def q_missing(spark, d):
    return round_doubles(S.profile_missing(entity(spark, d), PROFILE_COLS))


@query(
    "class_priors",
    sql="SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS prior "
    "FROM orders GROUP BY o_orderpriority",
)
def q_priors(spark, d):
    o = table(spark, d, "orders")
    n = o.count()
    vc = S.value_counts(o, "o_orderpriority").withColumnRenamed("count", "n")
    return round_doubles(vc.withColumn("prior", F.col("n") / F.lit(float(n))))


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price", "tax_amount"]
_CORR_BASE = "(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * (1 - l_discount) AS net_price, l_extendedprice * l_tax AS tax_amount FROM lineitem)"
_CORR_SQL = " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, '{CORR_COLS[i]}' AS col_i, '{CORR_COLS[j]}' AS col_j, corr({CORR_COLS[i]}, {CORR_COLS[j]}) AS r FROM {_CORR_BASE}"
    for i in range(len(CORR_COLS)) for j in range(i + 1, len(CORR_COLS))
)


def _corr(spark, d):
    li = table(spark, d, "lineitem")
    li = li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                   (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
                   (F.col("l_extendedprice") * F.col("l_tax")).alias("tax_amount"))
    return S.correlation_long(li, CORR_COLS)


@query("correlation_matrix", sql=f"SELECT i, j, col_i, col_j, round(r, 6) AS r FROM ({_CORR_SQL})")
def q_corr(spark, d):
    return round_doubles(_corr(spark, d))


@query("correlated_to_drop", sql=f"SELECT j, col_j, round(max(r), 6) AS max_r FROM ({_CORR_SQL}) WHERE r > 0.93 GROUP BY j, col_j")
def q_corr_drop(spark, d):
    return round_doubles(S.correlated_to_drop(_corr(spark, d), 0.93))


def _win_sql(keys, prefix):
    part = ", ".join(keys)
    return (
        f"SELECT event_id, {', '.join(keys)}, round(max(value) OVER (PARTITION BY {part}), 6) AS {prefix}_value_max, "
        f"round(min(value) OVER (PARTITION BY {part}), 6) AS {prefix}_value_min, "
        f"round(avg(value) OVER (PARTITION BY {part}), 6) AS {prefix}_value_mean, "
        f"round(stddev_samp(value) OVER (PARTITION BY {part}), 6) AS {prefix}_value_std FROM events"
    )


def _win(spark, d, keys, prefix):
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    names = {f: f"{prefix}_value_{f}" for f in ["max", "min", "mean", "std"]}
    out = S.group_transform(ev, keys, "value", ["max", "min", "mean", "std"], names)
    return round_doubles(out.select("event_id", *keys, *names.values()))


@query("window_group_stats", sql=_win_sql(["user_id"], "user"))
def q_win1(spark, d):
    return _win(spark, d, ["user_id"], "user")


@query("window_group_stats_2key", sql=_win_sql(["user_id", "event_type"], "user_type"))
def q_win2(spark, d):
    return _win(spark, d, ["user_id", "event_type"], "user_type")


@query("value_counts", sql="SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY event_type")
def q_value_counts(spark, d):
    return S.value_counts(table(spark, d, "events"), "event_type")


@query(
    "topn_categories",
    sql=f"SELECT n_name, CAST(count(*) AS BIGINT) AS count FROM {ENTITY_SQL} GROUP BY n_name ORDER BY count DESC, n_name LIMIT 20",
)
def q_topn(spark, d):
    # a top-k report: the limit is the feature
    return S.value_counts(entity(spark, d), "n_name").orderBy(F.desc("count"), "n_name").limit(20)


@query(
    "histogram",
    sql="""WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
  b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, lo, hi FROM orders, mm)
  SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS bin_hi,
  CAST(count(*) AS BIGINT) AS count FROM b GROUP BY bin, lo, hi""",
)
def q_hist(spark, d):
    return round_doubles(S.histogram(table(spark, d, "orders"), "o_totalprice", 50))


BOX_KEYS = ["o_orderstatus", "c_mktsegment"]


@query(
    "box_stats",
    sql=f"""WITH e AS (SELECT * FROM {ENTITY_SQL} WHERE o_totalprice IS NOT NULL),
  q AS (SELECT o_orderstatus, c_mktsegment, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
        quantile_cont(o_totalprice, 0.75) AS q3 FROM e GROUP BY ALL)
  SELECT q.o_orderstatus, q.c_mktsegment, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    CAST(count(*) AS BIGINT) AS n,
    round(min(CASE WHEN o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN o_totalprice END), 6) AS whisker_lo,
    round(max(CASE WHEN o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN o_totalprice END), 6) AS whisker_hi,
    CAST(count_if(NOT (o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS BIGINT) AS n_outliers
  FROM e JOIN q ON e.o_orderstatus = q.o_orderstatus AND e.c_mktsegment = q.c_mktsegment
  GROUP BY q.o_orderstatus, q.c_mktsegment, q1, median, q3""",
)
def q_box(spark, d):
    return round_doubles(S.box_stats(entity(spark, d), BOX_KEYS, "o_totalprice"))


@query(
    "crosstab",
    sql=f"""SELECT c_mktsegment, CAST(count_if(target = 0) AS BIGINT) AS "0", CAST(count_if(target = 1) AS BIGINT) AS "1"
  FROM {ENTITY_SQL} GROUP BY c_mktsegment""",
)
def q_crosstab(spark, d):
    e = entity(spark, d)
    return S.crosstab(e, "c_mktsegment", "target", [0, 1])


@query(
    "null_patterns",
    sql=f"""SELECT concat(CASE WHEN priority_m IS NULL THEN '1' ELSE '0' END, CASE WHEN acctbal_m IS NULL THEN '1' ELSE '0' END) AS pattern,
  CAST(count(*) AS BIGINT) AS count FROM {ENTITY_SQL} GROUP BY 1""",
)
def q_null_patterns(spark, d):
    return S.null_patterns(entity(spark, d), ["priority_m", "acctbal_m"])


@query(
    "scatter_sample",
    sql=f"SELECT ID, round(o_totalprice, 6) AS x, round(c_acctbal, 6) AS y, o_orderstatus AS hue FROM {ENTITY_SQL} "
    f"WHERE {uniform_sql('ID', seed=7)} < 0.2",
)
def q_scatter(spark, d):
    # a sampling operator: the hashed sample is the feature (deterministic, seed 7, 20 %)
    e = entity(spark, d)
    s = e.where(uniform(F.col("ID"), seed=7) < 0.2)
    return round_doubles(s.select("ID", F.col("o_totalprice").alias("x"), F.col("c_acctbal").alias("y"), F.col("o_orderstatus").alias("hue")))
