"""Child-history summaries (A1-A4), entity join (J1) and history parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions.history import history_date_gap, history_sum
from foldwise.operators.child import attach, child_summary, fit_child_levels
from foldwise.plans.bindings import CHILD_SQL, ENTITY_SQL, child, entity, round_doubles
from foldwise.plans.registry import query

CHILD_CATS = ["l_returnflag", "l_linestatus"]
CHILD_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# (column, levels) known for the test tables; the Spark side fits them from the data
SQL_LEVELS = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]}
CLEAN_SQL = r"regexp_replace({c}, '[^\p{{L}}\p{{N}}_]+', '_', 'g')"


def _child_with_sums(spark, d):
    return child(spark, d).withColumn("amt_hist_sum", history_sum(F.col("amt_hist")))


def _sum_sql():
    return "CAST(coalesce(sum(self_indicator), 0) AS BIGINT) AS self_indicator"


def _pivot_sql():
    out = []
    for c, lv in SQL_LEVELS.items():
        for level in lv:
            out.append(f"CAST(count_if({CLEAN_SQL.format(c=c)} = '{level}') AS BIGINT) AS {c}__{level}")
    return ",\n  ".join(out)


def _mean_std_sql(cols):
    out = []
    for c in cols:
        out.append(f"round(coalesce(avg({c}), 0.0), 6) AS {c}__mean")
        out.append(f"round(coalesce(stddev_samp({c}), 0.0), 6) AS {c}__std")
    return ",\n  ".join(out)


HIST_SUM_SQL = (
    "list_sum(list_transform(string_split(coalesce(amt_hist, ',,,'), ','), "
    "lambda x: coalesce(TRY_CAST(x AS DOUBLE), 0.0)))"
)
CHILD_WITH_SUMS_SQL = f"(SELECT *, {HIST_SUM_SQL} AS amt_hist_sum FROM {CHILD_SQL})"
SUMMARY_NUMS = CHILD_NUMS + ["amt_hist_sum"]


@query("child_sum", sql=f"SELECT ID, {_sum_sql()} FROM {CHILD_SQL} GROUP BY ID")
def q_child_sum(spark, d):
    return child_summary(child(spark, d), "ID", sum_cols=["self_indicator"])


@query("child_pivot_counts", sql=f"SELECT ID, {_pivot_sql()} FROM {CHILD_SQL} GROUP BY ID")
def q_child_pivot_counts(spark, d):
    ch = child(spark, d)
    return child_summary(ch, "ID", levels=fit_child_levels(ch, CHILD_CATS))


@query("child_mean_std", sql=f"SELECT ID, {_mean_std_sql(SUMMARY_NUMS)} FROM {CHILD_WITH_SUMS_SQL} GROUP BY ID")
def q_child_mean_std(spark, d):
    return round_doubles(child_summary(_child_with_sums(spark, d), "ID", num_cols=SUMMARY_NUMS))


SUMMARY_SQL = (
    f"SELECT ID, {_sum_sql()},\n  {_pivot_sql()},\n  {_mean_std_sql(SUMMARY_NUMS)}\n"
    f"FROM {CHILD_WITH_SUMS_SQL} GROUP BY ID"
)


def summary(spark, d):
    ch = _child_with_sums(spark, d)
    return child_summary(
        ch, "ID", sum_cols=["self_indicator"], levels=fit_child_levels(ch, CHILD_CATS), num_cols=SUMMARY_NUMS
    )


@query("child_summary", sql=SUMMARY_SQL)
def q_child_summary(spark, d):
    return round_doubles(summary(spark, d))


@query(
    "entity_child_join",
    sql=f"SELECT e.ID, e.o_orderstatus, e.o_totalprice, s.* EXCLUDE (ID) FROM {ENTITY_SQL} e "
    f"LEFT JOIN ({SUMMARY_SQL}) s ON e.ID = s.ID",
)
def q_entity_child_join(spark, d):
    e = entity(spark, d, ["ID", "o_orderstatus", "o_totalprice"])
    return round_doubles(attach(e, summary(spark, d), "ID"))


@query("history_sum", sql=f"SELECT ID, l_linenumber, amt_hist, round({HIST_SUM_SQL}, 6) AS amt_hist_sum FROM {CHILD_SQL}")
def q_history_sum(spark, d):
    return round_doubles(
        child(spark, d).select("ID", "l_linenumber", "amt_hist", history_sum(F.col("amt_hist")).alias("amt_hist_sum"))
    )


_GAPS_SQL = (
    "list_transform(list_filter(string_split(date_hist, ','), lambda x: length(x) = 8), "
    "lambda x: try_strptime(x, '%Y%m%d'))"
)
HIST_GAP_SQL = f"""CASE WHEN l_shipdate IS NULL OR date_hist IS NULL THEN 0.0
  WHEN list_bool_or(list_transform({_GAPS_SQL}, lambda t: t IS NULL)) THEN 0.0
  WHEN len({_GAPS_SQL}) = 0 THEN NULL
  ELSE list_avg(list_transform({_GAPS_SQL}, lambda t: (epoch_us(l_shipdate) - epoch_us(t)) / 2.592e12)) END"""


@query("history_date_gap", sql=f"SELECT ID, l_linenumber, date_hist, round({HIST_GAP_SQL}, 6) AS date_gap_mean FROM {CHILD_SQL}")
def q_history_date_gap(spark, d):
    ch = child(spark, d)
    return round_doubles(
        ch.select("ID", "l_linenumber", "date_hist",
                  history_date_gap(F.col("l_shipdate"), F.col("date_hist")).alias("date_gap_mean"))
    )
