"""Row-level features (F1-F7) bound to part / lineitem / orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions.dates import date_parts, months_30d, months_30d_or_zero
from foldwise.operators import features as FT
from foldwise.plans.bindings import round_doubles
from foldwise.plans.registry import query
from foldwise.sources.tables import table


def _div(a, b):
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"


@query(
    "ratio_features",
    sql=f"""SELECT p_partkey, round({_div('p_retailprice', 'p_size')}, 6) AS premium_to_age1,
  round({_div('p_retailprice', 'p_size - 10')}, 6) AS premium_to_age2,
  p_size - (p_size - 10) AS duration,
  round({_div('p_size - (p_size - 10)', 'p_size - 10')}, 6) AS age_dist FROM part""",
)
def q_ratio(spark, d):
    p = table(spark, d, "part")
    upper, lower = F.col("p_size"), F.col("p_size") - 10
    feats = FT.ratio_features(F.col("p_retailprice"), upper, lower)
    return round_doubles(p.select("p_partkey", *[c.alias(n) for n, c in feats.items()]))


# loan binding on lineitem: EMI = net price per unit, income = log1p(price), tenure = quantity,
# disbursal = net price, asset = price with tax, finance = gross price
_LOAN_BASE = """(SELECT l_orderkey, l_linenumber, l_partkey,
  l_extendedprice * (1 - l_discount) / l_quantity AS emi, ln(1 + l_extendedprice) AS income, l_quantity AS tenure,
  l_extendedprice * (1 - l_discount) AS disbursal, l_extendedprice * (1 + l_tax) AS asset, l_extendedprice AS finance
  FROM lineitem)"""
_LOAN_SQL = {
    "monthly_surplus": "emi - income",
    "EMI_to_income_ratio": _div("emi", "income"),
    "Total_amount_to_pay": "emi * tenure",
    "Total_income_within_loan": "income * tenure",
    "Interest_amount": "emi * tenure - disbursal",
    "Residual_amount": "income * tenure - emi * tenure",
    "Asset_to_total_income": _div("asset", "income * tenure"),
    "Asset_to_monthly_income": _div("asset", "income"),
    "pay_to_loan_ratio": _div("emi * tenure", "disbursal"),
    "Finance_to_disbursed_ratio": _div("disbursal", "finance"),
    "finance_leverage_money": "asset - finance",
    "finance_leverage_ratio": _div("asset", "finance"),
    "processing_fees": "finance - disbursal",
}


@query(
    "loan_features",
    sql="SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"round({e}, 6) AS {n}" for n, e in _LOAN_SQL.items())
    + f" FROM {_LOAN_BASE}",
)
def q_loan(spark, d):
    li = table(spark, d, "lineitem")
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    feats = FT.loan_features(
        emi=price * (1 - disc) / F.col("l_quantity"),
        income=F.log1p(price),
        tenure=F.col("l_quantity"),
        disbursal=price * (1 - disc),
        asset=price * (1 + F.col("l_tax")),
        finance=price,
    )
    return round_doubles(li.select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(n) for n, c in feats.items()]))


def _bins_sql(x, name, edges):
    out = []
    for k in range(2, len(edges) - 2):
        out.append(f"CASE WHEN {x} > {edges[k]} AND {x} <= {edges[k + 1]} THEN 1 ELSE 0 END AS {name}__{k}")
    return ", ".join(out)


@query(
    "bin_features",
    sql=f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, "
    f"{_bins_sql('l_quantity', 'Upper_Age', FT.AGE_EDGES)}, {_bins_sql('l_extendedprice', 'Reco_Policy_Premium', FT.PREMIUM_EDGES)} "
    f"FROM lineitem",
)
def q_bins(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    feats = {**FT.bin_dummies(F.col("l_quantity"), "Upper_Age", FT.AGE_EDGES),
             **FT.bin_dummies(F.col("l_extendedprice"), "Reco_Policy_Premium", FT.PREMIUM_EDGES)}
    return round_doubles(li.withColumns(feats))


@query(
    "date_parts",
    sql="SELECT o_orderkey, CAST(dayofmonth(o_orderdate) AS INTEGER) AS o_orderdate_day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_weekday, "
    "CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year FROM orders",
)
def q_date_parts(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in date_parts(F.col("o_orderdate"), "o_orderdate").items()])


@query(
    "months_between_30d",
    sql="""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
  round((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 2.592e12, 6) AS ship_months,
  round(coalesce((epoch_us(l.l_shipdate) - epoch_us(CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderdate END)) / 2.592e12, 0.0), 6) AS ship_months_or_zero
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
)
def q_months(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    od_m = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderdate"))
    return round_doubles(
        j.select(
            "l_orderkey", "l_linenumber", "l_partkey",
            months_30d(F.col("l_shipdate"), F.col("o_orderdate")).alias("ship_months"),
            months_30d_or_zero(F.col("l_shipdate"), od_m).alias("ship_months_or_zero"),
        )
    )
