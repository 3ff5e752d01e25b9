"""Row-level feature functions (F1-F7, F10): ratios, loan arithmetic, bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: bin edges used by the binary-target pipeline -----------------------
PREMIUM_EDGES = [0, 1000, 5000, 10000, 20000, 25000, 30000, 100000]
AGE_EDGES = [0, 20, 30, 40, 50, 60, 100]


def safe_div(a: Column, b: Column) -> Column:
    """x / 0 -> NULL (Spark runs ANSI: plain '/' would raise)."""
    return F.try_divide(a, b)


def ratio_features(premium: Column, upper: Column, lower: Column) -> dict[str, Column]:
    return {
        "premium_to_age1": safe_div(premium, upper),
        "premium_to_age2": safe_div(premium, lower),
        "duration": upper - lower,
        "age_dist": safe_div(upper - lower, lower),
    }


def loan_features(emi: Column, income: Column, tenure: Column, disbursal: Column,
                  asset: Column, finance: Column) -> dict[str, Column]:
    """13 loan/demography features; ``income`` is expected already log1p-transformed."""
    total_pay = emi * tenure
    total_income = income * tenure
    return {
        "monthly_surplus": emi - income,
        "EMI_to_income_ratio": safe_div(emi, income),
        "Total_amount_to_pay": total_pay,
        "Total_income_within_loan": total_income,
        "Interest_amount": total_pay - disbursal,
        "Residual_amount": total_income - total_pay,
        "Asset_to_total_income": safe_div(asset, total_income),
        "Asset_to_monthly_income": safe_div(asset, income),
        "pay_to_loan_ratio": safe_div(total_pay, disbursal),
        "Finance_to_disbursed_ratio": safe_div(disbursal, finance),
        "finance_leverage_money": asset - finance,
        "finance_leverage_ratio": safe_div(asset, finance),
        "processing_fees": finance - disbursal,
    }


def bin_code(x: Column, edges: list[float]) -> Column:
    """Right-closed bin index: k where edges[k] < x <= edges[k+1]; outside -> NULL."""
    expr = None
    for k in range(len(edges) - 1):
        cond = (x > F.lit(edges[k])) & (x <= F.lit(edges[k + 1]))
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr


def bin_dummies(x: Column, name: str, edges: list[float]) -> dict[str, Column]:
    """One-hot of the bin code over kept codes 1..len(edges)-3, first kept code dropped.

    Codes outside the kept range (and NULL) give all zeros.
    """
    code = bin_code(x, edges)
    return {f"{name}__{k}": F.coalesce((code == k).cast("int"), F.lit(0)) for k in range(2, len(edges) - 2)}


def combine_key(cols: list[str]) -> Column:
    """'a_b' string key; NULL parts become 'nan' like a pandas str cast."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols])
