"""Derived loan features.

``FEATURES`` maps each feature to a function giving its column. Groups list the
features in output order; within a group a later one may read an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .binning import ladder, lookup

c = F.col


def tier(name: str) -> Column:
    return ladder(*V.LADDERS[name])


def flag(condition: Column, nulls: str = "zero") -> Column:
    """1/0 flag. ``nulls='keep'`` leaves an undecidable condition NULL instead of 0."""
    if nulls == "keep":
        return condition.cast("int")
    return F.when(condition, 1).otherwise(0)


def percent(part: Column, whole: Column) -> Column:
    """Share of ``whole`` in percent, NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def dpd_category() -> Column:
    return F.when(c("current_dpd") == 0, V.DPD_CURRENT).otherwise(ladder(*V.DPD_LADDER))


def combined_risk_score() -> Column:
    """Weighted score, not clamped; NULL if any input is."""
    w = V.RISK_WEIGHTS
    return (
        (100 - ((c("credit_score") - V.SCORE_FLOOR) / V.SCORE_STEP)) * w["score"]
        + (c("current_dpd") / V.DPD_FULL_SCALE * 100) * w["dpd"]
        + (c("dti_ratio") * 100) * w["dti"]
        + (c("late_payments_12m") * 10) * w["late"]
    )


def season() -> Column:
    month = F.month("application_date")
    labels = [F.when(month.isin(*months), name) for name, months in V.SEASONS.items()]
    return F.coalesce(*labels, F.lit(V.SEASON_OTHER))


def vintage(as_of: Column, method: str = "calendar") -> Column:
    """Months since disbursement: calendar months, or whole 30-day periods."""
    if method == "days30":
        return (F.datediff(as_of, c("disbursement_date")) / 30).cast("int")
    return F.months_between(as_of, c("disbursement_date")).cast("int")


def credit(nulls: str = "zero") -> dict[str, Column]:
    return {
        "credit_score_bucket": tier("credit_score_bucket"),
        "credit_history_years": (c("credit_history_months") / 12).cast("double"),
        "utilization_category": tier("utilization_category"),
        "has_existing_loans": flag(c("existing_loans") > 0, nulls),
        "credit_experience": tier("credit_experience"),
    }


def loan() -> dict[str, Column]:
    income = c("monthly_income")
    return {
        "loan_to_annual_income": F.try_divide(c("loan_amount").cast("double"), income.cast("bigint") * 12),
        "emi_burden_pct": percent(c("emi_amount"), income),
        "total_debt_burden": percent(c("emi_amount").cast("bigint") + c("existing_emi"), income),
        "loan_term_category": tier("loan_term_category"),
        "interest_rate_bucket": tier("interest_rate_bucket"),
        "loan_amount_bucket": tier("loan_amount_bucket"),
    }


def repayment(as_of: Column, nulls: str = "zero") -> dict[str, Column]:
    return {
        "dpd_category": dpd_category(),
        "payment_consistency_score": c("payment_history_pct") * 100 - c("late_payments_12m") * 5,
        "high_delinquency_risk": flag((c("late_payments_12m") >= 3) | (c("max_dpd_12m") > 60), nulls),
        "days_since_disbursement": F.datediff(as_of, c("disbursement_date")),
        "loan_maturity_pct": percent(c("total_payments_made"), c("loan_term_months")),
        "payment_behavior_score": (100 - c("current_dpd")) * c("payment_history_pct"),
    }


def demographic() -> dict[str, Column]:
    members = c("dependents") + F.when(c("marital_status") == "Married", 2).otherwise(1)
    return {
        "age_group": tier("age_group"),
        "income_bracket": tier("income_bracket"),
        "family_size": members,
        "per_capita_income": F.try_divide(c("monthly_income").cast("double"), members),
        "employment_stability_score": lookup(
            "employment_type", V.EMPLOYMENT_STABILITY, V.EMPLOYMENT_STABILITY_OTHER
        ),
    }


def risk_base() -> dict[str, Column]:
    return {"combined_risk_score": combined_risk_score()}


def risk(nulls: str = "zero") -> dict[str, Column]:
    """Needs ``combined_risk_score`` and ``payment_consistency_score``."""
    paid = c("emi_amount").cast("bigint") * c("total_payments_made")
    pd = (c("combined_risk_score") / 100).cast("double")
    warning = (
        (c("current_dpd") > 0) | (c("late_payments_12m") >= 2) | (c("payment_consistency_score") < 70)
    )
    worsened = (c("max_dpd_12m") > c("current_dpd")) & (c("max_dpd_12m") > 30)
    return {
        "pd_proxy": pd,
        "expected_loss_amount": pd * c("estimated_lgd") * (c("loan_amount") - paid),
        "early_warning_flag": flag(warning, nulls),
        "credit_deterioration": flag(worsened, "zero"),
    }


def time(as_of: Column, vintage_method: str = "calendar") -> dict[str, Column]:
    applied = c("application_date")
    return {
        "application_year": F.year(applied),
        "application_month": F.month(applied),
        "application_quarter": F.quarter(applied),
        "application_day_of_week": F.dayofweek(applied),
        "loan_vintage_months": vintage(as_of, vintage_method),
        "application_season": season(),
    }
