"""Pricing, repayment and label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .binning import lookup


def _clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def emi(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Amortised monthly instalment, truncated; a zero rate spreads the principal evenly."""
    rate = annual_rate / F.lit(1200)
    growth = F.pow(F.lit(1) + rate, months)
    priced = principal * rate * growth / F.nullif(growth - F.lit(1), F.lit(0.0))
    return F.floor(F.when(annual_rate == 0, F.try_divide(principal, months)).otherwise(priced)).cast("int")


def interest_rate(score: Column) -> Column:
    points = F.lit(V.BASE_RATE) + (F.lit(V.BASE_SCORE) - score) / F.lit(V.SCORE_POINTS_PER_PERCENT)
    return F.round(_clip(points, V.RATE_MIN, V.RATE_MAX), 2)


def dpd_probability(score: Column) -> Column:
    return _clip((F.lit(V.BASE_SCORE) - score) / F.lit(V.DPD_PROBABILITY_SPAN), 0.0, 1.0)


def max_dpd(current: Column, observed: Column) -> Column:
    return F.greatest(current, observed)


def is_default(dpd: Column, status: Column) -> Column:
    bad = (dpd > V.DEFAULT_DPD) | (status == V.WRITTEN_OFF)
    return F.when(bad, 1).otherwise(0)


def risk_category(default: Column, dpd: Column, score: Column, late: Column) -> Column:
    watch = (dpd > V.WATCH_DPD) | (score < V.WATCH_SCORE) | (late > V.WATCH_LATE)
    return F.when(default == 1, "High").when(watch, "Medium").otherwise("Low")


def estimated_lgd(default: Column, severity: Column) -> Column:
    """Loss share of a default; ``severity`` in [0, 1) spreads it over the fixed range."""
    low, high = V.LGD_RANGE
    return F.when(default == 1, F.round(F.lit(low) + severity * F.lit(high - low), 2)).otherwise(F.lit(0.0))


def loan_to_income(amount: Column, income: Column) -> Column:
    return F.round(F.try_divide(amount.cast("double"), income.cast("bigint") * 12), 2)


def debt_to_income(instalment: Column, existing: Column, income: Column) -> Column:
    return F.round(F.try_divide((instalment.cast("bigint") + existing).cast("double"), income), 2)


def income_multiplier(employment: Column) -> Column:
    return lookup(employment, V.INCOME_MULTIPLIER)


def disbursed_on(application: Column, days: Column) -> Column:
    return F.date_add(application, days.cast("int"))
