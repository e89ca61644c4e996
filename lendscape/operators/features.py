"""Feature appliers: each takes a loan frame and returns it with columns added."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import features as X
from .group_means import attach_group_means, attach_means

# features only the full profile has
FULL_ONLY = ("credit_experience", "credit_deterioration", "application_day_of_week", "application_season")


def as_date(as_of: datetime.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def engineer_credit_features(df: DataFrame, nulls: str = "zero") -> DataFrame:
    return df.withColumns(X.credit(nulls))


def engineer_loan_features(df: DataFrame) -> DataFrame:
    return df.withColumns(X.loan())


def engineer_repayment_features(df: DataFrame, as_of=None, nulls: str = "zero") -> DataFrame:
    return df.withColumns(X.repayment(as_date(as_of), nulls))


def engineer_demographic_features(df: DataFrame) -> DataFrame:
    return df.withColumns(X.demographic())


def engineer_risk_features(df: DataFrame, nulls: str = "zero") -> DataFrame:
    """Reads ``payment_consistency_score``: apply after the repayment features."""
    return df.withColumns(X.risk_base()).withColumns(X.risk(nulls))


def engineer_time_features(df: DataFrame, as_of=None, vintage: str = "calendar") -> DataFrame:
    return df.withColumns(X.time(as_date(as_of), vintage))


PORTFOLIO_MEANS = {
    "loan_purpose": {"avg_amount_by_purpose": "loan_amount", "avg_dpd_by_purpose": "current_dpd"},
    "city_tier": {"avg_income_by_tier": "monthly_income"},
}


def add_statistical_features(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Means per purpose and per city tier on every row, and the deviation from them.

    Kept ``totals`` save the pass over all rows, see :mod:`lendscape.sources.totals`.
    """
    df = attach_group_means(df, PORTFOLIO_MEANS) if totals is None else attach_means(df, totals, PORTFOLIO_MEANS)
    mean = F.col("avg_amount_by_purpose")
    return df.withColumn("amount_deviation_pct", F.try_divide(F.col("loan_amount") - mean, mean) * 100)


def engineer_row_features(
    df: DataFrame, as_of=None, nulls: str = "zero", vintage: str = "calendar", profile: str = "full"
) -> DataFrame:
    """Every feature that depends on its own row only; works on streams too."""
    df = (
        df.transform(engineer_credit_features, nulls)
        .transform(engineer_loan_features)
        .transform(engineer_repayment_features, as_of, nulls)
        .transform(engineer_demographic_features)
        .transform(engineer_risk_features, nulls)
        .transform(engineer_time_features, as_of, vintage)
    )
    return df.drop(*FULL_ONLY) if profile == "core" else df


def engineer_features(df: DataFrame, as_of=None, **options) -> DataFrame:
    """All features; the stamp column is added by the job that writes them."""
    return df.transform(engineer_row_features, as_of, **options).transform(add_statistical_features)


def stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("feature_engineering_timestamp", F.current_timestamp())
