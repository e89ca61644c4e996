"""Dashboard figures as queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.binning import edge_bin, fixed_width_bin
from ..session import keep
from .selection import existing_columns, head_rows, high_risk


def key_metrics(df: DataFrame) -> DataFrame:
    """One row: volume in millions, loans, default rate and its delta to target, DPD, high-risk count.

    A column the frame lacks counts as zero in its figure.
    """
    has = set(df.columns)
    rate = F.avg("is_default") * 100 if "is_default" in has else F.lit(0.0)
    dpd = F.avg("current_dpd") if "current_dpd" in has else F.lit(0.0)
    high = F.count_if(F.col("risk_category") == V.HIGH_RISK) if "risk_category" in has else F.lit(0)
    return df.agg(
        (F.coalesce(F.sum("loan_amount"), F.lit(0)) / 1e6).alias("total_portfolio_m"),
        F.count(F.lit(1)).alias("total_loans"),
        rate.alias("default_rate_pct"),
        (rate - V.TARGET_DEFAULT_RATE).alias("default_rate_delta"),
        dpd.alias("avg_dpd"),
        high.cast("bigint").alias("high_risk_loans"),
    )


def risk_distribution(df: DataFrame) -> DataFrame:
    """Loans per risk category with their share of the total."""
    counts = df.where(F.col("risk_category").isNotNull()).groupBy("risk_category").count()
    counts = keep(counts, "risk-counts")  # counted once, used for the rows and for the total
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def _with_empty(counts: DataFrame, labels: Sequence[str], column: str) -> DataFrame:
    """Counts by bin number for every label, zero where no row fell."""
    names = F.array(*[F.lit(label) for label in labels])
    spine = counts.sparkSession.range(1, len(labels) + 1).select(
        F.col("id").cast("int").alias("bin"), F.element_at(names, F.col("id").cast("int")).alias(column)
    )
    return (
        spine.join(counts, "bin", "left")
        .select("bin", column, F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("bin")
    )


def dpd_histogram(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Loans per DPD interval, right-closed.

    As charted, a DPD of exactly 0 lies outside the first interval and is not
    counted; ``include_lowest`` counts it as current.
    """
    number = edge_bin("current_dpd", V.DPD_EDGES, include_lowest)
    counts = df.select(number.alias("bin")).where("bin IS NOT NULL").groupBy("bin").count()
    return _with_empty(counts, V.DPD_EDGE_LABELS, "dpd_bucket")


def score_histogram(df: DataFrame, bins: int = V.SCORE_BINS) -> DataFrame:
    """Loans per equal credit-score interval over the score range."""
    low, high = V.SCORE_FLOOR, V.SCORE_CEILING
    number = fixed_width_bin("credit_score", low, high, bins)
    width = (high - low) / bins
    return (
        df.select(number.alias("bin"))
        .where("bin IS NOT NULL")
        .groupBy("bin")
        .count()
        .withColumn("bin_start", F.lit(float(low)) + F.col("bin") * F.lit(width))
        .orderBy("bin")
    )


def _by_month(df: DataFrame, date: str, **figures) -> DataFrame:
    """Aggregates per month-end between the first and last month, empty months included."""
    months = keep(
        df.where(F.col(date).isNotNull())
        .groupBy(F.last_day(date).alias("month_end"))
        .agg(*[figure.alias(name) for name, figure in figures.items()]),
        "months",
    )
    span = months.agg(
        F.sequence(
            F.trunc(F.min("month_end"), "month"), F.trunc(F.max("month_end"), "month"), F.expr("INTERVAL 1 MONTH")
        ).alias("starts")
    )
    spine = span.select(F.explode("starts").alias("start")).select(F.last_day("start").alias("month_end"))
    return spine.join(months, "month_end", "left")


def monthly_volume(df: DataFrame, date: str = "application_date") -> DataFrame:
    """Lent volume in millions per month; an empty month is 0."""
    rows = _by_month(df, date, total=F.sum("loan_amount"))
    return rows.select("month_end", (F.coalesce("total", F.lit(0)) / 1e6).alias("volume_m")).orderBy("month_end")


def monthly_default_rate(df: DataFrame, date: str = "application_date") -> DataFrame:
    """Default rate in percent per month next to the target; an empty month is NULL."""
    rows = _by_month(df, date, rate=F.avg("is_default"))
    return rows.select(
        "month_end",
        (F.col("rate") * 100).alias("default_rate_pct"),
        F.lit(V.TARGET_DEFAULT_RATE).alias("target_pct"),
    ).orderBy("month_end")


def amount_by_purpose(df: DataFrame) -> DataFrame:
    """Lent volume in millions per purpose, smallest first."""
    return (
        df.where(F.col("loan_purpose").isNotNull())
        .groupBy("loan_purpose")
        .agg((F.coalesce(F.sum("loan_amount"), F.lit(0)) / 1e6).alias("amount_m"))
        .orderBy("amount_m", "loan_purpose")
    )


def high_risk_list(df: DataFrame, rows: int = V.HIGH_RISK_ROWS) -> DataFrame:
    """The worst high-risk loans: most days past due, then largest."""
    shown = existing_columns(high_risk(df), V.HIGH_RISK_COLUMNS)
    return head_rows(shown, [F.desc("current_dpd"), F.desc("loan_amount"), F.col("loan_id")], rows)


def high_risk_file_name(day) -> str:
    return f"high_risk_loans_{day:%Y%m%d}.csv"
