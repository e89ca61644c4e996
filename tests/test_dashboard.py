"""Figures on a small frame with hand-computed answers, and missing columns."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lendscape.operators import dashboard, selection


@pytest.fixture(scope="module")
def demo(spark):
    """100 loans without dates and purposes."""
    i = F.col("id")
    return spark.range(100).select(
        F.format_string("LOAN%08d", i + 1).alias("loan_id"),
        F.format_string("CUST%08d", i + 1).alias("customer_id"),
        (100000 + 10000 * i).cast("int").alias("loan_amount"),
        (650 + 2 * i).cast("int").alias("credit_score"),
        F.when(i < 80, 0).when(i < 95, 30).otherwise(90).alias("current_dpd"),
        F.when(i < 85, 0).otherwise(1).alias("is_default"),
        F.when(i < 60, "Low").when(i < 85, "Medium").otherwise("High").alias("risk_category"),
        F.when(i < 70, "Active").when(i < 95, "Closed").otherwise("Written-Off").alias("loan_status"),
    )


def test_key_metrics(demo):
    row = dashboard.key_metrics(demo).first()
    assert (row.total_portfolio_m, row.total_loans, row.default_rate_pct) == (59.5, 100, 15.0)
    assert (row.default_rate_delta, row.avg_dpd, row.high_risk_loans) == (6.5, 9.0, 15)


def test_key_metrics_without_columns(demo):
    row = dashboard.key_metrics(demo.select("loan_amount")).first()
    assert (row.default_rate_pct, row.avg_dpd, row.high_risk_loans, row.total_loans) == (0.0, 0.0, 0, 100)


def test_filter_panel(demo):
    assert selection.portfolio_filter(demo, risk=[], status=None).count() == 100
    assert selection.portfolio_filter(demo, risk=["High"], status=["Closed"]).count() == 10
    assert selection.portfolio_filter(demo, dates=("2020-01-01", "2020-12-31")).count() == 100  # no such column


def test_distribution(demo):
    got = {r.risk_category: (r["count"], r.share) for r in dashboard.risk_distribution(demo).collect()}
    assert got == {"Low": (60, 0.6), "Medium": (25, 0.25), "High": (15, 0.15)}


def test_histogram_drops_current_loans_unless_asked(demo):
    assert [r["count"] for r in dashboard.dpd_histogram(demo).collect()] == [0, 15, 0, 5, 0]
    assert [r["count"] for r in dashboard.dpd_histogram(demo, True).collect()] == [80, 15, 0, 5, 0]


def test_high_risk_list(demo):
    rows = dashboard.high_risk_list(demo).collect()
    assert len(rows) == 15 and rows[0].loan_id == "LOAN00000100" and rows[-1].current_dpd == 30


def test_empty_months(spark):
    rows = [("2020-01-15", 1_000_000, 1), ("2020-01-31", 2_000_000, 0), ("2020-04-01", 3_000_000, 0), (None, 9, 1)]
    df = spark.createDataFrame(rows, "application_date string, loan_amount int, is_default int").withColumn(
        "application_date", F.col("application_date").cast("date")
    )
    d = datetime.date
    assert [tuple(r) for r in dashboard.monthly_volume(df).collect()] == [
        (d(2020, 1, 31), 3.0), (d(2020, 2, 29), 0.0), (d(2020, 3, 31), 0.0), (d(2020, 4, 30), 3.0),
    ]
    assert [r.default_rate_pct for r in dashboard.monthly_default_rate(df).collect()] == [50.0, None, None, 0.0]


def test_months_of_nothing(spark, demo):
    none = demo.limit(0).withColumn("application_date", F.lit("2020-01-01").cast("date"))
    assert dashboard.monthly_volume(none).count() == 0
