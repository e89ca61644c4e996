from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lendscape.operators import features, portfolio, quality
from lendscape.operators.features import FULL_ONLY
from lendscape.schema import LOAN_COLUMNS, LOAN_SCHEMA
from lendscape.sources.derived_loans import AS_OF


def test_column_counts(book):
    assert len(features.engineer_features(book, AS_OF).columns) == 32 + 33 + 4
    core = features.engineer_features(book, AS_OF, profile="core")
    assert len(core.columns) == 32 + 33 and not set(FULL_ONLY) & set(core.columns)


def test_all_null_row_does_not_fail(spark):
    empty = spark.createDataFrame([(None,) * 32], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOAN_SCHEMA))
    row = features.engineer_row_features(empty, AS_OF).first()
    assert row.credit_score_bucket == "Very Poor" and row.utilization_category == "High"
    assert row.has_existing_loans == 0 and row.high_delinquency_risk == 0 and row.early_warning_flag == 0
    assert row.dpd_category == "DPD-90+" and row.age_group == "55+" and row.application_season == "Winter"
    assert row.combined_risk_score is None and row.pd_proxy is None and row.family_size is None
    kept = features.engineer_row_features(empty, AS_OF, nulls="keep").first()
    assert kept.has_existing_loans is None and kept.early_warning_flag is None


def test_zero_income_gives_null(book):
    df = book.withColumn("monthly_income", F.lit(0)).transform(features.engineer_loan_features)
    row = df.select("loan_to_annual_income", "emi_burden_pct", "total_debt_burden").first()
    assert list(row) == [None, None, None]


def test_wide_numbers_do_not_overflow(book):
    big = book.withColumns({n: F.lit(2_000_000_000) for n in ("emi_amount", "existing_emi", "monthly_income")})
    df = features.engineer_row_features(big.withColumn("total_payments_made", F.lit(300)), AS_OF)
    assert df.select(F.min("total_debt_burden"), F.min("loan_to_annual_income")).first()[0] == 200.0
    assert df.select("expected_loss_amount").count() == book.count()


def test_group_averages_equal_the_window(book):
    holed = book.withColumn("loan_purpose", F.when(F.col("loan_purpose") != "Auto", F.col("loan_purpose")))
    w = Window.partitionBy("loan_purpose")
    expected = holed.select("loan_id", F.avg("loan_amount").over(w).alias("a"), F.avg("current_dpd").over(w).alias("d"))
    got = features.add_statistical_features(holed).select("loan_id", "avg_amount_by_purpose", "avg_dpd_by_purpose")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_rows_are_not_shuffled_for_averages(book):
    plan = features.add_statistical_features(book)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "Window" not in plan


def test_today_is_the_default(book):
    row = features.engineer_time_features(book).select(F.max("loan_vintage_months")).first()
    assert row[0] > 12 * 20


def test_quality_report_on_empty_frame(spark):
    report = quality.run_quality_checks(spark.createDataFrame([], LOAN_SCHEMA), AS_OF).collect()
    assert len(report) == 8 and all(r.passed for r in report)
    assert quality.quality_passed(quality.run_quality_checks(spark.createDataFrame([], LOAN_SCHEMA), AS_OF))


def test_quality_is_one_pass(book):
    plan = quality.run_quality_checks(book, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_buckets_add_up(book):
    counts = portfolio.count_by(features.engineer_credit_features(book), "credit_score_bucket")
    assert counts.agg(F.sum("count")).first()[0] == book.count()


def test_validate_features(book):
    df = features.engineer_row_features(book, AS_OF)
    rows = quality.validate_features(df).collect()
    numeric = {f"invalid:{n}" for n, t in df.dtypes if t in ("int", "bigint", "double", "float") or t.startswith("decimal")}
    assert {r["check"] for r in rows if r["check"].startswith("invalid:")} == numeric and len(numeric) > 20
    nulls = {r["check"]: r["rows"] for r in rows}
    assert nulls["null:credit_score_bucket"] == 0 and nulls["null:combined_risk_score"] > 0


def test_infinite_values_are_an_option(spark):
    df = spark.createDataFrame([(float("inf"), 1), (float("nan"), None)], "a double, b int")
    plain = {r.feature: r.invalid_count for r in quality.invalid_numbers(df).collect()}
    strict = {r.feature: r.invalid_count for r in quality.invalid_numbers(df, infinite=True).collect()}
    assert plain == {"a": 1, "b": 1} and strict == {"a": 2, "b": 1}


def test_schema_order():
    assert LOAN_COLUMNS[0] == "customer_id" and LOAN_COLUMNS[-1] == "dti_ratio" and len(LOAN_COLUMNS) == 32
