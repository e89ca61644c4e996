"""Registered queries: each takes (spark, sf_dir) and returns a frame.

All of them read the whole tables in ``sf_dir``. Averages and sums of fractions
are rounded, because their last digits depend on the order of addition.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import lending
from ..functions.keys import padded_key, record_hash
from ..operators import dashboard, encoding, evaluation, features, modelling, portfolio, quality, selection, versions
from ..operators.group_means import group_means, join_lookup
from ..schema import LOAN_COLUMNS
from ..session import discard, keep, new_path, tune
from ..sources import files, tables
from ..sources.derived_loans import AS_OF, dirty_loans, loan_number, loans, loans_from, second_batch, table
from ..streaming import ingest as stream_ingest
from ..streaming import metrics as stream_metrics
from . import gold
from .silver import read_silver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
c = F.col


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf: fn(tune(spark), sf)
    return fn


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(c(n), digits) for n in names})


def featured(spark, sf):
    return loans(spark, sf).transform(features.engineer_row_features, AS_OF)


def scored(spark, sf):
    """Deterministic scores with label and decision, for the evaluation queries."""
    return (
        featured(spark, sf)
        .where(c("combined_risk_score").isNotNull())
        .select(
            "loan_id",
            "is_default",
            c("combined_risk_score").alias("score"),
            c("pd_proxy").alias("probability"),
            F.when(c("combined_risk_score") >= 60, 1).otherwise(0).alias("prediction"),
        )
    )


def bronze_frame(df: DataFrame, at: str) -> DataFrame:
    return files.with_audit(df, LOAN_COLUMNS, at=at, origin="derived")


def merged_bronze(spark, sf) -> DataFrame:
    """Two deliveries, the second sent twice, in a bronze table."""
    path = new_path(spark, "bronze")
    first = loans(spark, sf)
    tables.write_to_bronze(bronze_frame(first, "2001-12-30"), path)
    later = bronze_frame(second_batch(first), "2001-12-31")
    tables.write_to_bronze(later, path)
    tables.write_to_bronze(later, path)
    return tables.read_bronze(spark, path)


# ---- flagship ---------------------------------------------------------------


@query
def segment_risk_profile(spark, sf):
    df = portfolio.segment_profile(featured(spark, sf), "credit_score_bucket", "loan_purpose")
    return rounded(df, "default_rate", "avg_risk_score", "expected_loss", digits=3)


# ---- sources and tables -----------------------------------------------------


@query
def s01_csv_scan(spark, sf):
    path = new_path(spark, "loans-csv")
    files.write_csv(loans(spark, sf), path)
    return files.split_corrupt(files.read_csv(spark, path))[0]


@query
def s02_typed_loans(spark, sf):
    return loans(spark, sf)


@query
def s03_table_scan(spark, sf):
    path = new_path(spark, "loans")
    tables.overwrite_table(loans(spark, sf), path)
    return tables.read_table(spark, path)


@query
def s04_partitioned_scan(spark, sf):
    path = new_path(spark, "loans-by-status")
    tables.overwrite_table(loans(spark, sf), path, V.BRONZE_PARTITIONS)
    return files.in_source_order(files.read_parquet(spark, path))


@query
def s06_audit_columns(spark, sf):
    """The stamps differ by run; the query reports that they are set."""
    path = new_path(spark, "loans-csv")
    files.write_csv(loans(spark, sf), path)
    df = files.read_source_data(spark, path)
    return df.select(
        "loan_id",
        c("ingestion_timestamp").isNotNull().alias("has_timestamp"),
        (F.length("source_file") > 0).alias("has_file"),
        "record_hash",
    )


@query
def s07_record_hash(spark, sf):
    return loans(spark, sf).select(
        "loan_id",
        record_hash(LOAN_COLUMNS).alias("record_hash"),
        record_hash(LOAN_COLUMNS, null_safe=True).alias("null_safe_hash"),
    )


@query
def s08_record_key(spark, sf):
    return files.with_record_key(dirty_loans(loans(spark, sf))).select("customer_id", "loan_id", "record_key")


@query
def s09_bronze_create(spark, sf):
    path = new_path(spark, "bronze")
    tables.write_to_bronze(bronze_frame(loans(spark, sf), "2001-12-30"), path)
    return tables.read_bronze(spark, path).groupBy("loan_status").agg(
        F.count(F.lit(1)).alias("loans"), F.count_distinct("record_hash").alias("hashes")
    )


@query
def s10_bronze_merge(spark, sf):
    return merged_bronze(spark, sf).select("loan_id", "loan_status", "current_dpd", "record_hash")


@query
def s10_bucketed_merge(spark, sf):
    """The same deliveries into buckets: the target is never shuffled."""
    path = new_path(spark, "bronze")
    name = f"bronze_{uuid.uuid4().hex}"
    first = loans(spark, sf)
    tables.write_bucketed(bronze_frame(first, "2001-12-30"), name, path, buckets=16)
    later = bronze_frame(second_batch(first), "2001-12-31")
    tables.write_bucketed(later, name)
    tables.write_bucketed(later, name)
    # The files stay, the name is only needed to write.
    spark.sql(f"DROP TABLE {name}")
    return tables.read_bronze(spark, path).select("loan_id", "loan_status", "current_dpd", "record_hash")


@query
def s11_silver_write(spark, sf):
    path = new_path(spark, "silver")
    tables.write_silver(featured(spark, sf), path)
    return tables.read_table(spark, path).groupBy("risk_category", "loan_purpose").count()


@query
def s12_replace_partitions(spark, sf):
    """High-risk partitions are replaced, the others stay."""
    path = new_path(spark, "silver")
    df = loans(spark, sf)
    tables.write_silver(df, path)
    changed = selection.high_risk(df).withColumn("current_dpd", c("current_dpd") + 1)
    tables.replace_partitions(changed, path, V.SILVER_PARTITIONS)
    return tables.read_table(spark, path).select("loan_id", "risk_category", "loan_purpose", "current_dpd")


@query
def s13_compaction(spark, sf):
    path, target = new_path(spark, "loose"), new_path(spark, "compact")
    loans(spark, sf).repartition(16).write.partitionBy(*V.BRONZE_PARTITIONS).parquet(path)
    return tables.compact(spark, path, target, V.BRONZE_PARTITIONS)


@query
def s14_table_statistics(spark, sf):
    """Row count the catalog reports after the statistics were computed."""
    path = new_path(spark, "loans")
    tables.overwrite_table(loans(spark, sf), path, V.BRONZE_PARTITIONS)
    tables.register_table(spark, "lendscape_statistics", path)
    tables.analyze_table(spark, "lendscape_statistics")
    described = spark.sql("DESCRIBE TABLE EXTENDED lendscape_statistics").where("col_name = 'Statistics'")
    return described.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("rows"))


@query
def s15_table_detail(spark, sf):
    """Files and bytes depend on the layout; rows per partition do not."""
    path = new_path(spark, "bronze")
    tables.overwrite_table(loans(spark, sf), path, V.BRONZE_PARTITIONS)
    detail = tables.table_detail(spark, path, V.BRONZE_PARTITIONS)
    return detail.select("loan_status", "rows", ((c("files") > 0) & (c("bytes") > 0)).alias("has_files"))


@query
def s16_registered_table(spark, sf):
    path = new_path(spark, "bronze")
    tables.overwrite_table(loans(spark, sf), path, V.BRONZE_PARTITIONS)
    tables.register_table(spark, "credit_risk.bronze_loans", path)
    return spark.sql(
        "SELECT loan_status, count(*) AS loans, sum(loan_amount) AS amount "
        "FROM credit_risk.bronze_loans GROUP BY loan_status"
    )


@query
def s17_csv_export(spark, sf):
    path = new_path(spark, "export")
    files.write_csv(selection.high_risk(loans(spark, sf)), path)
    return files.split_corrupt(files.read_csv(spark, path))[0].select("loan_id", "loan_amount", "risk_category")


@query
def s19_text_lines(spark, sf):
    path = new_path(spark, "lines")
    files.write_lines(selection.distinct_values(loans(spark, sf), "customer_id"), "customer_id", path)
    return spark.read.text(path)


@query
def s20_write_verification(spark, sf):
    path = new_path(spark, "loans")
    df = loans(spark, sf)
    tables.overwrite_table(df, path)
    return tables.verify_write(tables.read_table(spark, path), df.count())


@query
def s23_sample_rows(spark, sf):
    shown = selection.existing_columns(
        loans(spark, sf), ["loan_id", "customer_id", "loan_amount", "credit_score", "risk_category"]
    )
    return selection.head_rows(shown, ["loan_id"], 5)


@query
def s24_latest_version(spark, sf):
    latest = versions.latest_version(merged_bronze(spark, sf))
    return latest.select("loan_id", "loan_status", "current_dpd", "record_hash")


# ---- projections and filters ------------------------------------------------


@query
def p02_aliased_columns(spark, sf):
    return selection.select_as(
        featured(spark, sf),
        {"loan_id": "id", "combined_risk_score": "risk_score", "pd_proxy": "pd", "emi_burden_pct": "emi_burden"},
    )


@query
def p03_existing_columns(spark, sf):
    return selection.existing_columns(loans(spark, sf), [*V.HIGH_RISK_COLUMNS, "no_such_column"])


@query
def p04_null_rows(spark, sf):
    return loans(spark, sf).where(c("dependents").isNull()).select("loan_id", "customer_id")


@query
def p05_score_out_of_range(spark, sf):
    bad, _ = quality.violations(AS_OF)["Credit score range (300-900)"]
    return dirty_loans(loans(spark, sf)).where(bad).select("loan_id", "credit_score")


@query
def p06_sign_checks(spark, sf):
    rules = quality.violations(AS_OF)
    bad = rules["DPD non-negative"][0] | rules["Loan amount positive"][0]
    return dirty_loans(loans(spark, sf)).where(bad).select("loan_id", "current_dpd", "loan_amount")


@query
def p07_date_logic(spark, sf):
    df = dirty_loans(loans(spark, sf))
    bad = quality.violations(AS_OF)["Valid date logic"][0]
    order_only = quality.violations(include_future=False)["Valid date logic"][0]
    return df.where(bad).select(
        "loan_id", "application_date", "disbursement_date", F.coalesce(order_only, F.lit(False)).alias("order_broken")
    )


@query
def p08_membership(spark, sf):
    df = selection.member_of(loans(spark, sf), "loan_status", ["Active", "Closed"])
    return selection.member_of(df, "risk_category", []).select("loan_id", "loan_status")


@query
def p09_date_range(spark, sf):
    df = selection.date_range(loans(spark, sf), "application_date", "1997-01-01", "1998-12-31")
    return df.select("loan_id", "application_date")


@query
def p10_high_risk(spark, sf):
    return selection.high_risk(loans(spark, sf)).select("loan_id", "current_dpd", "loan_status")


@query
def p11_distinct_values(spark, sf):
    return selection.distinct_values(loans(spark, sf), "loan_status")


@query
def p12_bounds(spark, sf):
    return selection.bounds(loans(spark, sf), "application_date")


@query
def p13_keyed_customers(spark, sf):
    keys = {1: b"first key of the portfolio", 2: b"second key, in use"}
    return selection.pseudonymize(loans(spark, sf), keys).select("loan_id", "customer_id", "key_version")


@query
def p13_rotated_customers(spark, sf):
    """Loans stored under the first key carry pseudonyms of the second one after rotation."""
    keys = {1: b"first key of the portfolio", 2: b"second key, in use"}
    stored = keep(selection.pseudonymize(loans(spark, sf), keys, version=1).select("loan_id", "customer_id", "key_version"), "masked")
    rotation = selection.key_rotation(loans(spark, sf), keys, old=1, new=2)
    return selection.rotate_pseudonyms(stored, rotation).select("loan_id", "customer_id", "key_version")


@query
def p13_masked_customers(spark, sf):
    return selection.mask_customers(loans(spark, sf), "salt-1").select("loan_id", "customer_id")


# ---- quality ----------------------------------------------------------------


@query
def q09_quality_report(spark, sf):
    return quality.run_quality_checks(dirty_loans(loans(spark, sf)), AS_OF)


@query
def q09_quality_report_clean(spark, sf):
    return quality.run_quality_checks(loans(spark, sf), AS_OF)


@query
def q10_gate_clean_rows(spark, sf):
    return quality.split_quarantine(dirty_loans(loans(spark, sf)), AS_OF)[0]


@query
def q10_gate_quarantined(spark, sf):
    rejected = quality.split_quarantine(dirty_loans(loans(spark, sf)), AS_OF)[1]
    return rejected.select("customer_id", "loan_id", F.array_join("failed_checks", "; ").alias("failed_checks"))


@query
def q11_critical_nulls(spark, sf):
    df = dirty_loans(loans(spark, sf)).transform(features.engineer_row_features, AS_OF)
    return quality.critical_nulls(df)


@query
def q12_invalid_numbers(spark, sf):
    df = dirty_loans(loans(spark, sf)).transform(features.engineer_row_features, AS_OF)
    return quality.invalid_numbers(df, infinite=True)


@query
def q12_invalid_features(spark, sf):
    df = dirty_loans(loans(spark, sf)).transform(features.engineer_row_features, AS_OF)
    return quality.invalid_numbers(df, infinite=True)


@query
def q12_validate_features(spark, sf):
    df = dirty_loans(loans(spark, sf)).transform(features.engineer_row_features, AS_OF)
    return quality.validate_features(df)


@query
def q13_missing_cells(spark, sf):
    return quality.missing_cells(dirty_loans(loans(spark, sf)))


# ---- features ---------------------------------------------------------------


def _added(applied: DataFrame, before: DataFrame, *extra: str) -> DataFrame:
    return applied.select("loan_id", *extra, *[n for n in applied.columns if n not in before.columns])


@query
def f_credit_features(spark, sf):
    df = loans(spark, sf)
    return _added(features.engineer_credit_features(df), df)


@query
def f_loan_features(spark, sf):
    df = dirty_loans(loans(spark, sf)).where("loan_id IS NOT NULL")
    return _added(features.engineer_loan_features(df), df)


@query
def f_repayment_features(spark, sf):
    df = loans(spark, sf)
    return _added(features.engineer_repayment_features(df, AS_OF), df)


@query
def f_demographic_features(spark, sf):
    df = loans(spark, sf)
    return _added(features.engineer_demographic_features(df), df)


@query
def f_risk_features(spark, sf):
    df = features.engineer_repayment_features(loans(spark, sf), AS_OF)
    return _added(features.engineer_risk_features(df), df)


@query
def f_time_features(spark, sf):
    df = loans(spark, sf)
    return _added(features.engineer_time_features(df, AS_OF), df)


@query
def f_undecided_flags(spark, sf):
    """Flags that stay NULL when undecidable, and vintage in 30-day periods."""
    df = features.engineer_row_features(loans(spark, sf), AS_OF, nulls="keep", vintage="days30", profile="core")
    return df.select(
        "loan_id", "has_existing_loans", "high_delinquency_risk", "early_warning_flag", "loan_vintage_months"
    )


@query
def f35_feature_stamp(spark, sf):
    df = features.stamp(featured(spark, sf))
    return df.select("loan_id", c("feature_engineering_timestamp").isNotNull().alias("stamped"))


@query
def f36_all_features(spark, sf):
    return features.engineer_features(loans(spark, sf), AS_OF)


@query
def w01_w03_group_averages(spark, sf):
    df = loans(spark, sf)
    return _added(features.add_statistical_features(df), df)


@query
def w01_null_group_average(spark, sf):
    """A group whose key is NULL has an average of its own."""
    df = loans(spark, sf).withColumn("loan_purpose", F.when(c("loan_purpose") != "Home", c("loan_purpose")))
    return features.add_statistical_features(df).select("loan_id", "loan_purpose", "avg_amount_by_purpose")


@query
def j01_purpose_statistics(spark, sf):
    df = loans(spark, sf)
    stats = keep(group_means(df, "loan_purpose", {"avg_amount": "loan_amount", "avg_dpd": "current_dpd"}), "stats")
    return join_lookup(df, stats, "loan_purpose").select("loan_id", "loan_purpose", "avg_amount", "avg_dpd")


@query
def j02_tier_statistics(spark, sf):
    df = loans(spark, sf)
    stats = keep(group_means(df, "city_tier", {"avg_income": "monthly_income"}), "stats")
    return join_lookup(df, stats, "city_tier").select("loan_id", "city_tier", "avg_income")


@query
def j03_unmatched_rows(spark, sf):
    first = loans(spark, sf)
    target = bronze_frame(first, "2001-12-30")
    batch = bronze_frame(second_batch(first), "2001-12-31")
    return versions.unmatched(batch, target).select("loan_id", "current_dpd")


@query
def j04_profiles_side_by_side(spark, sf):
    """On bronze, where loans have several versions."""
    df = merged_bronze(spark, sf)
    keys = versions.MERGE_KEYS
    return portfolio.combine_profiles(
        df.select(*keys, "customer_id", "age"),
        df.select(*keys, "monthly_income", "credit_score"),
        df.select(*keys, "loan_amount", "loan_purpose"),
        df.select(*keys, "emi_amount", "current_dpd"),
        keys=keys,
    )


# ---- aggregates, order, samples ---------------------------------------------


@query
def a01_count_by_status(spark, sf):
    return portfolio.count_by(loans(spark, sf), "loan_status")


@query
def a02_count_by_risk(spark, sf):
    return portfolio.count_by(loans(spark, sf), "risk_category")


@query
def a03_count_by_score_bucket(spark, sf):
    return portfolio.count_by(featured(spark, sf), "credit_score_bucket")


@query
def a04_count_by_purpose(spark, sf):
    return portfolio.count_by(loans(spark, sf), "loan_purpose", drop_nulls=True)


@query
def a05_default_rate(spark, sf):
    return portfolio.default_rate(loans(spark, sf))


@query
def a05_default_rate_by_split(spark, sf):
    split = encoding.stratified_split(loans(spark, sf))
    return rounded(split.groupBy("is_test").agg(F.avg("is_default").alias("default_rate")), "default_rate", digits=6)


@query
def a06_risk_summary(spark, sf):
    df = portfolio.risk_summary(featured(spark, sf))
    return rounded(df, *df.columns)


@query
def a07_group_means(spark, sf):
    df = loans(spark, sf)
    by_purpose = group_means(df, "loan_purpose", {"avg_amount": "loan_amount", "avg_dpd": "current_dpd"})
    by_tier = group_means(df, "city_tier", {"avg_amount": "monthly_income"}).withColumn(
        "avg_dpd", F.lit(None).cast("double")
    )
    return by_purpose.withColumnRenamed("loan_purpose", "grp").unionByName(by_tier.withColumnRenamed("city_tier", "grp"))


@query
def a08_numeric_summary(spark, sf):
    return rounded(portfolio.describe_numeric(loans(spark, sf)), "mean", "std", "p25", "p50", "p75")


@query
def a09_table_shape(spark, sf):
    return portfolio.table_shape(featured(spark, sf))


@query
def a10_medians(spark, sf):
    return rounded(portfolio.medians(featured(spark, sf), V.FULL_NUMERIC), "median")


@query
def a11_class_imbalance(spark, sf):
    return portfolio.imbalance(loans(spark, sf))


@query
def a12_segment_rollup(spark, sf):
    return rounded(portfolio.segment_rollup(featured(spark, sf)), "default_rate", "expected_loss", digits=3)


@query
def t05_seeded_sample(spark, sf):
    return selection.seeded_sample(loans(spark, sf), 1000, 42).select("loan_id", "customer_id", "loan_amount")


# ---- dashboard --------------------------------------------------------------


@query
def d01_key_metrics(spark, sf):
    df = dashboard.key_metrics(loans(spark, sf))
    return rounded(df, "total_portfolio_m", "default_rate_pct", "default_rate_delta", "avg_dpd", digits=6)


@query
def d02_risk_distribution(spark, sf):
    return dashboard.risk_distribution(loans(spark, sf))


@query
def d03_dpd_histogram(spark, sf):
    return dashboard.dpd_histogram(loans(spark, sf))


@query
def d03_dpd_histogram_with_current(spark, sf):
    return dashboard.dpd_histogram(loans(spark, sf), include_lowest=True)


@query
def d04_monthly_volume(spark, sf):
    return dashboard.monthly_volume(loans(spark, sf))


@query
def d05_monthly_default_rate(spark, sf):
    return rounded(dashboard.monthly_default_rate(loans(spark, sf)), "default_rate_pct", digits=6)


@query
def d06_score_histogram(spark, sf):
    return dashboard.score_histogram(loans(spark, sf))


@query
def d07_amount_by_purpose(spark, sf):
    return dashboard.amount_by_purpose(loans(spark, sf))


@query
def d08_high_risk_list(spark, sf):
    return dashboard.high_risk_list(loans(spark, sf))


@query
def d09_high_risk_export(spark, sf):
    path = gold.export_high_risk(loans(spark, sf), new_path(spark, "export"), datetime.date(2001, 12, 31))
    return files.split_corrupt(files.read_csv(spark, path))[0]


@query
def d10_filtered_export(spark, sf):
    path = new_path(spark, "export")
    gold.export_filtered(loans(spark, sf), path, risk=["Low", "Medium"], dates=("1996-01-01", "1999-12-31"))
    return files.split_corrupt(files.read_csv(spark, path))[0]


@query
def d11_filtered_metrics(spark, sf):
    df = selection.portfolio_filter(
        loans(spark, sf), risk=["High", "Medium"], status=["Active", "Closed"], dates=("1996-01-01", "1999-12-31")
    )
    return rounded(
        dashboard.key_metrics(df), "total_portfolio_m", "default_rate_pct", "default_rate_delta", "avg_dpd", digits=6
    )


# ---- preparation, evaluation, scoring ---------------------------------------


@query
def m01_feature_matrix(spark, sf):
    return encoding.select_features(featured(spark, sf), "recorded", extra=("loan_id", V.TARGET))


@query
def m02_label_codes(spark, sf):
    return encoding.label_codes(featured(spark, sf), V.FULL_CATEGORICAL)


@query
def m02_encoded_loans(spark, sf):
    names = ["employment_type", "education", "city_tier", "marital_status"]
    df = encoding.encode_labels(loans(spark, sf), names)
    return df.select("loan_id", *[f"{n}_code" for n in names])


@query
def m03_median_imputation(spark, sf):
    names = ["dependents", "late_payments_12m", "credit_utilization_ratio"]
    df = loans(spark, sf)
    return encoding.impute(df, encoding.fit_medians(df, names)).select("loan_id", *names)


@query
def m04_hash_split(spark, sf):
    return encoding.hash_split(loans(spark, sf)).select("loan_id", "is_default", "is_test")


@query
def m04_stratified_split(spark, sf):
    return encoding.stratified_split(loans(spark, sf)).select("loan_id", "is_default", "is_test")


@query
def m05_class_weights(spark, sf):
    return encoding.class_weights(loans(spark, sf)).select("loan_id", "is_default", "weight")


@query
def m06_m16_trained_scores(spark, sf):
    """Trains on the training split, saves, loads, and scores the whole portfolio."""
    data = keep(encoding.stratified_split(featured(spark, sf)), "training-data")
    path = new_path(spark, "model")
    modelling.save_model(modelling.train_default_model(data), path)
    model = modelling.load_model(path)
    return modelling.score_new_loans(data, model).select(
        "loan_id", "is_default", "is_test", "default_prediction", "default_probability", "risk_rating"
    )


@query
def m06_scored_facts(spark, sf):
    """What holds for the trained scores of every loan, whatever the model: ranges, and the saved model's scores."""
    data = keep(encoding.stratified_split(featured(spark, sf)), "training-data")
    model, path = modelling.train_default_model(data, features="smoke", rounds=V.SMOKE_ROUNDS), new_path(spark, "model")
    modelling.save_model(model, path)
    first = modelling.score_new_loans(data, model)
    again = modelling.score_new_loans(data, modelling.load_model(path))
    again = again.select("loan_id", c("default_probability").alias("p"), c("risk_rating").alias("again"))
    p = c("default_probability")
    return first.join(again, "loan_id").select(
        "loan_id",
        "is_default",
        "is_test",
        ((p > 0) & (p < 1)).alias("probability_valid"),
        (c("default_prediction") == (p > 0.5).cast("int")).alias("prediction_fits"),
        (c("risk_rating") == evaluation.risk_rating()).alias("rating_fits"),
        ((F.abs(p - c("p")) < 1e-12) & (c("risk_rating") == c("again"))).alias("reloaded_equal"),
    )


@query
def m13_importance_facts(spark, sf):
    """Importances of the recorded inputs: one each, none negative, adding up to 1."""
    data = keep(encoding.stratified_split(featured(spark, sf)), "training-data")
    importance = modelling.feature_importance(spark, modelling.train_default_model(data, rounds=V.SMOKE_ROUNDS, depth=4))
    return importance.agg(
        F.countDistinct("feature").alias("features"),
        F.count_if(c("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.sort_array(F.collect_list("feature")).cast("string").alias("names"),
    )


@query
def m13_feature_importance(spark, sf):
    data = keep(encoding.stratified_split(featured(spark, sf)), "training-data")
    model = modelling.train_default_model(data)
    path = new_path(spark, "importance")
    files.write_parquet(modelling.feature_importance(spark, model), path)
    return modelling.top_features(files.read_parquet(spark, path), 20)


@query
def m08_binary_metrics(spark, sf):
    df = evaluation.binary_metrics(scored(spark, sf), "is_default", "prediction")
    return rounded(df, *df.columns, digits=6)


@query
def m09_auc_roc(spark, sf):
    return rounded(evaluation.auc_roc(scored(spark, sf), "is_default", "score"), "auc_roc", digits=6)


@query
def m10_classification_report(spark, sf):
    df = evaluation.classification_report(scored(spark, sf), "is_default", "prediction")
    return rounded(df, "precision", "recall", "f1_score", digits=6)


@query
def m11_confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(scored(spark, sf), "is_default", "prediction")


@query
def m12_roc_curve(spark, sf):
    return evaluation.roc_curve(scored(spark, sf), "is_default", "score", origin=False)


@query
def m14_calibration(spark, sf):
    df = evaluation.calibrate_probability_bins(scored(spark, sf), "is_default", "probability")
    return rounded(df, "bin_low", "bin_high", "actual_default_rate", digits=6)


@query
def m15_risk_rating(spark, sf):
    return featured(spark, sf).select("loan_id", evaluation.risk_rating("pd_proxy").alias("risk_rating"))


@query
def m17_run_record(spark, sf):
    """Metrics and counts of a run, appended to a run table and read back."""
    df = keep(scored(spark, sf), "scored")
    metrics = evaluation.binary_metrics(df, "is_default", "prediction").first().asDict()
    path = new_path(spark, "runs")
    modelling.record_run(spark, path, "score_rule", {"cut": 60}, metrics, {"rows": df.count()})
    run = spark.read.parquet(path)
    return run.select(
        "run",
        c("params")["cut"].alias("cut"),
        F.round(c("metrics")["accuracy"], 6).alias("accuracy"),
        F.round(c("metrics")["recall"], 6).alias("recall"),
        c("counts")["rows"].alias("rows"),
    )


# ---- streams ----------------------------------------------------------------


def loan_stream(spark, sf) -> DataFrame:
    orders = stream_ingest.stream_parquet(spark, sf, "orders.parquet")
    return loans_from(orders, table(spark, sf, "customer"), table(spark, sf, "nation"))


FILES = 12  # of a piece: one file would be written and read by one core


def pieces(spark, sf) -> str:
    """The orders in four pieces of any dates, each of several files."""
    folder = new_path(spark, "arrivals")
    table(spark, sf, "orders").repartition(4 * FILES, "o_orderkey").write.parquet(folder)
    return folder


def loans_in_pieces(spark, sf, folder: str | None = None, pieces_per_batch: int = 1) -> DataFrame:
    """The loans of such pieces, with the file of each."""
    orders = stream_ingest.stream_parquet(spark, folder or pieces(spark, sf), files_per_batch=pieces_per_batch * FILES)
    orders = orders.withColumn("origin", c("_metadata.file_path"))
    return loans_from(orders, table(spark, sf, "customer"), table(spark, sf, "nation"), carry=["origin"])


@query
def st1_stream_ingest(spark, sf):
    """Arriving loans are merged into bronze, then sent again under a new checkpoint."""
    bronze = new_path(spark, "bronze")
    for _ in range(2):
        stream = files.with_audit(loan_stream(spark, sf), LOAN_COLUMNS, origin="derived")
        stream_ingest.ingest_stream(stream, bronze, new_path(spark, "progress")).awaitTermination()
    return tables.read_bronze(spark, bronze).drop("ingestion_timestamp", "source_file")


@query
def st2_stream_silver(spark, sf):
    bronze, silver, totals = (new_path(spark, label) for label in ("bronze", "silver", "totals"))
    tables.write_to_bronze(bronze_frame(loans(spark, sf), "2001-12-30"), bronze)
    for _ in range(2):
        stream = stream_ingest.stream_parquet(spark, bronze)
        progress = new_path(spark, "progress")
        stream_ingest.silver_stream(stream, silver, progress, AS_OF, totals=totals).awaitTermination()
    return read_silver(spark, silver, totals).select(
        "loan_id", "risk_category", "loan_purpose", "combined_risk_score", "expected_loss_amount",
        "avg_amount_by_purpose", "amount_deviation_pct",
    )


@query
def st3_stream_scoring(spark, sf):
    """A model trained on the portfolio rates the same loans as they arrive."""
    data = keep(encoding.stratified_split(featured(spark, sf)), "training-data")
    model = modelling.train_default_model(data, features="smoke", rounds=V.SMOKE_ROUNDS)
    out = new_path(spark, "rated")
    stream = loan_stream(spark, sf).transform(features.engineer_row_features, AS_OF)
    rated = stream_metrics.score_stream(stream, model)
    stream_metrics.to_files(rated, out, new_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).select("loan_id", "default_prediction", "default_probability", "risk_rating")


@query
def st3_streamed_facts(spark, sf):
    """Loans scored on a stream and in batch by one model agree."""
    data = keep(encoding.stratified_split(featured(spark, sf)), "training-data")
    model = modelling.train_default_model(data, features="smoke", rounds=V.SMOKE_ROUNDS)
    out = new_path(spark, "rated")
    stream = loan_stream(spark, sf).transform(features.engineer_row_features, AS_OF)
    stream_metrics.to_files(stream_metrics.score_stream(stream, model), out, new_path(spark, "progress")).awaitTermination()
    streamed = spark.read.parquet(out).select(
        "loan_id", c("default_probability").alias("p"), c("risk_rating").alias("streamed")
    )
    batch = modelling.score_new_loans(data, model)
    return batch.join(streamed, "loan_id", "full").select(
        "loan_id",
        F.coalesce(F.abs(c("default_probability") - c("p")) < 1e-12, F.lit(False)).alias("same_probability"),
        c("risk_rating").eqNullSafe(c("streamed")).alias("same_rating"),
    )


@query
def st4_windowed_metrics(spark, sf):
    """Loans per 30-day window and purpose; the newest windows are still open."""
    return closed_windows(spark, collected(spark, sf, runs=[1]))


@query
def st4_windows_after_lost_checkpoint(spark, sf):
    """The same files again without the checkpoint, in other batches: every figure stays."""
    return closed_windows(spark, collected(spark, sf, runs=[1, 3]))


@query
def st4_late_rows(spark, sf):
    """Rows that came before and after their window was closed add up to all loans."""
    out = collected(spark, sf, runs=[1, 2])
    parts = [
        stream_metrics.read_windows(spark, out, late=late).withColumn("late", F.lit(late)) for late in (False, True)
    ]
    return parts[0].unionAll(parts[1]).groupBy("loan_purpose").agg(
        F.sum("loans").alias("loans"), F.sum("amount").alias("amount"), (F.count_if("late") > 0).alias("some_late")
    )


def collected(spark, sf, runs) -> str:
    """Window figures after a run for each number of pieces per batch, none with a checkpoint of the one before."""
    out, folder = new_path(spark, "windows"), pieces(spark, sf)
    for pieces_per_batch in runs:
        stream = loans_in_pieces(spark, sf, folder, pieces_per_batch)
        progress = new_path(spark, "progress")
        stream_metrics.collect_windows(stream, out, progress, origin="origin").awaitTermination()
    return out


def closed_windows(spark, out) -> DataFrame:
    closed = stream_metrics.read_windows(spark, out, closed_after="30 days")
    return closed.select(
        c("start").cast("date").alias("window_start"),
        c("end").cast("date").alias("window_end"),
        "loan_purpose",
        "loans",
        "amount",
        F.round("default_rate", 6).alias("default_rate"),
    )


@query
def st5_stream_dedupe(spark, sf):
    """Every loan arrives twice and is kept once."""
    out = new_path(spark, "deduplicated")
    streams = [loans_in_pieces(spark, sf) for _ in range(2)]
    once, again = (files.with_audit(s.drop("origin"), LOAN_COLUMNS, origin="derived") for s in streams)
    timed = stream_metrics.with_arrival_time(once.unionByName(again))
    stream_metrics.to_files(stream_metrics.drop_resent(timed), out, new_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).select("loan_id", "record_hash", "application_date")


@query
def st5_merge_after_lost_checkpoint(spark, sf):
    """Every loan arrives twice, and all of them again without the checkpoint; each is kept once."""
    out = new_path(spark, "deduplicated")
    folder = pieces(spark, sf)
    for pieces_per_batch in (1, 3):
        streams = [loans_in_pieces(spark, sf, folder, pieces_per_batch) for _ in range(2)]
        once, again = (files.with_audit(s.drop("origin"), LOAN_COLUMNS, origin="derived") for s in streams)
        timed = stream_metrics.with_arrival_time(once.unionByName(again))
        progress = new_path(spark, "progress")
        stream_metrics.merge_files(stream_metrics.drop_resent(timed), out, progress).awaitTermination()
        discard(spark, progress)  # the checkpoint is lost
    return spark.read.parquet(out).select("loan_id", "record_hash", "application_date")


@query
def st6_stream_quality(spark, sf):
    alerts = new_path(spark, "alerts")
    stream = dirty_loans(loan_stream(spark, sf))
    stream_ingest.quality_stream(stream, alerts, new_path(spark, "progress"), AS_OF).awaitTermination()
    return spark.read.parquet(alerts).select("check", "passed", "details")


# ---- pricing and label rules ------------------------------------------------


@query
def l_pricing_rules(spark, sf):
    return loans(spark, sf).select(
        "loan_id",
        lending.emi(c("loan_amount"), c("interest_rate"), c("loan_term_months")).alias("emi"),
        lending.interest_rate(c("credit_score")).alias("rate"),
        lending.dpd_probability(c("credit_score")).alias("dpd_probability"),
        lending.max_dpd(c("current_dpd"), c("max_dpd_12m")).alias("max_dpd"),
        lending.income_multiplier(c("employment_type")).alias("income_multiplier"),
        lending.disbursed_on(c("application_date"), F.lit(7)).alias("earliest_disbursement"),
    )


@query
def l_label_rules(spark, sf):
    default = lending.is_default(c("current_dpd"), c("loan_status"))
    severity = (loan_number() % 31) / 31
    return loans(spark, sf).select(
        "loan_id",
        default.alias("is_default"),
        lending.risk_category(default, c("current_dpd"), c("credit_score"), c("late_payments_12m")).alias("risk"),
        (lending.estimated_lgd(default, severity) > 0).alias("has_loss"),
        lending.loan_to_income(c("loan_amount"), c("monthly_income")).alias("ltv_ratio"),
        lending.debt_to_income(c("emi_amount"), c("existing_emi"), c("monthly_income")).alias("dti_ratio"),
    )


@query
def l09_padded_keys(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        padded_key("CUST", c("o_custkey")).alias("customer_id"), padded_key("LOAN", c("o_orderkey")).alias("loan_id")
    )
