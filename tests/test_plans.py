"""Physical plans: what is read, what is shuffled, where the skew goes."""

from __future__ import annotations

import re

import pytest

from lendscape.operators import dashboard, encoding, features, portfolio, selection, versions
from lendscape.plans import silver
from lendscape.schema import LOAN_COLUMNS
from lendscape.session import JVM_FLAG, METHOD_LIMIT, tune
from lendscape.sources import files, tables
from lendscape.sources.derived_loans import AS_OF, loans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver_path(spark, portfolio_path, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    book = spark.read.parquet(portfolio_path)
    tables.write_to_bronze(files.with_audit(book, LOAN_COLUMNS, origin="x"), f"{folder}/bronze")
    silver.build_silver(spark, f"{folder}/bronze", f"{folder}/silver", AS_OF)
    return f"{folder}/silver"


def test_silver_reports_on_its_features(spark, portfolio_path, folder):
    tables.write_to_bronze(files.with_audit(spark.read.parquet(portfolio_path), LOAN_COLUMNS, origin="x"), f"{folder}/bronze")
    report = {r["check"]: r["rows"] for r in silver.build_silver(spark, f"{folder}/bronze", f"{folder}/silver", AS_OF).collect()}
    missing = tables.read_table(spark, f"{folder}/silver").where("pd_proxy IS NULL").count()
    assert report["null:pd_proxy"] == report["invalid:pd_proxy"] == missing > 0


def test_risk_filter_prunes_partitions(spark, silver_path):
    text = plan(selection.high_risk(tables.read_table(spark, silver_path)))
    assert re.search(r"PartitionFilters: \[[^\]]*risk_category[^\]]*= High", text)


def test_date_filter_is_pushed_down(spark, silver_path):
    df = selection.date_range(tables.read_table(spark, silver_path), "application_date", "1997-01-01", "1997-12-31")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(application_date,1997-01-01\)", plan(df))


def test_only_needed_columns_are_read(spark, silver_path):
    text = plan(dashboard.key_metrics(tables.read_table(spark, silver_path)))
    assert "ReadSchema: struct<loan_amount:int,current_dpd:int,is_default:int>" in text


def test_profile_aggregates_before_the_shuffle(spark, sf_dir):
    text = plan(portfolio.segment_profile(features.engineer_row_features(loans(spark, sf_dir), AS_OF), "age_group"))
    assert text.count("HashAggregate") == 2 and "Window" not in text


def test_row_features_do_not_shuffle(spark, book):
    assert "Exchange" not in plan(features.engineer_row_features(book, AS_OF))


def test_latest_version_reduces_before_the_shuffle(spark, silver_path):
    text = plan(versions.latest_version(tables.read_table(spark, silver_path)))
    assert "partial_max_by" in text and "Window" not in text


def test_known_rows_are_not_merged_again(spark, book):
    target = files.with_audit(book, LOAN_COLUMNS, at="2001-12-30", origin="x")
    fresh = versions.unmatched(target.where("credit_score > 850"), target)
    assert fresh.count() == 0


def test_tuning_leaves_a_flagged_session_alone(spark):
    assert JVM_FLAG in spark.conf.get("spark.driver.extraJavaOptions")
    tune(spark)
    assert spark.conf.get(METHOD_LIMIT) == "65535"


def test_shared_folder_is_required_on_a_cluster():
    from lendscape.session import shared_folder

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_split_counts_instead_of_ranking(spark, silver_path):
    text = plan(encoding.stratified_split(tables.read_table(spark, silver_path)))
    assert "Window" not in text and "rangepartitioning" not in text


def test_months_are_aggregated_once(spark, silver_path):
    text = plan(dashboard.monthly_volume(tables.read_table(spark, silver_path)))
    assert "application_date" not in text
