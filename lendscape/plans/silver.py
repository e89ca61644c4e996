"""Bronze to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixed_values as V
from ..operators.features import PORTFOLIO_MEANS, add_statistical_features, engineer_features, engineer_row_features, stamp
from ..operators.quality import validate_features
from ..operators.versions import latest_version, only_new
from ..session import keep
from ..sources import totals as kept
from ..sources.tables import read_bronze, read_table, table_exists, write_silver, write_to_bronze


def build_silver(
    spark: SparkSession, bronze: str, silver: str, as_of=None, versions: str = "all", fmt: str = "parquet", **options
) -> DataFrame:
    """Recompute every feature, replace the table and report on the features stored: ``check, rows``.

    ``versions='latest'`` keeps the newest version of each loan; ``all`` keeps
    every version bronze holds.
    """
    df = read_bronze(spark, bronze, fmt)
    if versions == "latest":
        df = latest_version(df)
    write_silver(df.transform(engineer_features, as_of, **options).transform(stamp), silver, fmt=fmt)
    return keep(validate_features(read_table(spark, silver, fmt)), "feature-validation")


def extend_silver(spark: SparkSession, bronze: str, silver_rows: str, as_of=None, totals: str | None = None) -> None:
    """Add row features for bronze records not processed before; the rest is not touched.

    ``totals`` names the table of group totals that follows the rows.
    """
    source = read_bronze(spark, bronze)
    if table_exists(spark, silver_rows):
        source = only_new(source, read_table(spark, silver_rows))
    rows = source.transform(engineer_row_features, as_of)
    write_to_bronze(rows, silver_rows, partitions=V.SILVER_PARTITIONS)
    if totals:
        kept.refresh_totals(spark, silver_rows, totals, PORTFOLIO_MEANS)


def read_silver(spark: SparkSession, silver_rows: str, totals: str | None = None) -> DataFrame:
    """Incrementally kept row features with the portfolio averages of today.

    With ``totals``, only files they do not cover yet are aggregated.
    """
    rows = read_table(spark, silver_rows)
    if not totals:
        return add_statistical_features(rows)
    kept.refresh_totals(spark, silver_rows, totals, PORTFOLIO_MEANS)
    return add_statistical_features(rows, kept.kept_totals(spark, silver_rows, totals, PORTFOLIO_MEANS))
