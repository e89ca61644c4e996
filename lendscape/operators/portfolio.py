"""Portfolio aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .ranks import column_profile, exact_quantiles


def count_by(df: DataFrame, key: str, drop_nulls: bool = False) -> DataFrame:
    """``key, count``, most frequent first, ties by key."""
    if drop_nulls:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(key).count().orderBy(F.desc("count"), key)


def default_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("is_default").alias("default_rate"))


def risk_summary(df: DataFrame) -> DataFrame:
    """Mean risk score, PD, instalment burden and payment consistency."""
    return df.agg(
        F.avg("combined_risk_score").alias("avg_risk_score"),
        F.avg("pd_proxy").alias("avg_pd"),
        F.avg("emi_burden_pct").alias("avg_emi_burden"),
        F.avg("payment_consistency_score").alias("avg_payment_score"),
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records")).withColumn(
        "total_columns", F.lit(len(df.columns))
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] = V.SUMMARY_COLUMNS) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, quartiles exact."""
    profile = column_profile(df, columns, (0.25, 0.5, 0.75))
    rows = [(c, p["count"], p["mean"], p["std"], p["min"], *p["quantiles"], p["max"]) for c, p in profile.items()]
    return df.sparkSession.createDataFrame(
        rows,
        "feature string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double",
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return exact_quantiles(df, columns, (0.5,)).withColumnRenamed("q0", "median")


def imbalance(df: DataFrame, label: str = V.TARGET) -> DataFrame:
    """Negatives per positive; NULL without positives."""
    positives = F.sum(label)
    return df.agg(
        F.try_divide((F.count(label) - positives).cast("double"), positives).alias("scale_pos_weight")
    )


def segment_rollup(df: DataFrame) -> DataFrame:
    """Exposure, default rate and expected loss by risk category, then purpose, with totals.

    ``level`` is 0 for a segment, 1 for a risk category, 3 for the total.
    """
    return df.rollup("risk_category", "loan_purpose").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("loans"),
        F.sum("loan_amount").alias("exposure"),
        F.avg("is_default").alias("default_rate"),
        F.sum("expected_loss_amount").alias("expected_loss"),
    )


def segment_profile(df: DataFrame, *keys: str) -> DataFrame:
    """Risk profile per segment."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum("loan_amount").alias("exposure"),
        F.avg("is_default").alias("default_rate"),
        F.avg("combined_risk_score").alias("avg_risk_score"),
        F.sum("expected_loss_amount").alias("expected_loss"),
    )


def _one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key that isn't NULL; rows of one key that differ are an error."""
    rest = [n for n in df.columns if n not in keys]
    if not rest:
        return df.distinct()
    whole = df.dropna(subset=list(keys)).groupBy(*keys)
    found = whole.agg(
        F.first(F.struct(*rest)).alias("_row"),
        (F.min(F.xxhash64(*rest)) == F.max(F.xxhash64(*rest))).alias("_alike"),
    )
    fault = F.raise_error(F.concat(F.lit(f"several rows for one {', '.join(keys)}: "), F.to_json(F.struct(*keys))))
    checked = found.withColumn("_row", F.when(F.col("_alike"), F.col("_row")).otherwise(fault))
    return checked.select(*keys, *[F.col("_row")[n].alias(n) for n in rest])


def combine_profiles(base: DataFrame, *others: DataFrame, keys: Sequence[str] = ("loan_id",)) -> DataFrame:
    """Put column groups of the same loans side by side, matched on ``keys``.

    Where loans have several versions, the keys must tell these apart
    (``loan_id, record_hash``): rows of one key that differ raise an error, equal
    ones count once. A NULL key meets nothing.
    """
    for other in others:
        base = base.join(_one_per_key(other, keys), list(keys))
    return base
