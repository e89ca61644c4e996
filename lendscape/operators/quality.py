"""Data-quality checks: one pass over the data however many checks there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from .. import fixed_values as V
from ..schema import CORRUPT_COLUMN
from .features import as_date

MALFORMED = "Malformed line"


def violations(as_of=None, include_future: bool = True) -> dict[str, tuple[Column, str]]:
    """``{check name: (condition that marks a bad row, wording)}``.

    ``include_future=False`` leaves out the "applied after today" half.
    """
    rules = {
        V.NULL_CHECK_NAME.format(name): (F.col(name).isNull(), V.NULL_CHECK_DETAIL)
        for name in V.NULL_CHECK_COLUMNS
    }
    dates = F.col("disbursement_date") < F.col("application_date")
    if include_future:
        dates = dates | (F.col("application_date") > as_date(as_of))
    conditions = {
        "score_range": ~F.col("credit_score").between(V.SCORE_FLOOR, V.SCORE_CEILING),
        "dpd_sign": F.col("current_dpd") < 0,
        "amount_sign": F.col("loan_amount") <= 0,
        "date_logic": dates,
    }
    for key, condition in conditions.items():
        name, wording = V.RULE_CHECKS[key]
        rules[name] = (condition, wording)
    return rules


def _as_rows(counts: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*entries)))


def run_quality_checks(df: DataFrame, as_of=None, include_future: bool = True) -> DataFrame:
    """Report with one row per check: ``check, passed, details``."""
    rules = violations(as_of, include_future)
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (bad, _) in enumerate(rules.values())])
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            (F.col(f"c{i}") == 0).alias("passed"),
            F.concat(F.col(f"c{i}").cast("string"), F.lit(f" {wording}")).alias("details"),
        )
        for i, (name, (_, wording)) in enumerate(rules.items())
    ]
    return _as_rows(counts, entries)


def quality_passed(report: DataFrame) -> bool:
    return bool(report.agg(F.bool_and("passed")).first()[0])


def tag_violations(df: DataFrame, as_of=None) -> DataFrame:
    """Add ``failed_checks``: the names of the checks each row fails.

    A row read from a malformed line fails too, even if its key columns parsed.
    """
    names = [F.when(bad, F.lit(name)) for name, (bad, _) in violations(as_of).items()]
    if CORRUPT_COLUMN in df.columns:
        names.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MALFORMED)))
    return df.withColumn("failed_checks", F.array_compact(F.array(*names)))


def split_quarantine(df: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the rest with the checks they fail."""
    tagged = tag_violations(df, as_of)
    clean = tagged.where(F.size("failed_checks") == 0).drop("failed_checks")
    return clean, tagged.where(F.size("failed_checks") > 0)


def _counts_as_rows(df: DataFrame, conditions: dict[str, Column], label: str, value: str) -> DataFrame:
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(conditions.values())])
    entries = [
        F.struct(F.lit(name).alias(label), F.col(f"c{i}").alias(value)) for i, name in enumerate(conditions)
    ]
    return _as_rows(counts, entries)


def critical_nulls(df: DataFrame, features: Sequence[str] = V.CRITICAL_FEATURES) -> DataFrame:
    """NULL count per critical feature."""
    return _counts_as_rows(df, {f: F.col(f).isNull() for f in features}, "feature", "null_count")


def invalid_numbers(df: DataFrame, first: int | None = None, infinite: bool = False) -> DataFrame:
    """NULL-or-NaN count of every numeric column.

    ``first`` keeps only that many in schema order; ``infinite`` also counts infinities.
    """
    fields = [f for f in df.schema.fields if isinstance(f.dataType, NumericType)][:first]
    conditions = {}
    for field in fields:
        value = F.col(field.name)
        bad = value.isNull()
        if isinstance(field.dataType, (DoubleType, FloatType)):
            bad = bad | F.isnan(value)
            if infinite:
                bad = bad | (F.abs(value) == F.lit(float("inf")))
        conditions[field.name] = bad
    return _counts_as_rows(df, conditions, "feature", "invalid_count")


def validate_features(df: DataFrame) -> DataFrame:
    """Critical NULLs and invalid numbers as one report, from a single pass."""
    critical = {f"null:{f}": F.col(f).isNull() for f in V.CRITICAL_FEATURES}
    fields = [f for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    numeric = {
        f"invalid:{f.name}": (F.col(f.name).isNull() | F.isnan(F.col(f.name).cast("double"))) for f in fields
    }
    return _counts_as_rows(df, {**critical, **numeric}, "check", "rows")


def missing_cells(df: DataFrame) -> DataFrame:
    """Total NULL cells over all columns."""
    nulls = [F.when(F.col(name).isNull(), 1).otherwise(0) for name in df.columns]
    per_row = nulls[0]
    for one in nulls[1:]:
        per_row = per_row + one
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint").alias("missing_values"))
