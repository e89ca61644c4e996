"""Source files to the bronze table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators.quality import quality_passed, run_quality_checks, split_quarantine
from ..schema import CORRUPT_COLUMN
from ..session import keep
from ..sources.files import read_source_data
from ..sources.tables import compact_partitions, write_to_bronze


@dataclass
class IngestResult:
    passed: bool
    written: str | None
    report: DataFrame
    malformed: int


def ingest(
    spark: SparkSession,
    source: str,
    bronze: str,
    gate: str = "stop",
    quarantine: str | None = None,
    as_of=None,
    fmt: str = "parquet",
    compact: bool = False,
) -> IngestResult:
    """Read, check, and write if the gate lets the data through.

    ``gate``: ``stop`` writes nothing when a check fails, ``warn`` writes
    anyway, ``quarantine`` writes the good rows and sets the others aside.
    A line that doesn't parse fails the gate too; ``malformed`` is their number.
    """
    if gate == "quarantine" and not quarantine:
        raise ValueError("the quarantine gate needs a quarantine path")
    # Text is parsed and hashed once; every pass below reads the staged columns it needs.
    df = keep(read_source_data(spark, source), "batch")
    report = keep(run_quality_checks(df, as_of), "quality-report")
    malformed = df.where(F.col(CORRUPT_COLUMN).isNotNull()).count()
    passed = quality_passed(report) and malformed == 0
    rows, written = df, None
    if gate == "quarantine":
        rows, rejected = split_quarantine(df, as_of)
        write_to_bronze(rejected, quarantine, keys=("record_hash", CORRUPT_COLUMN), partitions=(), fmt=fmt)
    if passed or gate in ("warn", "quarantine"):
        written = write_to_bronze(rows.drop(CORRUPT_COLUMN), bronze, fmt=fmt)
        if compact:
            compact_partitions(spark, bronze, V.BRONZE_PARTITIONS)
    return IngestResult(passed, written, report, malformed)
