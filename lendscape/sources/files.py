"""Reading source files and writing exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import record_hash, record_key
from ..schema import CORRUPT_COLUMN, LOAN_COLUMNS, LOAN_SCHEMA


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType = LOAN_SCHEMA) -> DataFrame:
    """Typed CSV scan without audit columns.

    A header that does not match the schema fails; a cell that does not parse
    becomes NULL and its raw line is kept in the corrupt-record column.
    """
    if CORRUPT_COLUMN not in schema.fieldNames():
        schema = StructType(list(schema.fields)).add(CORRUPT_COLUMN, "string")
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("dateFormat", "yyyy-MM-dd")
        .schema(schema)
        .csv(path)
    )


def with_audit(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    null_safe: bool = False,
    at: str | None = None,
    origin: str | None = None,
) -> DataFrame:
    """Add ``ingestion_timestamp``, ``source_file`` and ``record_hash``.

    The hash covers the source columns only, so that re-reading a file gives
    the same hashes. ``at`` replaces the current time, and ``origin`` the file
    name, which a frame joined from several sources does not have.
    """
    columns = list(columns or [n for n in df.columns if n != CORRUPT_COLUMN])
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if at is None else F.lit(at).cast("timestamp"),
            "source_file": F.input_file_name() if origin is None else F.lit(origin),
            "record_hash": record_hash(columns, null_safe),
        }
    )


def with_record_key(df: DataFrame) -> DataFrame:
    return df.withColumn("record_key", record_key())


def read_source_data(
    spark: SparkSession, path: str, schema: StructType = LOAN_SCHEMA, null_safe: bool = False
) -> DataFrame:
    """CSV scan with audit columns; fails at once when the path is absent."""
    return with_audit(read_csv(spark, path, schema), schema.fieldNames(), null_safe)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and rows that did not with their raw line."""
    parsed = df.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    return parsed, df.where(F.col(CORRUPT_COLUMN).isNotNull())


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet dataset; partition folders become columns at the end of the row."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def in_source_order(df: DataFrame) -> DataFrame:
    """Source columns first, in their declared order, then the others."""
    rest = [n for n in df.columns if n not in LOAN_COLUMNS]
    return df.select(*[n for n in LOAN_COLUMNS if n in df.columns], *rest)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One text line per row; the part files keep the frame's order."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
