"""Tables on files: create, merge, replace partitions, compact, register, inspect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators.versions import BUCKET_KEY, MERGE_KEYS, unmatched, unmatched_bucketed
from ..session import passing
from .files import in_source_order


BUCKETS = 200


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``fmt='delta'`` works when that connector is on the class path."""
    return spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        read_table(spark, path, fmt).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def _writer(df: DataFrame, partitions: Sequence[str], fmt: str, mode: str):
    """Even output files: partition values are kept together, large ones are split.

    The rebalance hint lets the adaptive planner size the write tasks; a
    partition holding a third of the table becomes many files, not one task.
    """
    if partitions:
        df = df.hint("rebalance", *partitions)
    writer = df.write.format(fmt).mode(mode).option("compression", "snappy")
    return writer.partitionBy(*partitions) if partitions else writer


def overwrite_table(
    df: DataFrame, path: str, partitions: Sequence[str] = (), fmt: str = "parquet", new_schema: bool = True
) -> None:
    """Replace the table; ``new_schema`` lets a format that stores a schema change it."""
    writer = _writer(df, partitions, fmt, "overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta" and new_schema:
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that occur in ``df``."""
    _writer(df, partitions, fmt, "overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def check_columns(batch: DataFrame, target: DataFrame, partitions: Sequence[str] = ()) -> None:
    """Refuse a batch whose columns differ from the table's in name or type.

    Types of partition columns aren't compared: folders hold their values as text.
    """
    have, want = ({f.name: f.dataType.simpleString() for f in df.schema} for df in (batch, target))
    faults = [f"{n} is missing" for n in want if n not in have]
    faults += [f"{n} is not in the table" for n in have if n not in want]
    faults += [
        f"{n} is {have[n]}, in the table {want[n]}"
        for n in have
        if n in want and n not in partitions and have[n] != want[n]
    ]
    if faults:
        raise ValueError("batch does not fit the table: " + "; ".join(faults))


def write_to_bronze(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = MERGE_KEYS,
    partitions: Sequence[str] = V.BRONZE_PARTITIONS,
    fmt: str = "parquet",
    once: bool = False,
) -> str:
    """Create the table, or append the rows whose key it does not hold yet.

    Appending is idempotent for one writer: after a crash the same batch can be
    sent again and only what is missing is added. A batch with other columns is refused.
    ``once`` adds one row per key where the batch has several.
    """
    spark = df.sparkSession
    if not table_exists(spark, path, fmt):
        overwrite_table(df.dropDuplicates(list(keys)) if once else df, path, partitions, fmt)
        return "created"
    target = read_table(spark, path, fmt)
    check_columns(df, target, partitions)
    with passing(spark):
        fresh = unmatched(df, target, keys)
        if once:
            fresh = fresh.dropDuplicates(list(keys))
        _writer(fresh.select(*df.columns), partitions, fmt, "append").save(path)
    return "merged"


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, str]:
    """Number of buckets and bucket column of a catalog table."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in facts:
        raise ValueError(f"{name} is not bucketed")
    return int(facts["Num Buckets"]), facts["Bucket Columns"].strip("[]`")


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str | None = None,
    keys: Sequence[str] = MERGE_KEYS,
    buckets: int = BUCKETS,
    bucket_key: str = BUCKET_KEY,
) -> str:
    """Create the catalog table ``name`` in buckets, or append the rows whose key it does not hold yet.

    For targets too large to be shuffled, even by their keys alone, for each
    delivery. ``bucket_key`` is one of ``keys`` and should have many values: rows
    that share one lie in one bucket, though in several files if there are many.
    An existing table keeps its own number of buckets.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        writer = df.hint("rebalance", buckets, bucket_key).write.format("parquet").option("compression", "snappy")
        if path:
            writer = writer.option("path", path)
        writer.bucketBy(buckets, bucket_key).sortBy(bucket_key).saveAsTable(name)
        return "created"
    buckets, bucket_key = bucket_spec(spark, name)
    target = spark.table(name)
    check_columns(df, target)
    fresh = unmatched_bucketed(df, target, keys, bucket_key).select(*target.columns)
    fresh.hint("rebalance", buckets, bucket_key).write.insertInto(name)
    return "merged"


def attach_bucketed(
    spark: SparkSession, name: str, path: str, buckets: int = BUCKETS, bucket_key: str = BUCKET_KEY
) -> None:
    """Enter a folder that :func:`write_bucketed` filled in the catalog of another session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{bucket_key}`) SORTED BY (`{bucket_key}`)"
        f" INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def write_silver(
    df: DataFrame, path: str, partitions: Sequence[str] = V.SILVER_PARTITIONS, fmt: str = "parquet"
) -> None:
    overwrite_table(df, path, partitions, fmt)


def compact(
    spark: SparkSession, path: str, target: str, partitions: Sequence[str] = (), fmt: str = "parquet"
) -> DataFrame:
    """Rewrite a table of many small files at ``target`` and check the copy.

    The source stays as it is; point readers to ``target`` with
    :func:`register_table` once the copy is good. Returns the comparison.
    """
    _writer(read_table(spark, path, fmt), partitions, fmt, "errorifexists").save(target)
    report = verify_copy(read_table(spark, path, fmt), read_table(spark, target, fmt))
    if not report.first()["same"]:
        raise RuntimeError(f"compacted copy at {target} differs from {path}")
    return report


def compact_partitions(spark: SparkSession, path: str, partitions: Sequence[str]) -> None:
    """Rewrite the files of a partitioned table in place.

    New files are staged first; each old partition is dropped only when the
    whole rewrite has succeeded.
    """
    replace_partitions(spark.read.parquet(path), path, partitions)


def content_sum(df: DataFrame) -> DataFrame:
    """Row count and an order-free sum of row hashes."""
    names = sorted(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*names).cast("decimal(38,0)")).alias("content"),
    )


def verify_copy(before: DataFrame, after: DataFrame) -> DataFrame:
    left, right = content_sum(before), content_sum(after)
    sides = left.select("*", F.lit("before").alias("side")).unionAll(right.select("*", F.lit("after").alias("side")))
    return sides.agg(
        F.max(F.when(F.col("side") == "before", F.col("rows"))).alias("rows_before"),
        F.max(F.when(F.col("side") == "after", F.col("rows"))).alias("rows_after"),
        ((F.count_distinct("rows") == 1) & (F.count_distinct(F.coalesce("content", F.lit(0))) == 1)).alias("same"),
    )


def verify_write(written: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Read-back check: rows, columns and, when given, whether the rows are as expected."""
    checked = written.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(written.columns)))
    if expected_rows is None:
        return checked
    return checked.withColumn("complete", F.col("rows") == F.lit(expected_rows))


def table_detail(spark: SparkSession, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Files, bytes and rows per partition."""
    files = (
        spark.read.parquet(path)
        .select(*partitions, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .groupBy(*partitions, "file")
        .agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    )
    return files.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows")
    )


def register_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    read_table(spark, path, fmt).createOrReplaceTempView(name)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Point a catalog table at ``path``; partitions of a file table are discovered."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if fmt != "delta" and any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def analyze_table(spark: SparkSession, name: str, columns: bool = False) -> None:
    suffix = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{suffix}")


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return in_source_order(read_table(spark, path, fmt))
