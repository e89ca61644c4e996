"""Group totals that follow a table of files: each file is aggregated once.

Files of a table never change; they only come and go. Sums and counts are kept
per file, so it doesn't matter which run added them: a file that is missing is
aggregated, one that was aggregated twice counts once, one that compaction
replaced no longer counts.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.group_means import group_totals, measured
from ..session import keep
from .tables import read_table, table_exists


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``: names only, which planning a scan of the table lists as well, spelled as ``input_file_name`` does."""
    return spark.createDataFrame([(f,) for f in read_table(spark, path).inputFiles()], "file string")


def refresh_totals(spark: SparkSession, path: str, totals: str, specs: dict[str, dict[str, str]]) -> int:
    """Aggregate the files of ``path`` that ``totals`` lacks; returns their number."""
    files = table_files(spark, path)
    if table_exists(spark, totals):
        files = files.join(read_table(spark, totals).select("file").distinct(), "file", "left_anti")
    fresh = [row[0] for row in files.collect()]
    if fresh:
        rows = spark.read.schema(read_table(spark, path).schema).option("basePath", path).parquet(*map(unquote, fresh))
        group_totals(rows.withColumn("file", F.input_file_name()), specs, ["file"]).write.mode("append").parquet(totals)
    return len(fresh)


def kept_totals(spark: SparkSession, path: str, totals: str, specs: dict[str, dict[str, str]]) -> DataFrame:
    """Totals by the keys of ``specs`` over the files that ``path`` holds now."""
    held = read_table(spark, totals).join(table_files(spark, path), "file", "left_semi")
    names = [f"{kind}_{s}" for kind in ("sum", "n") for s in measured(specs)]
    once = held.groupBy("file", *specs).agg(F.max(F.struct(*names)).alias("t")).select(*specs, "t.*")
    return keep(once.groupBy(*specs).agg(*[F.sum(n).alias(n) for n in names]), "group-totals")
