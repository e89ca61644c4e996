"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space separates words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: Column) -> Column:
    """A NULL text counts as an empty one."""
    return F.coalesce(column.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text as an array; adjacent white space separates once."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that start with ``names`` and clash with none of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
