"""Corpus pipeline: quality, repeated passages, near-duplicates, mixture, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import table
from lendscape.llm.line_chunks import drop_repeated_passages
from lendscape.llm.mixture import mix
from lendscape.llm.near_duplicates import drop_near_duplicates
from lendscape.llm.packing import pack_documents
from lendscape.llm.quality_rules import filter_quality
from lendscape.session import keep

MIX_PCT = 90


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and, on rejected hosts, the strict ones."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in an earlier document; ``n_chars`` follows the text."""
    cleaned = drop_repeated_passages(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group on five-word shingles at a similarity of 0.8."""
    return drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, each document once at most, by the weights of domains, languages and sources."""
    return mix(docs, MIX_PCT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every document in bins of tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixture", mixture),
    ("packing", packing),
]

# Near-duplicate detection on large texts and packing have no SQL form; the tests
# hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
