"""Column selection, filters, ordered samples."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.keys import hmac_pads, hmac_sha256, masked_id, unit_hash
from ..session import keep


def select_as(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select ``{column: alias}``."""
    return df.select(*[F.col(source).alias(alias) for source, alias in names.items()])


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    present = set(df.columns)
    return df.select(*[name for name in wanted if name in present])


def member_of(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Rows whose value is listed; an empty list, or a missing column, filters nothing."""
    if not values or column not in df.columns:
        return df
    return df.where(F.col(column).isin(*values))


def date_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Inclusive on both ends; an absent end is open."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(str(end)).cast("date"))
    return df


def portfolio_filter(df: DataFrame, risk=None, status=None, dates=None) -> DataFrame:
    """The filter panel: risk categories, loan statuses, application dates."""
    df = member_of(df, "risk_category", risk)
    df = member_of(df, "loan_status", status)
    if dates and "application_date" in df.columns:
        df = date_range(df, "application_date", *dates)
    return df


def high_risk(df: DataFrame) -> DataFrame:
    return df.where(F.col("risk_category") == V.HIGH_RISK)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def mask_customers(df: DataFrame, salt: str, column: str = "customer_id") -> DataFrame:
    return df.withColumn(column, masked_id(column, salt))


def _pads(spark: SparkSession, keys: Mapping[int, bytes], versions: Iterable[int]) -> DataFrame:
    """``key_version, _inner, _outer``: a row per key, so that no plan or event log prints a key."""
    rows = [(v, *map(bytearray, hmac_pads(keys[v]))) for v in versions]
    return spark.createDataFrame(rows, "key_version int, _inner binary, _outer binary")


def pseudonymize(
    df: DataFrame, keys: Mapping[int, bytes], column: str = "customer_id", version: int | None = None
) -> DataFrame:
    """Replace ``column`` by its HMAC-SHA256 under a key and add ``key_version``.

    A salted hash of an eight-digit number is found by trying all numbers; without the
    key that isn't possible here. Equal values under one key stay equal, so tables
    masked alike still join. The newest key counts unless ``version`` names another.
    """
    version = max(keys) if version is None else version
    pads = _pads(df.sparkSession, keys, [version])
    masked = df.withColumn("key_version", F.lit(version)).join(F.broadcast(pads), "key_version", "left")  # one row
    masked = masked.withColumn(column, hmac_sha256(F.col(column).cast("string"), F.col("_inner"), F.col("_outer")))
    return masked.select(*df.columns, "key_version")


def key_rotation(
    source: DataFrame, keys: Mapping[int, bytes], old: int, new: int, column: str = "customer_id"
) -> DataFrame:
    """``old_id, new_id, key_version``: pseudonyms of every value of ``source`` under both keys, a written table.

    As secret as the keys: whoever holds it can follow a person across versions.
    """
    values = source.select(F.col(column).cast("string").alias("old_id")).where(F.col("old_id").isNotNull()).distinct()
    pairs = pseudonymize(values.withColumn("new_id", F.col("old_id")), keys, "old_id", old).drop("key_version")
    return keep(pseudonymize(pairs, keys, "new_id", new), "rotation")


def rotate_pseudonyms(df: DataFrame, rotation: DataFrame, column: str = "customer_id") -> DataFrame:
    """Move stored pseudonyms to the new key; a value that ``rotation`` doesn't know keeps its old one."""
    moved = rotation.select(F.col("old_id").alias(column), "new_id", F.col("key_version").alias("_version"))
    joined = df.join(moved, column, "left")
    return joined.withColumns(
        {column: F.coalesce("new_id", column), "key_version": F.coalesce("_version", "key_version")}
    ).select(*df.columns)


def head_rows(df: DataFrame, order: Sequence[Column | str], rows: int) -> DataFrame:
    """First rows in a stated order: each task keeps only its own best few."""
    return df.orderBy(*order).limit(rows)


def seeded_sample(df: DataFrame, rows: int, seed: int, key: Sequence[str] = ("loan_id",)) -> DataFrame:
    """``rows`` rows chosen by a hash of the key: the same ones on any layout."""
    return df.withColumn("_u", unit_hash(key, seed)).orderBy("_u", *key).limit(rows).drop("_u")
