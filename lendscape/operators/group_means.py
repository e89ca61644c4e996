"""Group averages on every row without shuffling the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep


def join_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join on one key where NULL matches NULL.

    No hint: ``lookup`` comes from a written table, so its size is known and
    Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``. Above
    it both sides shuffle and the skew join splits a hot key.
    """
    right = lookup.withColumnRenamed(key, "_lookup_key")
    return df.join(right, F.col(key).eqNullSafe(F.col("_lookup_key")), "left").drop("_lookup_key")


def group_means(df: DataFrame, key: str, measures: dict[str, str]) -> DataFrame:
    """One row per group: ``{output column: averaged column}``."""
    return df.groupBy(key).agg(*[F.avg(source).alias(name) for name, source in measures.items()])


def measured(specs: dict[str, dict[str, str]]) -> list[str]:
    return sorted({s for measures in specs.values() for s in measures.values()})


def group_totals(df: DataFrame, specs: dict[str, dict[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Mergeable sums and counts by all keys of ``specs`` together, and by the columns ``by``."""
    sources = measured(specs)
    return df.groupBy(*by, *specs).agg(
        *[F.sum(s).alias(f"sum_{s}") for s in sources], *[F.count(s).alias(f"n_{s}") for s in sources]
    )


def attach_means(df: DataFrame, totals: DataFrame, specs: dict[str, dict[str, str]]) -> DataFrame:
    """Add the averages that written ``totals`` (any number of rows per group) hold for each key."""
    for key, measures in specs.items():
        means = totals.groupBy(key).agg(
            *[
                F.try_divide(F.sum(f"sum_{s}").cast("double"), F.sum(f"n_{s}")).alias(name)
                for name, s in measures.items()
            ]
        )
        df = join_lookup(df, means, key)
    return df


def attach_group_means(df: DataFrame, specs: dict[str, dict[str, str]]) -> DataFrame:
    """Add group averages for several keys: ``{key: {output: averaged column}}``.

    A window over a handful of groups would put the whole table into a handful
    of tasks. Here one column-pruned pass pre-aggregates sums and counts by all
    keys together; each key's averages are derived from that small table and
    joined back.
    """
    return attach_means(df, keep(group_totals(df, specs), "group-totals"), specs)
