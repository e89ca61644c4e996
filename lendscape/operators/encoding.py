"""Feature preparation: selection, label codes, imputation, split, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.keys import unit_hash
from ..session import keep
from .group_means import join_lookup
from .portfolio import medians
from .ranks import positions
from .selection import existing_columns

FEATURE_SETS = {
    "full": (V.FULL_NUMERIC, V.FULL_CATEGORICAL),
    "recorded": (V.RECORDED_NUMERIC, V.RECORDED_CATEGORICAL),
    "smoke": (V.SMOKE_NUMERIC, V.SMOKE_CATEGORICAL),
}
MISSING_CATEGORY = "None"
HALF = 2.0**14  # the hash has 28 bits: two counting passes of 14 find a value


def feature_lists(name: str = "recorded", leak_free: bool = False) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names; ``leak_free`` drops what restates the label."""
    numeric, categorical = FEATURE_SETS[name]
    drop = set(V.LABEL_LEAKS) if leak_free else set()
    return [n for n in numeric if n not in drop], [n for n in categorical if n not in drop]


def select_features(df: DataFrame, name: str = "recorded", extra: Sequence[str] = (V.TARGET,)) -> DataFrame:
    numeric, categorical = feature_lists(name)
    return existing_columns(df, [*extra, *numeric, *categorical])


def as_category(column: str) -> Column:
    """Categories are texts; a missing one is a category of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING_CATEGORY))


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, code``: distinct values of each column in text order, from 0."""
    values = (
        df.select(*[as_category(name).alias(name) for name in columns])
        .unpivot([], list(columns), "feature", "value")
        .distinct()
    )
    ranked = positions(values, ["value"], ["feature"])
    return ranked.select("feature", "value", (F.col("position") - 1).cast("int").alias("code"))


def encode_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_code``."""
    codes = keep(label_codes(df, columns), "label-codes")
    for name in columns:
        own = codes.where(F.col("feature") == name).select(
            F.col("value").alias(f"_{name}"), F.col("code").alias(f"{name}_code")
        )
        df = df.join(own, as_category(name) == F.col(f"_{name}"), "left").drop(f"_{name}")
    return df


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column: one number each."""
    return {row["feature"]: row["median"] for row in medians(df, columns).collect()}


def impute(df: DataFrame, fitted: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in fitted.items()})


def hash_split(
    df: DataFrame,
    key: Sequence[str] = ("loan_id",),
    share: float = V.TEST_SHARE,
    seed: int = V.SPLIT_SEED,
    name: str = "is_test",
) -> DataFrame:
    """Add ``name`` by a hash of the key: no shuffle, ``share`` of each class up to chance."""
    return df.withColumn(name, unit_hash(key, seed) < F.lit(share))


def _counts_in_order(counts: DataFrame, groups: Sequence[str], by: str) -> DataFrame:
    """``groups, cells``: the counts of a group as an array in the order of ``by``."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(by).cast("long").alias("at"), "n")))
    return counts.groupBy(*groups).agg(cells.alias("cells"))


def _where_reached(before: Column) -> Column:
    """Struct of the first cell at which ``before`` and the counts so far reach ``_wanted``, and the total ahead of it."""

    def step(state: Column, cell: Column) -> Column:
        found = state["at"].isNotNull()
        reached = state["before"] + cell["n"] >= F.col("_wanted")
        return F.struct(
            F.when(found | reached, state["before"]).otherwise(state["before"] + cell["n"]).alias("before"),
            F.when(found, state["at"]).when(reached, cell["at"]).alias("at"),
        )

    start = F.struct(before.alias("before"), F.lit(None).cast("long").alias("at"))
    return F.aggregate("cells", start, step)


def stratified_split(
    df: DataFrame,
    label: str = V.TARGET,
    key: Sequence[str] = ("loan_id",),
    share: float = V.TEST_SHARE,
    seed: int = V.SPLIT_SEED,
) -> DataFrame:
    """Add ``is_test`` so that ``share`` of every class, to the row, is test data.

    Each class is cut at the hash value of its last test row. One pass counts
    rows by the upper half of the hash, a second one by the lower half where
    the cut lies: at most 2**14 counts per class, and rows are neither ranked
    nor moved. Rows that share the cut's hash value stay together. A row
    without a label is neither training nor test data: its ``is_test`` is NULL.
    """
    number = unit_hash(key, seed) * F.lit(HALF * HALF)
    hashed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_label"), F.floor(number / F.lit(HALF)).alias("_upper"), (number % F.lit(HALF)).cast("long").alias("_lower")
    )
    totals = _counts_in_order(hashed.groupBy("_label", "_upper").agg(F.count(F.lit(1)).alias("n")), ["_label"], "_upper")
    wanted = F.round(F.aggregate("cells", F.lit(0).cast("long"), lambda n, x: n + x["n"]) * F.lit(share)).cast("long")
    upper = keep(
        totals.withColumn("_wanted", wanted)
        .withColumn("_at", _where_reached(F.lit(0).cast("long")))
        .select("_label", "_wanted", F.col("_at.at").alias("_upper"), F.col("_at.before").alias("_before")),
        "split-upper",
    )
    inside = hashed.join(upper, ["_label", "_upper"])
    groups = ["_label", "_upper", "_wanted", "_before"]
    lower = _counts_in_order(inside.groupBy(*groups, "_lower").agg(F.count(F.lit(1)).alias("n")), groups, "_lower")
    cut = (F.col("_upper") * F.lit(HALF) + _where_reached(F.col("_before"))["at"]) / F.lit(HALF * HALF)
    cuts = keep(lower.select(F.col("_label").alias(label), cut.alias("_cut")), "split-cuts")
    return join_lookup(df, cuts, label).withColumn("is_test", unit_hash(key, seed) <= F.col("_cut")).drop("_cut")


def class_weights(df: DataFrame, label: str = V.TARGET) -> DataFrame:
    """Add ``weight``: positives weigh negatives / positives, negatives 1."""
    positives = F.sum(label)
    ratio = df.agg(F.try_divide((F.count(label) - positives).cast("double"), positives)).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))
