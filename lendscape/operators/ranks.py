"""Running totals and exact quantiles without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import keep


def running_totals(
    df: DataFrame, order: Sequence[Column], measures: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<measure>``, the inclusive running total along ``order``, and
    ``all_<measure>``, the group's total.

    Rows are range-partitioned along the order, so that slices are balanced
    however the values are spread. Each slice is summed, the few slice totals
    are accumulated, and every row adds its slice's offset to the total inside
    the slice. Slice numbers are written before use: range bounds are sampled
    and must not be drawn twice. Give one row per order value, and no NULL in
    the ``within`` columns.
    """
    order, within = list(order), list(within)
    sliced = keep(
        df.repartitionByRange(*[F.col(w) for w in within], *order).withColumn(
            "_slice", F.spark_partition_id()
        ),
        "slices",
    )
    parts = [*within, "_slice"]
    # one row per slice, and one more where a group starts inside a slice
    group = Window.partitionBy(*within)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*parts)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *parts,
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
            *[F.sum(m).over(group).alias(f"all_{m}") for m in measures],
        )
    )
    inside = (
        Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.join(offsets, parts)
        .withColumns({f"cum_{m}": F.sum(m).over(inside) + F.col(f"_off_{m}") for m in measures})
        .drop("_slice", *[f"_off_{m}" for m in measures])
    )


# Exact quantiles by bracketing. A scan sketches all columns at once; the next ones
# count exactly what lies below and inside a narrow bracket around each rank asked
# for, and sketch its inside; the few values left at the end are ranked.
GROUPS = 64  # partial results, so that no task merges the sketches of all others
GRID = 100  # values that a sketch is asked for
SKETCH = 1000  # accuracy of a sketch; it decides how fast brackets shrink, not what comes out
INSIDE = 250_000  # values in a bracket that are few enough to be ranked


@dataclass
class Bracket:
    """The value of 0-based rank ``rank`` lies strictly between two others (None: unbounded)."""

    column: str
    rank: int
    inner: int  # values between the bounds
    base: int = 0  # values up to the lower bound
    low: float | None = None
    high: float | None = None
    grid: list[tuple[float, float]] | None = None  # values between the bounds, and roughly which part is below
    value: float | None = None

    def settle(self, low, high, lt_low, le_low, lt_high, le_high, grid) -> None:
        """Take in exact counts at two values inside the bracket."""
        if low is not None and self.rank < lt_low:
            self.high, self.inner, self.grid = low, lt_low - self.base, None
        elif low is not None and self.rank < le_low:
            self.value = low
        elif high is None or self.rank < lt_high:
            top = self.base + self.inner if high is None else lt_high
            if low is not None:
                self.low, self.base = low, le_low
            self.high, self.inner, self.grid = (self.high if high is None else high), top - self.base, grid
        elif self.rank < le_high:
            self.value = high
        else:
            top = self.base + self.inner
            self.low, self.base, self.inner, self.grid = high, le_high, top - le_high, None

    def narrow(self) -> tuple[float | None, float | None]:
        """Two values around the rank, from the grid; None where the bound stays."""
        if not self.grid:
            return None, None
        share, slack = (self.rank - self.base) / self.inner, 3 / GRID
        below = [v for v, part in self.grid if part < share - slack]
        above = [v for v, part in self.grid if part > share + slack]
        return (max(below) if below else None), (min(above) if above else None)


def _numbers(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _between(x: Column, low: float | None, high: float | None) -> Column:
    inside = x.isNotNull()
    if low is not None:
        inside = inside & (x > F.lit(low))
    return inside if high is None else inside & (x < F.lit(high))


def _sketch(x: Column, inside: Column) -> Column:
    return F.percentile_approx(F.when(inside, x), [i / GRID for i in range(GRID + 1)], SKETCH)


def _scan(df: DataFrame, aggregates: Sequence[Column]) -> list[Row]:
    """Partial aggregates over groups of partitions: at most ``GROUPS`` rows."""
    return df.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group")).agg(*aggregates).collect()


def _merged(grids: Sequence[tuple[list[float] | None, int]]) -> list[tuple[float, float]]:
    """Values of several grids in order, each with the part of all rows that is roughly below."""
    points = sorted((v, n / (GRID + 1)) for grid, n in grids if grid for v in grid)
    total, seen, merged = sum(w for _, w in points), 0.0, []
    for value, weight in points:
        merged.append((value, seen / total))
        seen += weight
    return merged


def _answers(df: DataFrame, brackets: list[Bracket]) -> None:
    """Rank the values inside narrow brackets."""
    bounds = sorted({(b.column, b.low, b.high) for b in brackets}, key=str)
    parts = [
        F.when(_between(_numbers(c), low, high), F.struct(F.lit(i).alias("id"), _numbers(c).alias("x")))
        for i, (c, low, high) in enumerate(bounds)
    ]
    rows = df.select(F.explode(F.filter(F.array(*parts), lambda s: s.isNotNull())).alias("s")).select("s.*")
    counted = rows.groupBy("id", "x").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("id").orderBy("x"))
    asked = [(bounds.index((b.column, b.low, b.high)), b.rank - b.base) for b in brackets]
    wanted = df.sparkSession.createDataFrame(sorted(set(asked)), "own int, r long")
    ranked = counted.withColumn("upto", upto).join(F.broadcast(wanted), F.col("id") == F.col("own"))
    found = ranked.where((F.col("upto") - F.col("n") <= F.col("r")) & (F.col("r") < F.col("upto"))).collect()
    values = {(r["id"], r["r"]): r["x"] for r in found}
    for bracket, key in zip(brackets, asked):
        bracket.value = values[key]


def column_profile(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], moments: bool = True
) -> dict[str, dict]:
    """Per column ``count``, exact ``quantiles`` and, if asked for, ``mean, std, min, max``.

    NULLs are left out; NaN counts and ranks as the largest value. ``df`` is
    scanned once for moments and sketches and a few times for the brackets.
    """
    columns = list(dict.fromkeys(columns))
    own = {c: f"_{i}" for i, c in enumerate(columns)}
    aggregates = []
    for c, k in own.items():
        v, x = F.col(c).cast("double"), _numbers(c)
        aggregates += [F.count(v).alias(f"n{k}"), F.count(x).alias(f"m{k}"), _sketch(x, x.isNotNull()).alias(f"g{k}")]
        if moments:
            aggregates += [F.avg(v).alias(f"a{k}"), F.var_pop(v).alias(f"s{k}"), F.min(v).alias(f"l{k}"), F.max(v).alias(f"h{k}")]
    rows = _scan(df, aggregates)
    profile, brackets = {}, []
    for c, k in own.items():
        count, numbers = (sum(r[f"{s}{k}"] for r in rows) for s in "nm")
        grid = _merged([(r[f"g{k}"], r[f"m{k}"]) for r in rows])
        profile[c] = {"count": count}
        if moments:
            profile[c] |= _moments([(r[f"n{k}"], r[f"a{k}"], r[f"s{k}"], r[f"l{k}"], r[f"h{k}"]) for r in rows if r[f"n{k}"]])
        ranks = {f((count - 1) * p) for p in probabilities for f in (math.floor, math.ceil)} if count else set()
        for rank in sorted(ranks):
            value = math.nan if rank >= numbers else None
            brackets.append(Bracket(c, rank, numbers, grid=grid, value=value))
    while wide := [b for b in brackets if b.value is None and b.inner > INSIDE]:
        steps = [(b, *b.narrow()) for b in wide]
        cuts = sorted({(b.column, b.low, b.high, low, high) for b, low, high in steps}, key=str)  # ranks side by side share one
        aggregates = []
        for i, (c, least, most, low, high) in enumerate(cuts):
            x = _numbers(c)
            if low is not None:
                aggregates += [F.count_if(x < F.lit(low)).alias(f"a{i}"), F.count_if(x <= F.lit(low)).alias(f"b{i}")]
            if high is not None:
                aggregates += [F.count_if(x < F.lit(high)).alias(f"c{i}"), F.count_if(x <= F.lit(high)).alias(f"d{i}")]
            inside = _between(x, least if low is None else low, most if high is None else high)
            aggregates += [F.count_if(inside).alias(f"m{i}"), _sketch(x, inside).alias(f"g{i}")]
        rows = _scan(df, aggregates)
        grids = [_merged([(r[f"g{i}"], r[f"m{i}"]) for r in rows]) for i in range(len(cuts))]
        for b, low, high in steps:
            i = cuts.index((b.column, b.low, b.high, low, high))
            at = [0 if y is None else sum(r[f"{name}{i}"] for r in rows) for name, y in zip("abcd", (low, low, high, high))]
            b.settle(low, high, *at, grids[i])
    if narrow := [b for b in brackets if b.value is None]:
        _answers(df, narrow)
    values = {(b.column, b.rank): b.value for b in brackets}
    for c in columns:
        count, found = profile[c]["count"], []
        for p in probabilities:
            position = (count - 1) * p
            if not count:
                found.append(None)
                continue
            low, high = values[c, math.floor(position)], values[c, math.ceil(position)]
            found.append(low if low == high else low + (high - low) * (position - math.floor(position)))
        profile[c]["quantiles"] = found
    return profile


def _moments(parts: list[tuple[int, float, float, float, float]]) -> dict:
    """Mean, standard deviation, least and largest value from those of parts."""
    count = sum(n for n, *_ in parts)
    if not count:
        return {"mean": None, "std": None, "min": None, "max": None}
    mean = sum(n * a for n, a, *_ in parts) / count
    squares = sum(n * s + n * (a - mean) ** 2 for n, a, s, *_ in parts)
    least = min((x for *_, x, _ in parts), key=lambda v: (math.isnan(v), v))
    largest = max((x for *_, x in parts), key=lambda v: (math.isnan(v), v))
    return {"mean": mean, "std": math.sqrt(squares / (count - 1)) if count > 1 else None, "min": least, "max": largest}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles: ``feature, q0, q1, …`` in the given order; no row without values."""
    profile = column_profile(df, columns, probabilities, moments=False)
    rows = [(c, *p["quantiles"]) for c, p in profile.items() if p["count"]]
    names = ", ".join(f"q{i} double" for i in range(len(probabilities)))
    return df.sparkSession.createDataFrame(rows, f"feature string, {names}")


def positions(df: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Add ``position`` (from 1) along the order in each group; rows must be distinct in it."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(counted, [F.col(name) for name in order], ["_one"], within)
    return ranked.withColumnRenamed("cum__one", "position").drop("_one", "all__one")
