"""Value ladders and bins as column expressions."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {">=": operator.ge, "<": operator.lt, "<=": operator.le}


def ladder(column: Column | str, comparison: str, steps: Sequence[tuple], otherwise) -> Column:
    """First step whose bound the value satisfies; NULL falls to ``otherwise``."""
    value = F.col(column) if isinstance(column, str) else column
    test = _COMPARE[comparison]
    (bound, label), *rest = steps
    chain = F.when(test(value, F.lit(bound)), F.lit(label))
    for bound, label in rest:
        chain = chain.when(test(value, F.lit(bound)), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def lookup(column: Column | str, mapping: dict, otherwise=None) -> Column:
    """Constant per listed value."""
    value = F.col(column) if isinstance(column, str) else column
    pairs = list(mapping.items())
    chain = reduce(lambda c, kv: c.when(value == kv[0], F.lit(kv[1])), pairs[1:],
                   F.when(value == pairs[0][0], F.lit(pairs[0][1])))
    return chain if otherwise is None else chain.otherwise(F.lit(otherwise))


def edge_bin(column: Column | str, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """Number (from 1) of the right-closed interval holding the value, else NULL.

    The first edge itself belongs to no interval unless ``include_lowest``.
    """
    value = F.col(column) if isinstance(column, str) else column
    above = value >= edges[0] if include_lowest else value > edges[0]
    chain = F.when(~above, F.lit(None).cast("int"))
    for number, edge in enumerate(edges[1:], start=1):
        chain = chain.when(value <= edge, F.lit(number))
    return chain


def fixed_width_bin(column: Column | str, low: float, high: float, bins: int) -> Column:
    """Left-closed equal bins over [low, high], the last one closed; outside is NULL."""
    value = F.col(column) if isinstance(column, str) else column
    number = F.floor((value - F.lit(low)) / F.lit((high - low) / bins)).cast("int")
    return F.when(value.between(low, high), F.least(number, F.lit(bins - 1)))


def equal_width_bin(column: Column | str, low: Column, high: Column, bins: int) -> Column:
    """Right-closed equal bins over the observed range; the minimum joins bin 1.

    A constant column has no width: all rows go to the bin just left of the middle.
    """
    value = F.col(column) if isinstance(column, str) else column
    width = (high - low) / F.lit(float(bins))
    number = F.ceil(F.try_divide(value - low, width)).cast("int")
    flat = F.lit((bins + 1) // 2)
    return F.when(value.isNull(), F.lit(None).cast("int")).when(high == low, flat).otherwise(
        F.least(F.greatest(number, F.lit(1)), F.lit(bins))
    )
