from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendscape import fixed_values as V
from lendscape.functions import features as X
from lendscape.functions.binning import edge_bin, equal_width_bin, fixed_width_bin, ladder, lookup
from lendscape.operators.evaluation import risk_rating


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.mark.parametrize("name", sorted(V.LADDERS))
def test_ladder_boundaries(spark, name):
    """Both sides of, and exactly, each threshold, and NULL."""
    column, comparison, steps, otherwise = V.LADDERS[name]
    values = [None] + [bound + delta for bound, _ in steps for delta in (-0.01, 0, 0.01)]

    def expected(v):
        if v is None:
            return otherwise
        for bound, label in steps:
            if {">=": v >= bound, "<": v < bound, "<=": v <= bound}[comparison]:
                return label
        return otherwise

    df = one_column(spark, [None if v is None else float(v) for v in values], "double")
    got = df.select("v", ladder(F.col("v"), comparison, steps, otherwise).alias("label")).collect()
    assert [r.label for r in got] == [expected(r.v) for r in got]


def test_dpd_category(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 1, 30, 31, 60, 61, 90, 91, None)], "current_dpd int")
    assert [r[0] for r in df.select(X.dpd_category()).collect()] == [
        "DPD-30", "Current", "DPD-30", "DPD-30", "DPD-60", "DPD-60", "DPD-90", "DPD-90", "DPD-90+", "DPD-90+",
    ]


def test_risk_rating_keeps_null(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.25,), (0.5,), (0.75,), (None,)], "default_probability double")
    assert [r[0] for r in df.select(risk_rating()).collect()] == [
        "Very Low", "Low", "Medium", "High", "Very High", None,
    ]


def test_lookup(spark):
    df = one_column(spark, ["a", "b", "x", None], "string")
    assert [r[0] for r in df.select(lookup("v", {"a": 1, "b": 2}, 0)).collect()] == [1, 2, 0, 0]
    assert [r[0] for r in df.select(lookup("v", {"a": 1, "b": 2})).collect()] == [1, 2, None, None]


def test_edge_bin_matches_pandas(spark):
    pd = pytest.importorskip("pandas")
    values = [-5, 0, 1, 2, 30, 31, 60, 90, 91, 180, 181]
    for lowest in (False, True):
        cut = pd.cut(pd.Series(values), bins=list(V.DPD_EDGES), include_lowest=lowest, labels=False)
        expected = [None if v != v else int(v) + 1 for v in cut]
        got = one_column(spark, values, "int").select(edge_bin("v", V.DPD_EDGES, lowest).alias("b")).collect()
        assert [r.b for r in got] == expected


@settings(max_examples=15, deadline=None)
@given(
    values=st.lists(st.integers(0, 1000).map(lambda i: i / 64), min_size=1, max_size=40),
    bins=st.integers(2, 12),
)
def test_equal_width_bin_matches_pandas(spark, values, bins):
    pd = pytest.importorskip("pandas")
    cut = pd.cut(pd.Series(values), bins=bins, labels=False)
    df = one_column(spark, values, "double")
    low, high = df.agg(F.min("v")).scalar(), df.agg(F.max("v")).scalar()
    got = df.select("v", equal_width_bin("v", low, high, bins).alias("b")).collect()
    # pandas computes its edges by adding steps, so a value within rounding of an edge may differ
    width = (max(values) - min(values)) / bins
    expected = dict(zip(values, (int(b) + 1 for b in cut)))
    for row in got:
        steps = (row.v - min(values)) / width if width else 0.5
        if abs(steps - round(steps)) > 1e-9 or not width or row.v in (min(values), max(values)):
            assert row.b == expected[row.v]


def test_fixed_width_bin_closes_the_last(spark):
    got = one_column(spark, [299, 300, 319, 320, 899, 900, 901, None], "int").select(
        fixed_width_bin("v", 300, 900, 30).alias("b")
    )
    assert [r.b for r in got.collect()] == [None, 0, 0, 1, 29, 29, None, None]
