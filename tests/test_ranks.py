"""Distributed ranks against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendscape.operators import encoding, evaluation, portfolio
from lendscape.operators import ranks
from lendscape.operators.ranks import exact_quantiles, positions, running_totals


def scores(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double").repartition(4)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8).map(lambda i: i / 8)), min_size=1, max_size=40))
def test_auc(spark, pairs):
    got = evaluation.auc_roc(scores(spark, pairs), "y", "s").first()[0]
    expected = brute_auc(pairs)
    assert got == expected if expected is None else got == pytest.approx(expected)


def test_auc_of_reversed_scores(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 1), rng.randint(0, 50) / 50) for _ in range(400)]
    forward = evaluation.auc_roc(scores(spark, pairs), "y", "s").first()[0]
    backward = evaluation.auc_roc(scores(spark, [(y, 1 - s) for y, s in pairs]), "y", "s").first()[0]
    assert forward == pytest.approx(brute_auc(pairs)) and forward + backward == pytest.approx(1.0)


def test_one_score_holds_a_third_of_all_rows(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 1), 0.5) for _ in range(500)] + [(rng.randint(0, 1), rng.random()) for _ in range(1000)]
    assert evaluation.auc_roc(scores(spark, pairs), "y", "s").first()[0] == pytest.approx(brute_auc(pairs))


def test_roc_curve_ends(spark):
    pairs = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)]
    points = sorted(map(tuple, evaluation.roc_curve(scores(spark, pairs), "y", "s").collect()), key=lambda p: -p[2])
    assert points == [(0.0, 0.0, float("inf")), (0.0, 0.5, 0.9), (0.5, 1.0, 0.8), (1.0, 1.0, 0.1)]


def test_running_totals_over_many_slices(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.randint(1, 9)) for g in "abc" for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i int, m bigint").repartition(7)
    got = running_totals(df, [F.col("i")], ["m"], ["g"]).collect()
    for g in "abc":
        values = sorted((i, m) for h, i, m in rows if h == g)
        expected = dict(zip((i for i, _ in values), np.cumsum([m for _, m in values])))
        assert {r.i: r.cum_m for r in got if r.g == g} == expected
        assert {r.all_m for r in got if r.g == g} == {sum(m for _, m in values)}


def test_positions(spark):
    df = spark.createDataFrame([("x", v) for v in "dbca"] + [("y", "z")], "g string, v string")
    assert sorted((r.g, r.v, r.position) for r in positions(df, ["v"], ["g"]).collect()) == [
        ("x", "a", 1), ("x", "b", 2), ("x", "c", 3), ("x", "d", 4), ("y", "z", 1),
    ]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60))
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None)], "v int, empty int").repartition(3)
    row = exact_quantiles(df, ["v", "empty"], (0.0, 0.25, 0.5, 0.9, 1.0)).collect()
    assert len(row) == 1
    assert list(row[0])[1:] == pytest.approx(list(np.quantile(values, (0.0, 0.25, 0.5, 0.9, 1.0))))


def test_describe_of_constant_column(spark):
    df = spark.range(5).select(F.lit(7).alias("v"))
    row = portfolio.describe_numeric(df, ["v"]).first()
    assert (row["count"], row["mean"], row["std"], row["p25"], row["p75"]) == (5, 7.0, 0.0, 7.0, 7.0)


def test_stratified_split_is_exact_and_repeatable(book):
    def members(df):
        return {r.loan_id for r in encoding.stratified_split(df).where("is_test").collect()}

    first = members(book)
    assert first == members(book.repartition(3))
    sizes = {r.is_default: r["count"] for r in book.groupBy("is_default").count().collect()}
    tested = book.where(F.col("loan_id").isin(list(first))).groupBy("is_default").count().collect()
    assert {r.is_default: r["count"] for r in tested} == {y: round(n * 0.2) for y, n in sizes.items()}


def test_seeded_sample(book):
    from lendscape.operators.selection import seeded_sample

    ids = {r.loan_id for r in seeded_sample(book, 100, 42).collect()}
    assert len(ids) == 100 and ids == {r.loan_id for r in seeded_sample(book.repartition(5), 100, 42).collect()}
    assert ids != {r.loan_id for r in seeded_sample(book, 100, 7).collect()}


def test_stratified_split_cuts_where_ranking_would(book):
    found = {(r["is_default"], r["loan_id"]): r["is_test"] for r in encoding.stratified_split(book).select("is_default", "loan_id", "is_test").collect()}
    rows = book.select("is_default", "loan_id", encoding.unit_hash(["loan_id"], 42).alias("u")).collect()
    for label in (0, 1):
        own = sorted((r["u"], r["loan_id"]) for r in rows if r["is_default"] == label)
        cut = own[round(len(own) * 0.2) - 1][0]
        assert all(found[label, loan] == (u <= cut) for u, loan in own)


def test_profiles_of_versions_do_not_multiply(spark):
    df = spark.createDataFrame([("a", "h1", 1), ("a", "h2", 2), ("a", "h2", 2)], "loan_id string, record_hash string, x int")
    keys = ("loan_id", "record_hash")
    both = portfolio.combine_profiles(df.select(*keys), df, keys=keys)
    assert sorted(tuple(r) for r in both.collect()) == [("a", "h1", 1), ("a", "h2", 2), ("a", "h2", 2)]


@pytest.fixture
def small_brackets(monkeypatch):
    monkeypatch.setattr(ranks, "INSIDE", 8)
    monkeypatch.setattr(ranks, "GRID", 10)
    monkeypatch.setattr(ranks, "SKETCH", 5)  # rough sketches: brackets that miss have to be mended


@pytest.mark.parametrize("seed", range(6))
def test_quantiles_by_brackets(spark, small_brackets, seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(50, 900))
    columns = {
        "spread": rng.normal(size=n),
        "tied": rng.integers(0, 3, n).astype(float),
        "mostly": np.where(rng.random(n) < 0.9, 5.0, rng.normal(size=n)),
        "edges": np.where(rng.random(n) < 0.3, -np.inf, np.where(rng.random(n) < 0.5, np.inf, rng.random(n))),
        "holes": np.where(rng.random(n) < 0.5, None, rng.random(n)),
        "same": np.zeros(n),
    }
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*columns.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(7).cache()
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.77, 1.0)
    got = ranks.column_profile(df, list(columns), probabilities)
    for c, values in columns.items():
        own = np.array([v for v in values if v is not None], float)
        order = np.sort(own)
        for p, q in zip(probabilities, got[c]["quantiles"]):
            position = (len(own) - 1) * p
            low, high = order[int(np.floor(position))], order[int(np.ceil(position))]
            want = low if low == high else low + (high - low) * (position - np.floor(position))
            assert q == pytest.approx(want, nan_ok=True)
        assert (got[c]["count"], got[c]["min"], got[c]["max"]) == (len(own), order[0], order[-1])
        if c != "edges":
            assert got[c]["mean"] == pytest.approx(own.mean()) and got[c]["std"] == pytest.approx(own.std(ddof=1))


def test_profile_of_odd_columns(spark, small_brackets):
    df = spark.createDataFrame([(1.0, float("nan"), None, 3), (2.0, 1.0, None, 3)], "a double, b double, c double, d int")
    got = ranks.column_profile(df, ["a", "b", "c", "d"], (0.0, 0.5, 1.0))
    assert got["a"]["quantiles"] == [1.0, 1.5, 2.0] and got["d"]["quantiles"] == [3, 3, 3]
    assert got["b"]["quantiles"][0] == 1.0 and np.isnan(got["b"]["quantiles"][2]) and np.isnan(got["b"]["max"])
    assert got["c"] == {"count": 0, "mean": None, "std": None, "min": None, "max": None, "quantiles": [None] * 3}
    assert ranks.column_profile(df.limit(0), ["a"], (0.5,))["a"]["count"] == 0


def test_brackets_among_many_values(spark, small_brackets):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    assert ranks.column_profile(df, ["v"], (0.5,))["v"]["quantiles"] == [9999.5]
