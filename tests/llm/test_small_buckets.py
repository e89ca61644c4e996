from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from lendscape.llm import near_duplicates as near


def test_pairs_of_small_buckets(spark):
    rng = np.random.default_rng(2)
    rows = sorted({(int(k), int(n)) for k, n in zip(rng.integers(0, 30, 150), rng.integers(0, 40, 150))})
    few = spark.createDataFrame([(k, n, n // 3) for k, n in rows], "key long, node long, component long")
    tested = {(a, b) for a, b in combinations(range(40), 2) if (a + b) % 5 == 0}
    done = spark.createDataFrame(sorted(tested), "a long, b long")
    wanted = {p for key in range(30) for p in combinations(sorted(n for k, n in rows if k == key), 2) if p[0] // 3 != p[1] // 3} - tested
    found = [tuple(r) for r in near._few_pairs(few, [done]).collect()]
    assert len(found) == len(set(found)) and set(found) == wanted and wanted


def test_what_chance_ties_together_is_not_held_against_each_other(spark, monkeypatch):
    """A chain of texts, each half like the next: all hang together, no bucket is large."""
    rng, words = np.random.default_rng(4), [f"w{i}" for i in range(4000)]
    texts = [" ".join(words[i * 12 : i * 12 + 40]) for i in range(300)]
    texts += [" ".join(rng.permutation(words[:60])) for _ in range(20)] + texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes, rest = [], near._rest_links

    def watched(left, sets, limit_pct):
        sizes.extend(r["count"] for r in left.groupBy("key").count().collect())
        return rest(left, sets, limit_pct)

    monkeypatch.setattr(near, "_rest_links", watched)
    results = []
    for few in (near.FEW, 1, 10**6):
        monkeypatch.setattr(near, "FEW", few)
        sizes.clear()
        # a limit below the chain's likeness of about a half leaves much to compare
        results.append({tuple(r) for r in near.near_duplicates(docs, width=2, limit_pct=55).collect()})
        assert all(n > few for n in sizes)
    assert results[0] == results[1] == results[2] and len(results[0]) == len(texts)
    assert spark.createDataFrame(list(results[0])).where(F.col("_4")).count() <= 320
