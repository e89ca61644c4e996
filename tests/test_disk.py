from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from lendscape import session
from lendscape.sources import tables
from lendscape.streaming import ingest, metrics


def kept(spark) -> set[str]:
    return {p.name for p in Path(session.shared_folder(spark).removeprefix("file:")).iterdir()}


def batch(spark, low, high):
    return spark.range(low, high).select(F.col("id").cast("string").alias("loan_id"), F.sha1(F.col("id").cast("string")).alias("record_hash"))


def test_a_merge_leaves_no_keys_behind(spark, folder):
    tables.write_to_bronze(batch(spark, 0, 50), f"{folder}/t", partitions=())
    before = kept(spark)
    assert tables.write_to_bronze(batch(spark, 20, 80), f"{folder}/t", partitions=()) == "merged"
    assert tables.write_to_bronze(batch(spark, 60, 80), f"{folder}/t", partitions=()) == "merged"
    assert kept(spark) == before
    assert spark.read.parquet(f"{folder}/t").select("loan_id").distinct().count() == spark.read.parquet(f"{folder}/t").count() == 80


def test_only_what_is_kept_inside_passes(spark):
    outer = session.keep(spark.range(3), "outer")
    with session.passing(spark):
        with session.passing(spark):
            inner = session.keep(spark.range(4), "inner")
            assert inner.count() == 4
        middle = session.keep(spark.range(5), "middle")
        assert middle.count() == 5
    names = kept(spark)
    assert not any(n.startswith(("inner-", "middle-")) for n in names) and outer.count() == 3


def test_shuffle_files_go_with_their_batch(spark, folder, monkeypatch):
    released = []
    monkeypatch.setattr(metrics, "release", lambda s: released.append(s))
    for k in range(3):
        batch(spark, 10 * k, 10 * k + 15).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = ingest.stream_parquet(spark, f"{folder}/in", files_per_batch=1)
    metrics.merge_files(stream, f"{folder}/out", f"{folder}/progress").awaitTermination()
    assert len(released) >= 3 and spark.read.parquet(f"{folder}/out").count() == 35
