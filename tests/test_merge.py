"""Bucketed merge, batches that don't fit, profiles with repeated keys."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from lendscape.operators import portfolio, versions
from lendscape.schema import LOAN_COLUMNS
from lendscape.sources import files, tables
from lendscape.sources.derived_loans import second_batch
from lendscape.streaming.ingest import ingest_stream, stream_parquet


def stamped(df, at="2001-12-30"):
    return files.with_audit(df, LOAN_COLUMNS, at=at, origin="test")


@pytest.fixture
def name(spark):
    free = f"bronze_{uuid.uuid4().hex}"
    yield free
    spark.sql(f"DROP TABLE IF EXISTS {free}")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("few", [0, 10**6])
def test_bucketed_merge_equals_the_merge_by_folder(spark, book, folder, name, monkeypatch, few):
    monkeypatch.setattr(versions, "FEW", few)
    first, later = stamped(book), stamped(second_batch(book), "2001-12-31")
    for batch, how in ((first, "created"), (later, "merged"), (later, "merged")):
        assert tables.write_bucketed(batch, name, f"{folder}/b", buckets=8) == how
        tables.write_to_bronze(batch, f"{folder}/plain")
    assert rows(spark.table(name)) == rows(tables.read_table(spark, f"{folder}/plain"))
    assert tables.bucket_spec(spark, name) == (8, "record_hash")


def test_bucketed_target_is_not_shuffled(spark, book, folder, name, monkeypatch):
    monkeypatch.setattr(versions, "FEW", 0)
    tables.write_bucketed(stamped(book), name, f"{folder}/b", buckets=8)
    values = stamped(second_batch(book)).select("record_hash").distinct()
    values.write.parquet(f"{folder}/values")
    values = spark.read.parquet(f"{folder}/values")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = versions.held_keys(values, spark.table(name))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Exchange" in line]
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    target = next(i for i in scans if "SelectedBucketsCount: 8 out of 8" in lines[i])
    values = next(i for i in scans if i != target)
    # the one shuffle stands over the scan of the values, below the target's
    assert len(scans) == 2 and len(shuffles) == 1 and target < shuffles[0] < values


def test_few_values_read_few_buckets(spark, book, folder, name):
    tables.write_bucketed(stamped(book), name, f"{folder}/b", buckets=64)
    one = stamped(book).select("record_hash").limit(1)
    plan = versions.held_keys(one, spark.table(name))._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 64" in plan


def test_bucketed_merge_of_null_keys_and_repeated_rows(spark, folder, name):
    batch = spark.createDataFrame([(None, "a"), ("1", None), (None, None), ("1", "a"), ("1", "a")], "loan_id STRING, record_hash STRING")
    for _ in range(2):
        tables.write_bucketed(batch, name, f"{folder}/b", buckets=4)
    assert rows(spark.table(name)) == rows(batch)
    more = spark.createDataFrame([(None, "a"), ("2", None), ("2", "a")], batch.schema)
    tables.write_bucketed(more, name)
    assert rows(spark.table(name)) == rows(batch.unionAll(more.where("loan_id = '2'")))
    tables.write_bucketed(more.limit(0), name)
    assert spark.table(name).count() == 7


def test_attached_table_goes_on(spark, book, folder, name):
    tables.write_bucketed(stamped(book), name, f"{folder}/b", buckets=8)
    spark.sql(f"DROP TABLE {name}")
    tables.attach_bucketed(spark, name, f"{folder}/b", buckets=8)
    tables.write_bucketed(stamped(book), name)
    assert spark.table(name).count() == book.count()


def test_stream_into_buckets(spark, book, folder, name):
    stamped(book).repartition(3).write.parquet(f"{folder}/in")
    for turn in range(2):
        stream = stream_parquet(spark, f"{folder}/in", files_per_batch=1)
        write = lambda batch, table: tables.write_bucketed(batch, table, f"{folder}/b", buckets=4)
        ingest_stream(stream, name, f"{folder}/progress{turn}", write=write).awaitTermination()
    assert rows(spark.table(name).select("loan_id", "record_hash")) == rows(stamped(book).select("loan_id", "record_hash"))


@pytest.mark.parametrize("bucketed", [False, True])
def test_batch_with_other_columns_is_refused(spark, book, folder, name, bucketed):
    def write(df):
        return tables.write_bucketed(df, name, f"{folder}/b", buckets=4) if bucketed else tables.write_to_bronze(df, f"{folder}/p")

    good = stamped(book)
    write(good)
    for bad, why in (
        (good.drop("age"), "age is missing"),
        (good.withColumn("extra", F.lit(1)), "extra is not in the table"),
        (good.withColumn("age", F.col("age").cast("string")), "age is string"),
    ):
        with pytest.raises(ValueError, match=why):
            write(bad)
    assert write(good.select(*reversed(good.columns))) == "merged"


def test_profiles_refuse_different_rows_of_one_key(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k INT, b STRING")
    other = spark.createDataFrame([(1, 10), (1, 10), (2, None), (None, 1), (None, 2)], "k INT, v INT")
    met = portfolio.combine_profiles(base, other, keys=("k",))
    assert sorted(map(tuple, met.collect())) == [(1, "x", 10), (2, "y", None)]
    versioned = spark.createDataFrame([(1, 10), (1, 11)], "k INT, v INT")
    with pytest.raises(Exception, match="several rows for one k"):
        portfolio.combine_profiles(base, versioned, keys=("k",)).collect()


def test_batch_sent_again_is_not_moved(spark):
    """No join of the rows: their keys are all known."""
    rows = [("a", "0a1b"), ("b", None), (None, "zz"), ("a", "0A1B")]
    held = spark.createDataFrame([(*r, 1) for r in rows], "loan_id string, record_hash string, v int")
    again = versions.unmatched(held, held)
    assert again.isEmpty() and "Join" not in again._jdf.queryExecution().analyzed().toString()
    more = held.unionAll(spark.createDataFrame([("a", "0a1c", 2), (None, None, 3)], held.schema))
    assert {r.v for r in versions.unmatched(more, held).collect()} == {2, 3}
    assert {r.v for r in versions.unmatched(more, held.where("loan_id = 'b'")).collect()} == {1, 2, 3}


def test_write_once_adds_one_row_per_key(spark, folder):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), ("b", None)], "loan_id string, record_hash string")
    tables.write_to_bronze(df.where("loan_id = 'a'"), f"{folder}/t", partitions=(), once=True)
    tables.write_to_bronze(df, f"{folder}/t", partitions=(), once=True)
    assert sorted(map(str, spark.read.parquet(f"{folder}/t").collect())) == sorted(map(str, df.distinct().collect()))
