"""Streams give what the batch jobs give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendscape.operators import features
from lendscape.operators.modelling import score_new_loans, train_default_model
from lendscape.plans import queries
from lendscape.schema import LOAN_COLUMNS
from lendscape.sources import files, tables
from lendscape.sources.derived_loans import AS_OF, dirty_loans
from lendscape.streaming import ingest, metrics


@pytest.fixture
def arrivals(spark, book, folder):
    """Four files in order of application, then one with the first loans again."""
    path = f"{folder}/arrivals"
    ordered = book.repartitionByRange(4, "application_date")
    ordered.sortWithinPartitions("application_date").write.parquet(f"{folder}/ordered")
    from pathlib import Path

    Path(path).mkdir()
    parts = sorted(Path(f"{folder}/ordered").glob("*.parquet"))
    for number, part in enumerate([*parts, parts[0]]):
        copy = Path(path) / f"{number}.parquet"
        copy.write_bytes(part.read_bytes())
        import os

        os.utime(copy, (1_000_000_000 + number, 1_000_000_000 + number))
    return path


def one_by_one(spark, path):
    return ingest.stream_parquet(spark, path, files_per_batch=1)


def test_ingest_is_idempotent(spark, book, arrivals, folder):
    for attempt in range(2):
        stream = files.with_audit(one_by_one(spark, arrivals), LOAN_COLUMNS)
        ingest.ingest_stream(stream, f"{folder}/bronze", f"{folder}/progress{attempt}").awaitTermination()
    assert spark.read.parquet(f"{folder}/bronze").count() == book.count()


def test_ingest_with_quarantine(spark, book, arrivals, folder):
    for attempt in range(2):
        stream = files.with_audit(dirty_loans(one_by_one(spark, arrivals)), LOAN_COLUMNS)
        ingest.ingest_stream(
            stream, f"{folder}/bronze", f"{folder}/progress{attempt}", quarantine=f"{folder}/set_aside", as_of=AS_OF
        ).awaitTermination()
    good, bad = spark.read.parquet(f"{folder}/bronze").count(), spark.read.parquet(f"{folder}/set_aside").count()
    assert bad > 0 and good + bad == book.count()


def test_csv_folder(spark, book, folder):
    files.write_csv(book.repartition(3), f"{folder}/csv")
    stream = ingest.stream_csv(spark, f"{folder}/csv", files_per_batch=1)
    ingest.ingest_stream(stream, f"{folder}/bronze", f"{folder}/progress").awaitTermination()
    got = tables.read_bronze(spark, f"{folder}/bronze")
    assert got.count() == book.count()
    expected = files.with_audit(book, LOAN_COLUMNS, origin="x").select("record_hash")
    assert got.select("record_hash").exceptAll(expected).count() == 0


def test_late_rows_are_dropped_and_closed_windows_equal_batch(spark, book, arrivals, folder):
    timed = metrics.with_event_time(one_by_one(spark, arrivals), delay="30 days")
    metrics.to_files(metrics.windowed_metrics(timed), f"{folder}/out", f"{folder}/progress").awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    last = book.select(F.max("application_date").cast("timestamp")).first()[0]
    batch = metrics.windowed_metrics(book.withColumn("event_time", F.col("application_date").cast("timestamp")))
    closed = batch.where(F.col("end") <= F.lit(last) - F.expr("INTERVAL 30 DAYS"))
    names = ["start", "loan_purpose", "loans", "amount"]
    assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, closed.select(*names).collect()))


def test_windows_lose_no_late_row(spark, book, folder):
    """Newest dates first, one file per micro-batch."""
    for number, part in enumerate(["2100-01-01", "1996-01-01", "1994-06-01", "1993-01-01"]):
        low = ["1996-01-01", "1994-06-01", "1993-01-01", "1900-01-01"][number]
        rows = book.where((F.col("application_date") >= low) & (F.col("application_date") < part))
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    metrics.collect_windows(one_by_one(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/progress").awaitTermination()
    got = metrics.read_windows(spark, f"{folder}/out")
    batch = metrics.windowed_metrics(book.withColumn("event_time", F.col("application_date").cast("timestamp")))
    names = ["start", "end", "loan_purpose", "loans", "amount", F.round("default_rate", 9)]
    assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, batch.select(*names).collect()))
    assert got.agg(F.sum("loans")).first()[0] == book.count()


@pytest.mark.parametrize("spread", [1, 16])
def test_resent_records_are_dropped(spark, book, folder, spread):
    book.orderBy(F.desc("application_date")).coalesce(1).write.parquet(f"{folder}/in")
    book.repartition(4).write.mode("append").parquet(f"{folder}/in")
    book.unionByName(book).repartition(3).write.mode("append").parquet(f"{folder}/in")
    stream = files.with_audit(one_by_one(spark, f"{folder}/in"), LOAN_COLUMNS)
    timed = metrics.with_arrival_time(stream)
    out = metrics.drop_resent(timed, spread=spread)
    metrics.to_files(out, f"{folder}/out", f"{folder}/progress").awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == book.count() == got.select("loan_id").distinct().count()


def test_whole_rows_are_shuffled_and_remembered_once(book, spark, folder):
    book.write.parquet(f"{folder}/in")
    timed = metrics.with_arrival_time(files.with_audit(one_by_one(spark, f"{folder}/in"), LOAN_COLUMNS))
    plan = metrics.drop_resent(timed)._jdf.queryExecution().logical().toString()
    assert plan.count("DeduplicateWithinWatermark") == 1


def test_copies_are_thinned_where_they_are_read(spark):
    rows = spark.range(30_000, numPartitions=1).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("loan_id"),
        F.when(F.col("id") % 3 > 1, F.lit("x")).alias("record_hash"),
        F.timestamp_seconds(30_000 - F.col("id")).alias("event_time"),
    )
    left = rows.where(metrics._newest_copy()(F.col("event_time"), "loan_id", "record_hash"))
    got = {(r[0], r[1]): (r[2], r[3]) for r in left.groupBy("loan_id", "record_hash").agg(
        F.count("*"), F.unix_seconds(F.max("event_time"))).collect()}
    assert set(got) == {(None, None), ("hot", None), ("hot", "x")}
    assert all(number <= 4 and newest > 29_990 for number, newest in got.values())


def test_a_late_copy_does_not_take_a_timely_one_along(spark, folder):
    import os
    from pathlib import Path

    late = [("b", "2000-01-01"), ("b", "2000-03-02"), ("c", "2000-01-01")]
    # the watermark of one micro-batch makes rows late in the next but one
    for number, rows in enumerate([[("a", "2000-03-01")], [("d", "2000-03-01")], late]):
        df = spark.createDataFrame([(i, i, d) for i, d in rows], "loan_id string, record_hash string, day string")
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        for part in Path(f"{folder}/in").glob("*.parquet"):
            if part.stat().st_mtime > 1_100_000_000:
                os.utime(part, (1_000_000_000 + number, 1_000_000_000 + number))
    timed = metrics.with_event_time(one_by_one(spark, f"{folder}/in"), "day", delay="1 day")
    metrics.to_files(metrics.drop_resent(timed), f"{folder}/out", f"{folder}/progress").awaitTermination()
    got = spark.read.parquet(f"{folder}/out").select("loan_id", "day").collect()
    assert sorted(map(tuple, got)) == [("a", "2000-03-01"), ("b", "2000-03-02"), ("d", "2000-03-01")]


def test_pieces_are_spread_over_files(spark, sf_dir):
    paths = spark.read.parquet(queries.pieces(spark, sf_dir)).select("o_orderkey", "_metadata.file_path")
    assert paths.select("file_path").distinct().count() == 4 * queries.FILES
    assert paths.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()


def test_alerts_of_a_replayed_batch_are_replaced(spark, arrivals, folder):
    for attempt in range(2):
        stream = dirty_loans(one_by_one(spark, arrivals))
        ingest.quality_stream(stream, f"{folder}/alerts", f"{folder}/progress{attempt}", AS_OF).awaitTermination()
    alerts = spark.read.parquet(f"{folder}/alerts")
    assert alerts.count() == alerts.select("batch_id", "check").distinct().count() > 0
    assert alerts.where("passed").count() == 0


def test_streamed_scores_equal_batch_scores(spark, book, folder):
    rows = features.engineer_row_features(book, AS_OF).withColumn("is_test", F.col("credit_score") % 5 == 0)
    rows.repartition(2).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    model = train_default_model(rows, features="smoke", rounds=3, depth=3)
    stream = ingest.stream_parquet(spark, f"{folder}/rows", files_per_batch=1)
    metrics.to_files(metrics.score_stream(stream, model), f"{folder}/out", f"{folder}/progress").awaitTermination()
    names = ["loan_id", "default_prediction", "default_probability", "risk_rating"]
    got = spark.read.parquet(f"{folder}/out").select(*names).collect()
    assert sorted(map(str, got)) == sorted(map(str, score_new_loans(rows, model).select(*names).collect()))
