"""Group totals by file, keyed pseudonyms, stream sinks keyed by content."""

from __future__ import annotations

import datetime
import hashlib
import hmac
import shutil

import pytest
from pyspark.sql import functions as F

from lendscape.functions.keys import hmac_pads
from lendscape.operators import selection
from lendscape.operators.features import PORTFOLIO_MEANS, add_statistical_features, engineer_row_features
from lendscape.plans import bronze, silver
from lendscape.schema import CORRUPT_COLUMN, LOAN_COLUMNS
from lendscape.sources import files, tables, totals
from lendscape.sources.derived_loans import AS_OF
from lendscape.streaming import ingest, metrics

MEANS = ["avg_amount_by_purpose", "avg_dpd_by_purpose", "avg_income_by_tier", "amount_deviation_pct"]


def sorted_rows(df, *names):
    rounded = [F.round(n, 9).alias(n) if n in MEANS else n for n in names]
    return sorted(map(str, df.select(*rounded).collect()))


def test_kept_averages_equal_a_pass_over_all_rows(spark, book, folder):
    """Odd folder names, NULL keys, equal rows in two files, a file added twice, files replaced by compaction."""
    rows = book.select("loan_id", "loan_purpose", "city_tier", "loan_amount", "current_dpd", "monthly_income", "risk_category")
    rows = rows.withColumns({
        "risk_category": F.when(F.col("risk_category") == "High", "Very High% +\u00fc").otherwise(F.col("risk_category")),
        "loan_purpose": F.when(F.col("loan_amount") % 5 != 0, F.col("loan_purpose")),
        "monthly_income": F.when(F.col("loan_amount") % 3 != 0, F.col("monthly_income")),
    })
    path, kept = f"{folder}/silver rows", f"{folder}/totals"
    for part in (rows.where("current_dpd = 0"), rows.where("current_dpd > 0"), rows.limit(3)):
        part.write.partitionBy("risk_category").mode("append").parquet(path)
        before = len(spark.read.parquet(path).inputFiles())
        known = spark.read.parquet(kept).select("file").distinct().count() if tables.table_exists(spark, kept) else 0
        assert totals.refresh_totals(spark, path, kept, PORTFOLIO_MEANS) == before - known > 0
    assert totals.refresh_totals(spark, path, kept, PORTFOLIO_MEANS) == 0
    spark.read.parquet(kept).limit(4).write.mode("append").parquet(kept)  # a file that two runs aggregated

    def same():
        stored = tables.read_table(spark, path)
        got = add_statistical_features(stored, totals.kept_totals(spark, path, kept, PORTFOLIO_MEANS))
        assert sorted_rows(got, "loan_id", *MEANS) == sorted_rows(add_statistical_features(stored), "loan_id", *MEANS)

    same()
    tables.compact_partitions(spark, path, ["risk_category"])
    assert totals.refresh_totals(spark, path, kept, PORTFOLIO_MEANS) > 0
    same()


def test_only_new_files_are_read(spark, book, folder):
    path, kept = f"{folder}/rows", f"{folder}/totals"
    book.where("current_dpd = 0").write.parquet(path)
    totals.refresh_totals(spark, path, kept, PORTFOLIO_MEANS)
    old = set(spark.read.parquet(path).inputFiles())
    book.where("current_dpd > 0").write.mode("append").parquet(path)
    totals.refresh_totals(spark, path, kept, PORTFOLIO_MEANS)
    added = spark.read.parquet(kept).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("loan_purpose", "city_tier").alias("d"))
    assert all(r.n == r.d for r in added.where(F.col("file").isin(list(old))).collect())


def test_extended_silver_with_totals(spark, book, folder):
    for n, part in enumerate((book.where("credit_score < 600"), book.where("credit_score >= 600"))):
        batch = files.with_audit(part, LOAN_COLUMNS, at=f"2001-12-3{n}", origin="x")
        tables.write_to_bronze(batch, f"{folder}/bronze")
        silver.extend_silver(spark, f"{folder}/bronze", f"{folder}/rows", AS_OF, totals=f"{folder}/totals")
    got = silver.read_silver(spark, f"{folder}/rows", f"{folder}/totals")
    expected = add_statistical_features(engineer_row_features(tables.read_bronze(spark, f"{folder}/bronze"), AS_OF))
    assert sorted_rows(got, "loan_id", *MEANS) == sorted_rows(expected, "loan_id", *MEANS)


def test_published_vectors(spark):
    """RFC 4231, cases 2, 4 and 6."""
    cases = [
        (b"Jefe", "what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
        (bytes(range(1, 26)), "\u00cd" * 50, hmac.new(bytes(range(1, 26)), ("\u00cd" * 50).encode(), hashlib.sha256).hexdigest()),
        (b"\xaa" * 131, "Test Using Larger Than Block-Size Key - Hash Key First",
         "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    ]
    for key, text, expected in cases:
        df = spark.createDataFrame([(text,), (None,), ("",)], "customer_id string")
        got = [r.customer_id for r in selection.pseudonymize(df, {1: key}).collect()]
        empty = hmac.new(key, b"", hashlib.sha256).hexdigest()
        assert sorted(got, key=str) == sorted([expected, None, empty], key=str)
    assert len(hmac_pads(b"x" * 64)[0]) == len(hmac_pads(b"")[1]) == 64


def test_pseudonyms_join_rotate_and_stay_out_of_plans(spark, book):
    keys = {1: b"old secret key", 3: b"new secret key"}
    masked = selection.pseudonymize(book, keys)
    assert masked.select("key_version").distinct().collect() == [(3,)]
    assert masked.select("customer_id").distinct().count() == book.select("customer_id").distinct().count()
    assert masked.join(selection.pseudonymize(book.select("customer_id").distinct(), keys), "customer_id", "left_anti").isEmpty()
    plan = masked._jdf.queryExecution().toString()
    assert not any(form in plan for key in keys.values() for form in (key.decode(), key.hex(), hmac_pads(key)[0].hex()))
    stored = selection.pseudonymize(book.select("loan_id", "customer_id"), keys, version=1)
    unknown = spark.createDataFrame([("X", "unknown", 1), ("Y", None, 1)], stored.schema)
    moved = selection.rotate_pseudonyms(stored.unionAll(unknown), selection.key_rotation(book, keys, 1, 3))
    assert sorted_rows(moved.where("loan_id NOT IN ('X', 'Y')"), "loan_id", "customer_id", "key_version") == sorted_rows(
        masked, "loan_id", "customer_id", "key_version"
    )
    assert {tuple(r) for r in moved.where("loan_id IN ('X', 'Y')").collect()} == {("X", "unknown", 1), ("Y", None, 1)}


def test_windows_after_a_lost_checkpoint(spark, book, folder):
    """Other files per batch and no checkpoint leave figures and lateness; later files still count."""
    book.where("loan_amount % 7 > 0").repartition(5).write.parquet(f"{folder}/in")
    schema = ["start", "end", "loan_purpose", "loans", "amount", F.round("default_rate", 9)]

    def run(files_per_batch):
        stream = ingest.stream_parquet(spark, f"{folder}/in", files_per_batch=files_per_batch)
        metrics.collect_windows(stream, f"{folder}/out", f"{folder}/progress{files_per_batch}").awaitTermination()

    def figures(**options):
        return sorted(map(str, metrics.read_windows(spark, f"{folder}/out", **options).select(*schema).collect()))

    def expected():
        timed = spark.read.parquet(f"{folder}/in").withColumn("event_time", F.col("application_date").cast("timestamp"))
        return sorted(map(str, metrics.windowed_metrics(timed).select(*schema).collect()))

    run(1)
    late = figures(late=True)
    assert figures() == expected() and late
    run(2)
    assert figures() == expected() and figures(late=True) == late
    book.where("loan_amount % 7 = 0").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run(3)
    assert figures() == expected()
    total = sum(metrics.read_windows(spark, f"{folder}/out", late=x).agg(F.sum("loans")).first()[0] for x in (False, True))
    assert total == book.count()


def test_merged_sink_after_a_lost_checkpoint(spark, book, folder):
    for attempt, parts in enumerate((3, 5)):  # the same records in other files
        book.unionAll(book.limit(50)).repartition(parts).write.mode("overwrite").parquet(f"{folder}/in{attempt}")
        stream = files.with_audit(ingest.stream_parquet(spark, f"{folder}/in{attempt}", files_per_batch=2), LOAN_COLUMNS)
        metrics.merge_files(stream, f"{folder}/out", f"{folder}/progress{attempt}").awaitTermination()
        assert spark.read.parquet(f"{folder}/out").count() == book.count()


def broken_csv(spark, book, folder):
    """Two whole files, then one with two broken lines."""
    files.write_csv(book.coalesce(1), f"{folder}/csv")
    from pathlib import Path

    part = next(Path(f"{folder}/csv").glob("*.csv"))
    header, first, second = part.read_text().splitlines()[:3]
    broken = [first.replace(first.split(",")[1], "not a number", 1), second.replace(second.split(",")[1], "nor this", 1)]
    (Path(f"{folder}/csv") / "broken.csv").write_text("\n".join([header, *broken]) + "\n")
    return broken


def test_broken_lines_of_a_stream(spark, book, folder):
    broken = broken_csv(spark, book, folder)
    stream = ingest.stream_csv(spark, f"{folder}/csv")
    with pytest.raises(Exception, match="don't parse"):
        ingest.ingest_stream(stream, f"{folder}/stopped", f"{folder}/p0").awaitTermination()
    assert not tables.table_exists(spark, f"{folder}/stopped")
    for attempt in (1, 2):
        ingest.ingest_stream(
            ingest.stream_csv(spark, f"{folder}/csv"), f"{folder}/bronze", f"{folder}/p{attempt}",
            quarantine=f"{folder}/aside", as_of=AS_OF,
        ).awaitTermination()
    got = tables.read_bronze(spark, f"{folder}/bronze")
    assert got.count() == book.count() and CORRUPT_COLUMN not in got.columns
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/aside").select(CORRUPT_COLUMN).collect()) == sorted(broken)


def test_equal_hashes_of_broken_lines_are_all_set_aside(spark, book, folder):
    broken = broken_csv(spark, book, folder)
    bronze.ingest(spark, f"{folder}/csv", f"{folder}/bronze", gate="quarantine", quarantine=f"{folder}/aside", as_of=datetime.date(2030, 1, 1))
    shutil.copy(f"{folder}/csv/broken.csv", f"{folder}/again.csv")
    with open(f"{folder}/again.csv") as f:
        text = f.read().replace("not a number", "still no number")
    with open(f"{folder}/again.csv", "w") as f:
        f.write(text)
    bronze.ingest(spark, f"{folder}/again.csv", f"{folder}/bronze", gate="quarantine", quarantine=f"{folder}/aside", as_of=datetime.date(2030, 1, 1))
    lines = [r[0] for r in spark.read.parquet(f"{folder}/aside").select(CORRUPT_COLUMN).collect() if r[0]]
    assert sorted(lines) == sorted([*broken, broken[0].replace("not a number", "still no number")])
