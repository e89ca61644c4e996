"""Times the headline jobs and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
GBT_ROUNDS = int(os.environ.get("BENCH_ROUNDS", "200"))

sys.path.insert(0, str(Path(__file__).parent))

from lendscape.operators import dashboard, encoding, evaluation, portfolio, versions  # noqa: E402
from lendscape.plans import bronze, gold, silver  # noqa: E402
from lendscape.plans.queries import QUERIES  # noqa: E402
from lendscape.session import local_session  # noqa: E402
from lendscape.sources import files, tables  # noqa: E402
from lendscape.sources.derived_loans import AS_OF, loans, second_batch  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", CPUS, partitions=int(CPUS) if CPUS.isdigit() else 8,
                          compile_huge=os.environ.get("BENCH_COMPILE_HUGE", "0") == "1")
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="bench-")
    csv, csv2 = f"{work}/loans_csv", f"{work}/loans_csv_2"
    # input files and warm-up, not timed
    portfolio_rows = loans(spark, SF_DIR)
    files.write_csv(portfolio_rows.repartition(8), csv)
    files.write_csv(second_batch(portfolio_rows).repartition(8), csv2)
    consume(portfolio.default_rate(files.read_csv(spark, csv)))

    times: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    b, s = f"{work}/bronze", f"{work}/silver"
    timed("bronze_ingest", lambda: bronze.ingest(spark, csv, b, as_of=AS_OF))
    timed("bronze_merge", lambda: bronze.ingest(spark, csv2, b, as_of=AS_OF))
    timed("silver_features", lambda: silver.build_silver(spark, b, s, AS_OF))
    features = tables.read_table(spark, s)
    timed("latest_version", lambda: consume(versions.latest_version(tables.read_bronze(spark, b))))
    timed("segment_risk_profile", lambda: QUERIES["segment_risk_profile"](spark, SF_DIR).collect())
    timed("key_metrics", lambda: dashboard.key_metrics(features).collect())
    timed("monthly_volume", lambda: dashboard.monthly_volume(features).collect())
    timed("dpd_histogram", lambda: dashboard.dpd_histogram(features).collect())
    timed("segment_rollup", lambda: portfolio.segment_rollup(features).collect())
    timed("numeric_summary", lambda: portfolio.describe_numeric(features).collect())
    timed("auc_roc", lambda: evaluation.auc_roc(features, "is_default", "combined_risk_score").collect())
    timed("roc_curve", lambda: consume(evaluation.roc_curve(features, "is_default", "combined_risk_score")))
    timed(
        "calibration",
        lambda: evaluation.calibrate_probability_bins(features, "is_default", "pd_proxy").collect(),
    )
    timed("stratified_split", lambda: consume(encoding.stratified_split(features)))
    trained = timed("gold_train_evaluate", lambda: gold.train(spark, features, rounds=GBT_ROUNDS))
    rows = features.count()
    spark.stop()
    shutil.rmtree(work, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "total_time_headline_jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "silver_rows": rows,
                "gbt_rounds": GBT_ROUNDS,
                "gbt_rounds_kept": trained.model.stages[-1].getNumTrees,
                "test_metrics": {k: round(v, 4) for k, v in trained.metrics.items() if v is not None},
            }
        )
    )


if __name__ == "__main__":
    main()
