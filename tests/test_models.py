from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendscape import fixed_values as V
from lendscape.operators import encoding, evaluation, features, modelling
from lendscape.plans import gold
from lendscape.sources.derived_loans import AS_OF


@pytest.fixture(scope="module")
def rows(spark, portfolio_path, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "rows")
    spark.read.parquet(portfolio_path).transform(features.engineer_row_features, AS_OF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def trained(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("gold"))
    return folder, gold.train(spark, rows, folder, rounds=5, depth=4)


def test_training_beats_chance(trained):
    _, result = trained
    assert result.metrics["auc_roc"] > 0.8
    assert set(result.metrics) == {"accuracy", "precision", "recall", "f1_score", "auc_roc"}


def test_everything_is_kept(spark, trained):
    folder, result = trained
    run = spark.read.parquet(f"{folder}/runs").first()
    assert run.run == "credit_default" and run.metrics["auc_roc"] == result.metrics["auc_roc"]
    assert run.counts["test_rows"] == result.scored_test.count()
    importance = spark.read.parquet(f"{folder}/feature_importance")
    assert importance.count() == 30 and importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    lines = [r.value for r in spark.read.text(f"{folder}/model_features").collect()]
    assert set(lines) == {*V.RECORDED_NUMERIC, *V.RECORDED_CATEGORICAL}
    assert spark.read.parquet(f"{folder}/confusion_matrix").count() == 2
    assert spark.read.parquet(f"{folder}/calibration").count() == 10


def test_saved_model_scores_the_same(trained, rows):
    folder, result = trained
    again = modelling.load_model(f"{folder}/model")
    names = ["loan_id", "default_probability", "risk_rating"]
    a = modelling.score_new_loans(rows, result.model).select(*names).collect()
    b = modelling.score_new_loans(rows, again).select(*names).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert modelling.load_model(f"{folder}/absent") is None


def test_scored_columns(trained, rows):
    scored = modelling.score_new_loans(rows, trained[1].model)
    added = [n for n in scored.columns if n not in rows.columns]
    assert added == ["default_prediction", "default_probability", "risk_rating"]


def test_unseen_category(spark, rows):
    data = rows.withColumn("is_test", F.col("credit_score") % 5 == 0)
    strange = data.limit(1).withColumn("loan_purpose", F.lit("Boat"))
    strict = modelling.train_default_model(data, "smoke", rounds=2, depth=2)
    with pytest.raises(Exception, match="(?i)unseen"):
        modelling.score_new_loans(strange, strict).collect()
    lenient = modelling.train_default_model(data, "smoke", rounds=2, depth=2, unseen="keep")
    assert modelling.score_new_loans(strange, lenient).count() == 1


def test_missing_category_is_a_category(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = {r.k: r.k_code for r in encoding.encode_labels(df, ["k"]).collect()}
    assert got == {None: 0, "a": 1, "b": 2}  # 'None' sorts before lower-case letters


def test_leak_free_lists():
    numeric, categorical = encoding.feature_lists("full", leak_free=True)
    assert not set(V.LABEL_LEAKS) & {*numeric, *categorical}
    assert [len(x) for x in encoding.feature_lists("full")] == [29, 13]
    assert [len(x) for x in encoding.feature_lists("recorded")] == [26, 4]
    assert [len(x) for x in encoding.feature_lists("smoke")] == [6, 2]


def test_weights_balance_the_classes(book):
    sums = encoding.class_weights(book).groupBy("is_default").agg(F.sum("weight").alias("w")).collect()
    assert sums[0].w == pytest.approx(sums[1].w)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    assert tuple(evaluation.binary_metrics(df, "y", "p").first()) == (1.0, 0.0, 0.0, 0.0)
    assert encoding.class_weights(df, "y").select("weight").distinct().first()[0] == 1.0


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "y int, p int")
    assert [tuple(r) for r in evaluation.confusion_matrix(df, "y", "p").collect()] == [(0, 1, 1), (1, 1, 2)]


def test_calibration_of_one_probability(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    got = {r.bin: (r.actual_default_rate, r["count"]) for r in evaluation.calibrate_probability_bins(df, "y", "p").collect()}
    assert got[5] == (0.5, 2) and all(got[b] == (None, 0) for b in got if b != 5) and len(got) == 10


def test_training_rows_occupy_all_cores(spark, monkeypatch):
    cores, one = spark.sparkContext.defaultParallelism, spark.range(0, 4000, 1, 1)
    for task_rows, times in ((modelling.TASK_ROWS, 1), (-(-4000 // cores) // 2, 3)):
        monkeypatch.setattr(modelling, "TASK_ROWS", task_rows)
        counts = [r["count"] for r in modelling.spread(one, 4000).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == 4000 and len(counts) in (cores * times, cores * (times - 1)) and max(counts) <= 2 * min(counts)
