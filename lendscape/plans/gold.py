"""Feature table to a trained, evaluated and recorded model; exports."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators import modelling
from ..operators.dashboard import high_risk_file_name
from ..operators.encoding import stratified_split
from ..operators.evaluation import calibrate_probability_bins, classification_report, confusion_matrix, roc_curve
from ..operators.selection import high_risk, portfolio_filter
from ..session import keep
from ..sources.files import write_csv, write_lines, write_parquet


@dataclass
class TrainingResult:
    model: PipelineModel
    metrics: dict[str, float]
    importance: DataFrame
    scored_test: DataFrame


def train(
    spark: SparkSession,
    silver: DataFrame,
    folder: str | None = None,
    features: str = "recorded",
    leak_free: bool = False,
    rounds: int = V.ROUNDS,
    depth: int = V.TREE_DEPTH,
    run: str = "credit_default",
) -> TrainingResult:
    """Split, train, score the test rows and evaluate; with ``folder`` keep all results there."""
    data = stratified_split(silver)
    model = modelling.train_default_model(data, features, leak_free, rounds, depth)
    scored = keep(modelling.score_new_loans(data.where("is_test"), model), "scored-test")
    metrics = modelling.evaluate(scored)
    importance = modelling.feature_importance(spark, model)
    if folder:
        modelling.save_model(model, f"{folder}/model")
        write_parquet(importance, f"{folder}/feature_importance")
        write_csv(importance, f"{folder}/feature_importance_csv")
        write_lines(importance, "feature", f"{folder}/model_features")
        write_parquet(confusion_matrix(scored, V.TARGET, "default_prediction"), f"{folder}/confusion_matrix")
        write_parquet(classification_report(scored, V.TARGET, "default_prediction"), f"{folder}/report")
        write_parquet(roc_curve(scored, V.TARGET, "default_probability"), f"{folder}/roc_curve")
        write_parquet(calibrate_probability_bins(scored, V.TARGET, "default_probability"), f"{folder}/calibration")
        counts = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(V.TARGET).alias("d")).first()
        modelling.record_run(
            spark,
            f"{folder}/runs",
            run,
            {"features": features, "leak_free": leak_free, "rounds": rounds, "max_depth": depth,
             "learning_rate": V.LEARNING_RATE, "seed": V.SPLIT_SEED},
            metrics,
            {"test_rows": counts["n"], "test_defaults": counts["d"] or 0},
        )
    return TrainingResult(model, metrics, importance, scored)


def export_high_risk(df: DataFrame, folder: str, day: datetime.date | None = None) -> str:
    path = f"{folder}/{high_risk_file_name(day or datetime.date.today())}"
    write_csv(high_risk(df), path)
    return path


def export_filtered(df: DataFrame, path: str, risk=None, status=None, dates=None) -> None:
    write_csv(portfolio_filter(df, risk, status, dates), path)
