"""Training, applying and keeping the default model (MLlib)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..session import shared_folder
from .boosting import boost
from .encoding import MISSING_CATEGORY, class_weights, feature_lists, hash_split
from .evaluation import auc_roc, binary_metrics, risk_rating

FEATURES_COLUMN = "_features"
WORK_PREFIX = "_f_"
VALIDATION_SHARE = 0.1  # of the training rows
BINS = 64  # split candidates of a number; a category with more values raises it
TASK_ROWS = 500_000  # training rows of a task


def preparation_stages(
    numeric: Sequence[str], categorical: Sequence[str], unseen: str = "error", exactness: float = 0.001
) -> list:
    """Cast, encode, impute and assemble; medians come from the rows the pipeline is fitted on."""
    casts = [f"CAST({n} AS DOUBLE) AS {WORK_PREFIX}{n}" for n in numeric]
    texts = [f"COALESCE(CAST({n} AS STRING), '{MISSING_CATEGORY}') AS {WORK_PREFIX}{n}" for n in categorical]
    numbers = [f"{WORK_PREFIX}{n}" for n in numeric]
    codes = [f"{WORK_PREFIX}{n}_code" for n in categorical]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(casts + texts)} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"{WORK_PREFIX}{n}" for n in categorical],
            outputCols=codes,
            stringOrderType="alphabetAsc",
            handleInvalid=unseen,
        ),
        Imputer(strategy="median", inputCols=numbers, outputCols=numbers, relativeError=exactness),
        VectorAssembler(inputCols=[*numbers, *codes], outputCol=FEATURES_COLUMN),
    ]


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``rows`` rows in even partitions that occupy all cores.

    Files of narrow rows hold very many of them: as they are read, a few tasks
    would do the work of every round.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-rows // (cores * TASK_ROWS))))


def train_default_model(
    df: DataFrame,
    features: str = "recorded",
    leak_free: bool = False,
    rounds: int = V.ROUNDS,
    depth: int = V.TREE_DEPTH,
    unseen: str = "error",
) -> PipelineModel:
    """Fit on the rows with ``is_test`` false; rounds after the best AUC on a slice of them are cut off.

    Boosting ends when ``V.PATIENCE`` rounds brought no better AUC. No step sees a
    test row. Preparation is fitted on all training rows. Both classes weigh the same.
    The inputs lie on disk: boosting reads them a few times and keeps its own,
    smaller copy of binned rows in memory for the rounds.
    """
    shared_folder(df.sparkSession)  # boosting cuts its lineage there every few rounds
    numeric, categorical = feature_lists(features, leak_free)
    train = hash_split(df.where(~F.col("is_test")), share=VALIDATION_SHARE, seed=V.SPLIT_SEED + 1, name="is_validation")
    train = spread(train.select(V.TARGET, "is_validation", *numeric, *categorical), train.count())
    train.persist(StorageLevel.DISK_ONLY)
    try:
        return _fit(train, numeric, categorical, rounds, depth, unseen)
    finally:
        train.unpersist()


def _fit(train: DataFrame, numeric, categorical, rounds: int, depth: int, unseen: str) -> PipelineModel:
    prepared = Pipeline(stages=preparation_stages(numeric, categorical, unseen)).fit(train)
    ratio = class_weights(train).where(F.col(V.TARGET) == 1).select("weight").first()
    weight = F.when(F.col(V.TARGET) == 1, F.lit(ratio[0] if ratio else 1.0)).otherwise(F.lit(1.0))
    matrix = prepared.transform(train.withColumn("weight", weight)).select(
        V.TARGET, "weight", "is_validation", FEATURES_COLUMN
    )
    booster = GBTClassifier(
        labelCol=V.TARGET,
        featuresCol=FEATURES_COLUMN,
        predictionCol="_prediction",
        weightCol="weight",
        maxDepth=depth,
        stepSize=V.LEARNING_RATE,
        maxIter=rounds,
        # unseen values may take a code of their own
        maxBins=max([BINS, *(len(labels) + 1 for labels in prepared.stages[1].labelsArray)]),
        seed=V.SPLIT_SEED,
        maxMemoryInMB=512,
        checkpointInterval=10,
    )
    booster.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    trees = boost(matrix.where(~F.col("is_validation")), matrix.where("is_validation"), booster, V.TARGET, V.PATIENCE)
    return PipelineModel(stages=[*prepared.stages, trees])


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Input plus ``default_prediction`` and ``default_probability``."""
    scored = model.transform(df)
    work = [n for n in scored.columns if n.startswith(WORK_PREFIX)]
    return scored.withColumns(
        {
            "default_prediction": F.col("_prediction").cast("int"),
            "default_probability": vector_to_array("_probability")[1],
        }
    ).drop(*work, FEATURES_COLUMN, "_prediction", "_probability", "_raw")


def score_new_loans(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Input plus prediction, probability and rating; batch or streaming."""
    return predict(df, model).withColumn("risk_rating", risk_rating())


def evaluate(scored: DataFrame, label: str = V.TARGET) -> dict[str, float]:
    """accuracy, precision, recall, f1_score and auc_roc."""
    metrics = binary_metrics(scored, label, "default_prediction").first().asDict()
    metrics["auc_roc"] = auc_roc(scored, label, "default_probability").first()[0]
    return metrics


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``feature, importance``: one row per model input, most important first."""
    assembler, trees = model.stages[-2], model.stages[-1]
    names = [n.removeprefix(WORK_PREFIX).removesuffix("_code") for n in assembler.getInputCols()]
    weights = trees.featureImportances.toArray()
    pairs = [(n, float(w)) for n, w in zip(names, weights)]
    return spark.createDataFrame(pairs, "feature STRING, importance DOUBLE").orderBy(
        F.desc("importance"), "feature"
    )


def top_features(importance: DataFrame, rows: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(rows)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """The saved model, or None when there is none."""
    try:
        return PipelineModel.load(path)
    except Exception as error:  # a missing path surfaces as different error classes per file system
        text = str(error)
        if isinstance(error, AnalysisException) or "does not exist" in text or "No such file" in text:
            return None
        raise


def record_run(spark: SparkSession, path: str, name: str, params: dict, metrics: dict, counts: dict) -> None:
    """Append one row about a training run to the run table."""
    row = [
        (
            name,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None},
            {k: int(v) for k, v in counts.items()},
        )
    ]
    schema = "run STRING, params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>, counts MAP<STRING,BIGINT>"
    spark.createDataFrame(row, schema).withColumn("recorded_at", F.current_timestamp()).write.mode(
        "append"
    ).parquet(path)
