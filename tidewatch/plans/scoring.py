"""Training, scoring and evaluation of a model on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.functions import columns as c
from tidewatch.functions.stats import safe_ratio
from tidewatch.operators import baselines, prep, quality

LABEL, WEIGHT, VALIDATION = "__label", "__weight", "__validation"


def with_class_weight(df: DataFrame, target: str) -> DataFrame:
    """Add the training label and weight: positives weigh negatives / positives (1.0 without positives)."""
    y = F.col(target).cast("double")
    counts = df.agg(F.count_if(y == 1).alias("__pos"), F.count_if(y == 0).alias("__neg"))
    weight = F.when(F.col("__pos") > 0, safe_ratio(F.col("__neg"), F.col("__pos"))).otherwise(F.lit(1.0))
    return (
        df.crossJoin(F.broadcast(counts))
        .withColumn(LABEL, y)
        .withColumn(WEIGHT, F.when(y == 1, weight).otherwise(F.lit(1.0)))
        .drop("__pos", "__neg")
    )


def train_model(
    train: DataFrame,
    target: str,
    features: Sequence[str],
    target_kind: str = "boolean",
    validation: DataFrame | None = None,
    max_depth: int = 4,
    iterations: int = 20,
    step: float = 0.05,
    seed: int = 42,
) -> PipelineModel:
    """Weighted tree ensemble; the kind of target picks the learner.

    boolean: boosted trees with positive weight, stopped early on ``validation`` rows; integer: random
    forest, or as boolean if no value but 0 and 1 occurs; double: boosted regression trees.  A text target is
    an error.
    """
    if target_kind == "int":
        other = F.col(target).isNotNull() & ~F.col(target).isin(0, 1)
        target_kind = "boolean" if train.where(other).isEmpty() else "int"
    assembler = VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="keep")
    filled = prep.fill_missing(train, features)
    if target_kind == "boolean":
        rows = with_class_weight(filled, target).withColumn(VALIDATION, F.lit(False))
        options = {}
        if validation is not None:
            held = with_class_weight(prep.fill_missing(validation, features), target).withColumn(VALIDATION, F.lit(True))
            rows = rows.unionByName(held)
            options["validationIndicatorCol"] = VALIDATION
        learner = GBTClassifier(
            featuresCol="__features", labelCol=LABEL, weightCol=WEIGHT, maxDepth=max_depth, maxIter=iterations,
            stepSize=step, seed=seed, **options,
        )
    elif target_kind == "int":
        rows = filled.withColumn(LABEL, F.col(target).cast("double"))
        learner = RandomForestClassifier(featuresCol="__features", labelCol=LABEL, maxDepth=max_depth, numTrees=iterations, seed=seed)
    elif target_kind == "double":
        rows = filled.withColumn(LABEL, F.col(target).cast("double"))
        learner = GBTRegressor(featuresCol="__features", labelCol=LABEL, maxDepth=max_depth, maxIter=iterations, stepSize=step, seed=seed)
    else:
        raise ValueError(f"cannot train on a target of type {target_kind!r}")
    # The learner reads its input several times before it holds binned rows of its own, which then need the memory.
    wanted = [c for c in (*features, LABEL, WEIGHT, VALIDATION) if c in rows.columns]
    rows = rows.select(*dict.fromkeys(wanted)).persist(StorageLevel.DISK_ONLY)
    try:
        return Pipeline(stages=[assembler, learner]).fit(rows)
    finally:
        rows.unpersist()


def importance(model: PipelineModel, features: Sequence[str], spark, k: int = 20) -> DataFrame:
    """(feature, importance) of the k most important features."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(k)


def score(df: DataFrame, model: PipelineModel, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Rows with the model's answer.

    Two classes: probability_fraud, prediction and the derived score columns.  More classes: ``prediction`` (the class)
    and ``confidence_score`` (its probability).  Regression: ``prediction`` as a number.
    """
    have = set(df.columns)
    filled = df.select("*", *[F.lit(0.0).alias(f) for f in features if f not in have])
    scored = model.transform(prep.fill_missing(filled, features))
    classes = getattr(model.stages[-1], "numClasses", 0)
    if classes == 0:
        return scored.select(*filled.columns, F.col("prediction").cast("double").alias("prediction"))
    if classes > 2:
        top = F.array_max(vector_to_array("probability"))
        return scored.select(*filled.columns, F.col("prediction").cast("int").alias("prediction"), top.alias("confidence_score"))
    with_p = scored.withColumn("probability_fraud", vector_to_array("probability")[1])
    return with_scores(with_p.select(*filled.columns, "probability_fraud"), threshold)


def with_scores(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Everything derived from a probability."""
    conf = c.confidence("probability_fraud")
    return df.select(
        "*",
        c.predicted("probability_fraud", threshold).alias("prediction"),
        (1 - F.col("probability_fraud")).alias("probability_non_fraud"),
        conf.alias("confidence_score"),
        c.is_high_confidence(conf).alias("is_high_confidence"),
        c.is_low_confidence(conf).alias("is_low_confidence"),
        c.score_bucket("probability_fraud").alias("prediction_bucket"),
    )


def evaluate(
    scored: DataFrame, truth: str, schema: FeatureSchema, minimums: dict[str, float], model_version: str, created_at: datetime | str,
    training_table: str, evaluation_table: str, **ids: str,
) -> tuple[DataFrame, DataFrame]:
    """(gates, baseline record) of scored hold-out rows: what decides whether a model is registered, and as what.

    The record is approved only if every gate passes; else it waits for a decision by hand.
    """
    metrics = quality.performance_metrics(scored, truth=truth)
    gates = quality.quality_gates(metrics, minimums)
    record = baselines.baseline_record(metrics, schema, model_version, created_at, training_table, evaluation_table, **ids)
    passed = gates.agg(F.every("passed").alias("__passed"))
    status = F.when(F.col("__passed"), "Approved").otherwise(F.col("approval_status"))
    return gates, record.crossJoin(F.broadcast(passed)).withColumn("approval_status", status).drop("__passed")
