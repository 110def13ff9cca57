"""Frozen baseline records and the rule that picks the one to compare against."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.functions.columns import as_of_literal

BASELINE_VERSION = 2
METRIC_FIELDS = ("roc_auc", "pr_auc", "precision", "recall", "f1_score", "accuracy")


def baseline_record(
    metrics: DataFrame,
    schema: FeatureSchema,
    model_version: str,
    created_at: datetime | str,
    training_table: str,
    evaluation_table: str,
    training_snapshot_id: str = "",
    evaluation_snapshot_id: str = "",
    code_commit_sha: str = "unknown",
    feature_schema_version: int = 1,
    threshold: float = 0.5,
    approval_status: str = "PendingManualApproval",
) -> DataFrame:
    """One nested row from a one-row metrics frame (see ``quality.performance_metrics``)."""
    feature_list = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("dtype")) for n, t in schema.features])
    return metrics.select(
        F.lit(BASELINE_VERSION).alias("schema_version"),
        as_of_literal(created_at).alias("created_at"),
        F.lit(model_version).alias("model_version"),
        F.lit(approval_status).alias("approval_status"),
        F.lit(code_commit_sha).alias("code_commit_sha"),
        F.lit(training_table).alias("training_table"),
        F.lit(evaluation_table).alias("evaluation_table"),
        F.lit(training_snapshot_id).alias("training_snapshot_id"),
        F.lit(evaluation_snapshot_id).alias("evaluation_snapshot_id"),
        F.lit(feature_schema_version).alias("feature_schema_version"),
        feature_list.alias("feature_schema"),
        F.struct(*[F.col(m).cast("double").alias(m) for m in METRIC_FIELDS]).alias("metrics"),
        F.col("sample_count").alias("sample_size"),
        (F.col("true_positives") + F.col("false_negatives")).alias("positive_samples"),
        (F.col("true_negatives") + F.col("false_positives")).alias("negative_samples"),
        F.lit(float(threshold)).alias("threshold"),
    )


def deployed_versions(deployments: DataFrame, as_of: datetime | str) -> DataFrame:
    """(endpoint_name, model_version) serving at ``as_of``."""
    live = deployments.where(F.col("valid_from") <= as_of_literal(as_of))
    return live.groupBy("endpoint_name").agg(
        F.max_by("model_version", F.struct("valid_from", "model_version")).alias("model_version")
    )


def resolve_baselines(deployments: DataFrame, baselines: DataFrame, as_of: datetime | str) -> DataFrame:
    """Baseline per endpoint: of the model deployed now, else the latest approved one, else none.

    Never merely the latest built.  ``source`` says which rule applied.
    """
    known = baselines.where(F.col("created_at") <= as_of_literal(as_of))
    order = F.struct("created_at", "model_version")
    columns = [c for c in baselines.columns if c != "model_version"]
    per_version = known.groupBy("model_version").agg(F.max_by(F.struct(*columns), order).alias("deployed_baseline"))
    approved = known.where(F.col("approval_status") == "Approved").agg(
        F.max_by(F.struct("model_version", *columns), order).alias("fallback")
    )
    joined = (
        deployed_versions(deployments, as_of)
        .join(per_version, "model_version", "left")
        .crossJoin(F.broadcast(approved))
    )
    use = F.col("deployed_baseline").isNotNull()
    return joined.select(
        "endpoint_name",
        F.col("model_version").alias("deployed_version"),
        F.when(use, F.col("model_version")).otherwise(F.col("fallback.model_version")).alias("model_version"),
        F.when(use, "deployed").when(F.col("fallback").isNotNull(), "latest_approved").otherwise("none").alias("source"),
        *[F.when(use, F.col(f"deployed_baseline.{c}")).otherwise(F.col(f"fallback.{c}")).alias(c) for c in columns],
    )
