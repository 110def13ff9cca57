"""Late labels: matching confirmations to predictions, latest-wins merge, coverage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import correctness, error_type
from tidewatch.functions.stats import safe_ratio
from tidewatch.operators import windows

LABEL_COLUMNS = ("ground_truth", "ground_truth_timestamp", "ground_truth_source", "days_to_ground_truth")


def _label_struct():
    return F.struct(
        F.col("actual_fraud").cast("int").alias("ground_truth"),
        F.col("confirmation_timestamp").alias("ground_truth_timestamp"),
        F.col("confirmation_source").alias("ground_truth_source"),
        F.col("days_since_prediction").alias("days_to_ground_truth"),
    )


def recent_updates(updates: DataFrame, as_of: datetime | str | None = None, window_hours: int | None = None) -> DataFrame:
    """Confirmations known at ``as_of``, optionally only those of the last hours."""
    if as_of is None:
        return updates
    if window_hours is not None:
        return windows.last(updates, "confirmation_timestamp", as_of, hours=window_hours)
    return windows.until(updates, "confirmation_timestamp", as_of)


def latest_labels(updates: DataFrame) -> DataFrame:
    """One row per inference_id: the latest confirmation, ties broken by the larger batch id.

    An aggregate, not a window: confirmations of one id combine before the shuffle, so an id with very
    many confirmations stays cheap.
    """
    order = F.struct("confirmation_timestamp", F.coalesce("batch_id", F.lit("")), F.col("actual_fraud"))
    return (
        updates.groupBy("inference_id")
        .agg(F.max_by(_label_struct(), order).alias("label"))
        .select("inference_id", "label.*")
    )


def latest_labels_ranked(updates: DataFrame) -> DataFrame:
    """The same result as :func:`latest_labels` written as ``row_number() = 1``."""
    order = Window.partitionBy("inference_id").orderBy(
        F.desc("confirmation_timestamp"), F.desc(F.coalesce("batch_id", F.lit(""))), F.desc("actual_fraud")
    )
    ranked = updates.select("inference_id", _label_struct().alias("label"), F.row_number().over(order).alias("rn"))
    return ranked.where("rn = 1").select("inference_id", "label.*")


def matched_updates(predictions: DataFrame, updates: DataFrame, force: bool = False) -> DataFrame:
    """Predictions joined with their confirmations; by default only predictions without a label."""
    candidates = predictions if force else predictions.where(F.col("ground_truth").isNull())
    return candidates.join(
        updates.select(
            "inference_id", "actual_fraud", "confirmation_timestamp", "confirmation_source", "days_since_prediction"
        ),
        "inference_id",
    )


def pending_count(predictions: DataFrame, updates: DataFrame, force: bool = False) -> DataFrame:
    return matched_updates(predictions, updates, force).agg(F.countDistinct("inference_id").alias("pending_count"))


def preview_updates(predictions: DataFrame, updates: DataFrame, force: bool = False, limit: int | None = 10) -> DataFrame:
    """What a merge would change, newest confirmation first."""
    truth = F.col("actual_fraud").cast("int")
    rows = matched_updates(predictions, updates, force).select(
        "inference_id",
        "transaction_id",
        F.col("request_timestamp").alias("prediction_timestamp"),
        F.col("prediction").alias("current_prediction"),
        F.col("probability_fraud").alias("predicted_probability"),
        F.col("ground_truth").alias("current_ground_truth"),
        F.col("actual_fraud").alias("new_ground_truth"),
        "confirmation_timestamp",
        "confirmation_source",
        "days_since_prediction",
        correctness(F.col("prediction"), truth).alias("prediction_correctness"),
        error_type(F.col("prediction"), truth).alias("error_type"),
    )
    if limit is None:
        return rows
    return rows.orderBy(F.desc("confirmation_timestamp"), "inference_id").limit(limit)


def update_statistics(predictions: DataFrame, updates: DataFrame, force: bool = False) -> DataFrame:
    """Counts over the matched confirmations, with rates over their number."""
    truth = F.col("actual_fraud").cast("int")
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    p = F.col("prediction")
    counts = matched_updates(predictions, updates, force).agg(
        F.count("*").alias("total_updates"),
        F.countDistinct("inference_id").alias("distinct_predictions"),
        total(truth).alias("fraud_cases"),
        total(p == truth).alias("correct_predictions"),
        total((p == 1) & (truth == 0)).alias("false_positives"),
        total((p == 0) & (truth == 1)).alias("false_negatives"),
        F.avg("days_since_prediction").alias("avg_days_to_confirmation"),
        F.min("confirmation_timestamp").alias("earliest_confirmation"),
        F.max("confirmation_timestamp").alias("latest_confirmation"),
    )
    n = F.col("total_updates")
    return counts.select(
        "*",
        safe_ratio(F.col("correct_predictions"), n).alias("accuracy"),
        safe_ratio(F.col("false_positives"), n).alias("false_positive_rate"),
        safe_ratio(F.col("false_negatives"), n).alias("false_negative_rate"),
    )


def merge_labels(
    predictions: DataFrame,
    updates: DataFrame,
    force: bool = False,
    as_of: datetime | str | None = None,
    window_hours: int | None = None,
) -> DataFrame:
    """The predictions after the merge: latest confirmation wins.

    By default only missing labels are filled; ``force`` lets a confirmation replace a label.
    """
    labels = latest_labels(recent_updates(updates, as_of, window_hours)).select(
        "inference_id", F.struct(*LABEL_COLUMNS).alias("__new")
    )
    take = F.col("__new").isNotNull()
    if not force:
        take = take & F.col("ground_truth").isNull()
    merged = predictions.join(labels, "inference_id", "left").select(
        *[
            F.when(take, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in LABEL_COLUMNS else F.col(c)
            for c in predictions.columns
        ]
    )
    return merged


def changed_predictions(
    predictions: DataFrame,
    updates: DataFrame,
    force: bool = False,
    as_of: datetime | str | None = None,
    window_hours: int | None = None,
) -> DataFrame:
    """Only the rows a merge would touch (the dry run)."""
    merged = merge_labels(predictions, updates, force, as_of, window_hours).withColumnsRenamed(
        {c: f"new_{c}" for c in LABEL_COLUMNS}
    )
    before = predictions.select("inference_id", *LABEL_COLUMNS)
    joined = merged.join(before, "inference_id")
    differs = None
    for c in LABEL_COLUMNS:
        test = ~F.col(c).eqNullSafe(F.col(f"new_{c}"))
        differs = test if differs is None else differs | test
    return joined.where(differs).select("inference_id", *[f"new_{c}" for c in LABEL_COLUMNS])


def label_coverage(predictions: DataFrame) -> DataFrame:
    """One row: totals with and without label, first and last times, mean lag, coverage."""
    labelled = F.col("ground_truth").isNotNull()
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    counts = predictions.agg(
        F.count("*").alias("total_predictions"),
        n(labelled).alias("with_ground_truth"),
        n(~labelled).alias("without_ground_truth"),
        F.min("request_timestamp").alias("earliest_prediction"),
        F.max("request_timestamp").alias("latest_prediction"),
        F.min("ground_truth_timestamp").alias("earliest_confirmation"),
        F.max("ground_truth_timestamp").alias("latest_confirmation"),
        F.avg("days_to_ground_truth").alias("avg_days_to_ground_truth"),
    )
    coverage = safe_ratio(F.col("with_ground_truth"), F.col("total_predictions"))
    return counts.select("*", coverage.alias("coverage"), (coverage * 100).alias("coverage_pct"))
