"""Performance report over labelled predictions: coverage, overall metrics, windows, alerts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import labels, quality, windows


@dataclass(frozen=True)
class PerformanceReport:
    coverage: DataFrame
    overall: DataFrame
    windows: DataFrame
    alerts: DataFrame


def labelled_predictions(
    predictions: DataFrame, as_of: datetime | str, endpoint: str | None = None, days: int = 30
) -> DataFrame:
    return windows.last(predictions, "request_timestamp", as_of, endpoint, days=days).where(F.col("ground_truth").isNotNull())


def performance_report(
    predictions: DataFrame,
    as_of: datetime | str,
    endpoint: str | None = None,
    days: int = 30,
    unit: str = "day",
    min_samples: int = 100,
    alert_threshold: float = 0.85,
    baseline_auc: float | None = None,
) -> PerformanceReport:
    """All parts lazily; ``coverage.status`` is ``insufficient_ground_truth`` below ``min_samples``
    labelled rows, and the other parts are empty then."""
    window = windows.last(predictions, "request_timestamp", as_of, endpoint, days=days)
    coverage = labels.label_coverage(window).withColumn(
        "status", F.when(F.col("with_ground_truth") >= min_samples, "ok").otherwise("insufficient_ground_truth")
    )
    rows = labelled_predictions(predictions, as_of, endpoint, days)
    overall = quality.performance_metrics(rows, min_samples=min_samples)
    by_unit = quality.windowed_metrics(rows, "request_timestamp", unit, min_samples=min_samples)
    return PerformanceReport(
        coverage, overall, by_unit, quality.degradation_alerts(by_unit, alert_threshold, baseline_auc=baseline_auc)
    )
