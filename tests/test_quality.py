"""Ranking metrics, windows, alerts and degenerate inputs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import quality
from tidewatch.plans import drift_check
from tidewatch.plans.performance_report import performance_report

SCHEMA = "ground_truth int, probability_fraud double, prediction int"


def frame(spark, truth, score, threshold=0.5):
    return spark.createDataFrame([(int(t) if t is not None else None, float(s), int(s >= threshold)) for t, s in zip(truth, score)], SCHEMA)


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(0)
    truth, score = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20
    pos, neg = score[truth == 1], score[truth == 0]
    expected = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert quality.ranking_metrics(frame(spark, truth, score), "ground_truth", "probability_fraud").first()["roc_auc"] == pytest.approx(expected, rel=1e-12)


def test_all_scores_tied(spark):
    row = quality.ranking_metrics(frame(spark, [0, 1, 1, 0], [0.5] * 4), "ground_truth", "probability_fraud").first()
    assert row["roc_auc"] == 0.5 and row["average_precision"] == 0.5 and row["pr_auc"] == pytest.approx(0.75)


def test_one_class_has_no_auc_but_a_confusion(spark):
    df = frame(spark, [1, 1, 1], [0.9, 0.2, 0.6])
    assert quality.ranking_metrics(df, "ground_truth", "probability_fraud").first()["roc_auc"] is None
    row = quality.performance_metrics(df).first()
    assert (row["true_positives"], row["false_negatives"], row["true_negatives"], row["false_positives"]) == (2, 1, 0, 0)
    assert row["specificity"] == 0.0 and row["false_positive_rate"] == 0.0


def test_unlabelled_rows_do_not_count(spark):
    assert quality.confusion(frame(spark, [1, None, 0], [0.9, 0.9, 0.1]), "ground_truth", "prediction").first()["sample_count"] == 2


def test_large_counts_stay_exact(spark):
    # Two scores with weights near 2^31: the pair count needs more than 64-bit floats hold exactly.
    from tidewatch.operators import kernel

    rows = spark.createDataFrame([(0.1, 3_000_000_000, 4_000_000_000), (0.9, 5_000_000_000, 1_000_000_000)], "value double, pos long, neg long")
    pre = kernel.ordered_prefix(rows, [], ["pos", "neg"])
    assert {r["value"]: r["neg_below"] for r in pre.collect()} == {0.1: 0, 0.9: 4_000_000_000}


def test_degenerate_sides_are_named(spark):
    df = spark.createDataFrame([("baseline", 0, 0), ("baseline", 1, 0), ("current", 1, 1), ("current", 0, 0)], "side string, ground_truth int, prediction int")
    rows = quality.degenerate_columns(df, ["ground_truth", "prediction"]).collect()
    assert [(r["side"], r["column"], r["n_classes"]) for r in rows] == [("baseline", "prediction", 1)]


def test_alert_severity(spark):
    windows = spark.createDataFrame([("a", 0.9, 10), ("b", 0.84, 10), ("c", 0.79, 10)], "period string, roc_auc double, sample_count long")
    rows = {r["period"]: r for r in quality.degradation_alerts(windows, 0.85).collect()}
    assert {k: r["severity"] for k, r in rows.items()} == {"b": "warning", "c": "critical"}
    assert rows["b"]["baseline"] == pytest.approx((0.9 + 0.84 + 0.79) / 3)
    assert quality.degradation_alerts(windows, 0.85, baseline_auc=0.95).first()["baseline"] == 0.95


def test_gate_fails_on_missing_metric(spark):
    df = spark.createDataFrame([(None, 0.6)], "roc_auc double, average_precision double")
    rows = {r["metric"]: r["passed"] for r in quality.quality_gates(df, {"roc_auc": 0.85, "average_precision": 0.5}).collect()}
    assert rows == {"roc_auc": False, "average_precision": True}


def log(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("inference_id"), F.lit("ep").alias("endpoint_name"),
        F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("request_timestamp"),
        (F.col("id") % 2).cast("int").alias("ground_truth"), (F.col("id") % 2).cast("int").alias("prediction"),
        (F.col("id") % 10 / 10).alias("probability_fraud"), F.lit(None).cast("timestamp_ntz").alias("ground_truth_timestamp"),
        F.lit(1.0).alias("days_to_ground_truth"),
    )


def test_report_needs_labels(spark):
    few = performance_report(log(spark, 50), "2024-01-06 00:00:00")
    assert few.coverage.first()["status"] == "insufficient_ground_truth"
    assert few.overall.count() == 0 and few.windows.count() == 0 and few.alerts.count() == 0
    empty = performance_report(log(spark, 50), "2023-01-06 00:00:00").coverage.first()
    assert empty["total_predictions"] == 0 and empty["coverage"] == 0.0


def test_model_drift_needs_samples_and_a_baseline(spark):
    row = drift_check.model_drift_check(log(spark, 50), "2024-01-06 00:00:00").first()
    assert row["model_status"] == "insufficient_samples" and not row["model_drift_detected"] and row["baseline_source"] == "default"
    row = drift_check.model_drift_check(log(spark, 200), "2024-01-06 00:00:00", baseline_auc=0.99).first()
    assert row["model_status"] == "ok" and row["baseline_source"] == "registered" and row["model_drift_detected"]
