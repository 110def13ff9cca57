"""Operational statistics over the prediction log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import bucket_start
from tidewatch.functions.stats import safe_ratio
from tidewatch.operators import windows
from tidewatch.operators.kernel import exact_quantiles, join_on


def _n(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0))


def endpoint_rows(df: DataFrame, endpoint: str | None, as_of: datetime | str, **span: int) -> DataFrame:
    return windows.last(df, "request_timestamp", as_of, endpoint, **span)


def version_distribution(df: DataFrame, endpoint: str, as_of: datetime | str, hours: int = 24) -> DataFrame:
    return (
        endpoint_rows(df, endpoint, as_of, hours=hours)
        .groupBy("model_version")
        .agg(
            F.count("*").alias("inference_count"),
            F.min("request_timestamp").alias("first_seen"),
            F.max("request_timestamp").alias("last_seen"),
            F.avg("inference_latency_ms").alias("avg_latency_ms"),
        )
        .orderBy(F.desc("last_seen"), "model_version")
    )


def version_drift(df: DataFrame, endpoint: str, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """One row: does more than one version serve the endpoint within the window?"""
    seen = endpoint_rows(df, endpoint, as_of, hours=hours).groupBy("model_version").agg(
        F.max("request_timestamp").alias("last_seen")
    )
    # One entry per deployed version: a handful.
    newest_first = F.transform(
        F.sort_array(F.collect_list(F.struct("last_seen", "model_version")), asc=False), lambda s: s["model_version"]
    )
    listed = seen.agg(F.count("*").alias("version_count"), newest_first.alias("__versions"))
    names = F.array_join("__versions", ", ")
    n = F.col("version_count")
    message = (
        F.when(n == 0, F.lit(f"No inferences found in last {hours} hours"))
        .when(n == 1, F.concat(F.lit("Single version serving: "), names))
        .otherwise(F.concat(F.lit(f"Multiple versions serving {endpoint}: "), names))
    )
    return listed.select(
        F.lit(endpoint).alias("endpoint_name"),
        F.lit(hours).alias("time_window_hours"),
        (n > 1).alias("has_drift"),
        "version_count",
        names.alias("versions"),
        message.alias("drift_message"),
    )


def latest_version(df: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Newest log row per endpoint of ``endpoints``; status NO_DATA where there is none."""
    latest = df.groupBy("endpoint_name").agg(
        F.max_by(
            F.struct("model_version", "mlflow_run_id", "request_timestamp", "inference_latency_ms"),
            F.struct("request_timestamp", "inference_id"),
        ).alias("r")
    )
    return endpoints.select("endpoint_name").distinct().join(latest, "endpoint_name", "left").select(
        "endpoint_name",
        F.col("r.model_version").alias("model_version"),
        F.col("r.mlflow_run_id").alias("mlflow_run_id"),
        F.col("r.request_timestamp").alias("last_inference_time"),
        F.col("r.inference_latency_ms").alias("latency_ms"),
        F.when(F.col("r").isNull(), "NO_DATA").otherwise("OK").alias("status"),
    )


def version_comparison(df: DataFrame, endpoint: str, as_of: datetime | str, days: int = 7) -> DataFrame:
    stats = (
        endpoint_rows(df, endpoint, as_of, days=days)
        .groupBy("model_version")
        .agg(
            F.count("*").alias("total_predictions"),
            _n(F.col("prediction") == 1).alias("fraud_count"),
            F.avg("probability_fraud").alias("avg_fraud_probability"),
            F.avg("inference_latency_ms").alias("avg_latency_ms"),
            F.stddev("inference_latency_ms").alias("stddev_latency_ms"),
            F.min("inference_latency_ms").alias("min_latency_ms"),
            F.max("inference_latency_ms").alias("max_latency_ms"),
            _n(F.col("is_high_confidence")).alias("high_confidence_count"),
            F.min("request_timestamp").alias("first_seen"),
            F.max("request_timestamp").alias("last_seen"),
        )
    )
    n = F.col("total_predictions")
    return stats.select(
        "*",
        safe_ratio(F.col("fraud_count"), n).alias("fraud_rate"),
        safe_ratio(F.col("high_confidence_count"), n).alias("high_confidence_rate"),
    ).orderBy(F.desc("last_seen"), "model_version")


def version_report(df: DataFrame, unit: str) -> DataFrame:
    """Daily report or hourly transitions: volume and span of every version per time unit."""
    return df.groupBy(bucket_start(unit, "request_timestamp").alias("period"), "endpoint_name", "model_version").agg(
        F.count("*").alias("inference_count"),
        _n(F.col("prediction") == 1).alias("fraud_count"),
        F.avg("probability_fraud").alias("avg_fraud_probability"),
        F.avg("inference_latency_ms").alias("avg_latency_ms"),
        F.min("request_timestamp").alias("first_seen"),
        F.max("request_timestamp").alias("last_seen"),
    )


def endpoint_metrics(df: DataFrame, endpoint: str, as_of: datetime | str, minutes: int = 60) -> DataFrame:
    stats = endpoint_rows(df, endpoint, as_of, minutes=minutes).agg(
        F.count("*").alias("total_predictions"),
        F.avg("probability_fraud").alias("avg_fraud_prob"),
        _n(F.col("prediction") == 1).alias("fraud_count"),
        _n(F.col("prediction") == 0).alias("non_fraud_count"),
        F.avg("inference_latency_ms").alias("avg_latency_ms"),
        F.stddev("inference_latency_ms").alias("std_latency_ms"),
        F.max("inference_latency_ms").alias("max_latency_ms"),
        F.min("inference_latency_ms").alias("min_latency_ms"),
        _n(F.col("is_high_confidence")).alias("high_confidence_count"),
        _n(F.col("is_low_confidence")).alias("low_confidence_count"),
        F.countDistinct(F.date_trunc("minute", "request_timestamp")).alias("active_minutes"),
    )
    n = F.col("total_predictions")
    return stats.select(
        "*",
        safe_ratio(F.col("fraud_count"), n).alias("fraud_rate"),
        safe_ratio(F.col("high_confidence_count"), n).alias("high_confidence_rate"),
        safe_ratio(F.col("low_confidence_count"), n).alias("low_confidence_rate"),
    )


def latency_summary(df: DataFrame, groups: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Mean, min, max and interpolated p50 / p95 / p99 latency.

    Exact by default (distributed order statistics); ``approximate`` uses a mergeable sketch.
    """
    value = "inference_latency_ms"
    stats = df.groupBy(*groups).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean_ms"), F.min(value).alias("min_ms"), F.max(value).alias("max_ms"),
        *([F.percentile_approx(value, [0.5, 0.95, 0.99], 100_000).alias("quantiles")] if approximate else []),
    )
    if not approximate:
        exact = exact_quantiles(df, groups, value, [0.5, 0.95, 0.99])
        stats = join_on(stats, exact, groups, "left") if groups else stats.join(F.broadcast(exact), how="left")
    q = F.col("quantiles")
    return stats.select(
        *groups, "n", "mean_ms", "min_ms", "max_ms",
        q[0].alias("p50_ms"), q[1].alias("p95_ms"), q[2].alias("p99_ms"),
    )


def prediction_volume(df: DataFrame, unit: str) -> DataFrame:
    return df.groupBy(bucket_start(unit, "request_timestamp").alias("period")).agg(
        F.count("*").alias("prediction_count"),
        _n(F.col("prediction") == 1).alias("fraud_count"),
        F.avg("probability_fraud").alias("avg_fraud_probability"),
        F.avg("confidence_score").alias("avg_confidence"),
    )


def latency_heatmap(df: DataFrame) -> DataFrame:
    """(day, hour) latency cells."""
    return df.groupBy(
        F.to_date("request_timestamp").alias("day"), F.hour("request_timestamp").alias("hour")
    ).agg(
        F.avg("inference_latency_ms").alias("avg_latency_ms"),
        F.stddev("inference_latency_ms").alias("std_latency_ms"),
        F.count("*").alias("request_count"),
    )


def latency_heatmap_wide(df: DataFrame) -> DataFrame:
    """One row per day, one column ``h0`` .. ``h23`` of mean latency."""
    wide = (
        df.select(F.to_date("request_timestamp").alias("day"), F.hour("request_timestamp").alias("hour"), "inference_latency_ms")
        .groupBy("day")
        .pivot("hour", list(range(24)))
        .agg(F.avg("inference_latency_ms"))
    )
    return wide.withColumnsRenamed({str(h): f"h{h}" for h in range(24)})


def confidence_summary(df: DataFrame) -> DataFrame:
    stats = df.agg(
        F.count("*").alias("n"),
        F.avg("confidence_score").alias("avg_confidence"),
        _n(F.col("is_high_confidence")).alias("high_confidence_count"),
        _n(F.col("is_low_confidence")).alias("low_confidence_count"),
    )
    return stats.select(
        "*",
        safe_ratio(F.col("high_confidence_count"), F.col("n")).alias("high_confidence_rate"),
        safe_ratio(F.col("low_confidence_count"), F.col("n")).alias("low_confidence_rate"),
    )


def histogram(df: DataFrame, value: str, lower: float, upper: float, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., bin, bin_start, n) over equal-width bins; the last bin is closed."""
    width = (upper - lower) / bins
    place = F.floor((F.col(value) - lower) / width)
    rows = df.where(F.col(value).between(lower, upper))
    return (
        rows.groupBy(*groups, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(*groups, "bin", (F.col("bin") * width + lower).alias("bin_start"), "n")
    )


def scoring_summary(df: DataFrame, high_risk: float = 0.8) -> DataFrame:
    stats = df.agg(
        F.count("*").alias("total_predictions"),
        _n(F.col("prediction") == 1).alias("fraud_detected"),
        F.avg("probability_fraud").alias("avg_fraud_probability"),
        _n(F.col("probability_fraud") >= high_risk).alias("high_risk_count"),
    )
    return stats.withColumn("fraud_rate", safe_ratio(F.col("fraud_detected"), F.col("total_predictions")))


def log_arrival(df: DataFrame) -> DataFrame:
    return df.groupBy("endpoint_name").agg(
        F.count("*").alias("n"),
        F.min("request_timestamp").alias("earliest"),
        F.max("request_timestamp").alias("latest"),
    )


def dashboard_readiness(predictions: DataFrame, runs: DataFrame | None) -> DataFrame:
    """Counts a dashboard needs; a missing runs table counts as empty."""
    log = predictions.agg(
        F.count("*").alias("inference_records"), _n(F.col("ground_truth").isNotNull()).alias("inference_with_ground_truth")
    )
    if runs is None:
        return log.select("*", F.lit(0).cast("bigint").alias("monitoring_runs"), F.lit(False).alias("has_drift_data"))
    counted = runs.agg(F.count("*").alias("monitoring_runs"))
    return log.crossJoin(F.broadcast(counted)).withColumn("has_drift_data", F.col("monitoring_runs") > 0)


def view_summary(details: DataFrame) -> DataFrame:
    return details.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct("feature_name").alias("features"),
        F.countDistinct("monitoring_run_id").alias("runs"),
        F.min("monitoring_timestamp").alias("first_run"),
        F.max("monitoring_timestamp").alias("last_run"),
    )


def tracking_audit(runs: DataFrame, last: int = 10) -> DataFrame:
    """Of the newest runs: how many carry a tracking id, and are the ids unique?"""
    recent = runs.orderBy(F.desc("monitoring_timestamp"), "monitoring_run_id").limit(last)
    stats = recent.agg(
        F.count("*").alias("total_runs"),
        F.count("mlflow_run_id").alias("tracked_runs"),
        F.countDistinct("mlflow_run_id").alias("unique_ids"),
        F.count_if(F.col("mlflow_run_id").isNull()).alias("null_ids"),
    )
    return stats.withColumn("all_unique", F.col("unique_ids") == F.col("tracked_runs"))


def version_run_distribution(df: DataFrame, as_of: datetime | str, hours: int = 24) -> DataFrame:
    return (
        endpoint_rows(df, None, as_of, hours=hours)
        .groupBy("endpoint_name", "model_version", "mlflow_run_id")
        .agg(F.count("*").alias("n"), F.max("request_timestamp").alias("last_seen"))
    )


def tagged_counts(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("monitoring_run_id").isNotNull()).groupBy("monitoring_run_id").agg(F.count("*").alias("n"))


# Metric name published for each verdict column.
PUBLISHED_METRICS = {
    "drifted_columns_share": "DataDriftShare",
    "baseline_roc_auc": "BaselineROCAUC",
    "current_roc_auc": "CurrentROCAUC",
    "roc_auc_degradation": "ROCAUCDegradation",
    "accuracy": "Accuracy",
    "precision": "Precision",
    "recall": "Recall",
}


def published_metrics(
    runs: DataFrame, share_limit: float = 0.2, degradation_limit: float = 0.05, baselines: DataFrame | None = None
) -> DataFrame:
    """Latest verdict per endpoint as (endpoint, metric, value, breached) rows for a metric store.

    Share and degradation breach when above their limit; accuracy, precision and recall when they fall short of
    the endpoint's value in ``baselines`` (endpoint_name, accuracy, precision, recall; one row each) by more than
    ``degradation_limit``.  NULL values are not published, and without a baseline nothing falls short.
    """
    latest = runs.groupBy("endpoint_name").agg(
        F.max_by(F.struct(*PUBLISHED_METRICS), F.struct("monitoring_timestamp", "monitoring_run_id")).alias("r")
    )
    entries = [
        F.struct(F.lit(name).alias("metric"), F.col(f"r.{c}").cast("double").alias("value"))
        for c, name in PUBLISHED_METRICS.items()
    ]
    rows = latest.select("endpoint_name", F.inline(F.array(*entries))).where("value is not null")
    limit = F.when(F.col("metric") == "DataDriftShare", share_limit).when(
        F.col("metric") == "ROCAUCDegradation", degradation_limit
    )
    above = F.coalesce(F.col("value") > limit, F.lit(False))
    if baselines is None:
        return rows.withColumn("breached", above)
    measured = ("accuracy", "precision", "recall")
    expected = baselines.select(
        "endpoint_name", F.inline(F.array(*[F.struct(F.lit(PUBLISHED_METRICS[c]).alias("metric"), F.col(c).cast("double").alias("__expected")) for c in measured]))
    )
    short = F.coalesce(F.col("__expected") - F.col("value") > degradation_limit, F.lit(False))
    return join_on(rows, expected, ["endpoint_name", "metric"], "left").withColumn("breached", above | short).drop("__expected")
