"""Operational statistics over the prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import ops
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, Tables


def span(interval: str) -> str:
    return f"request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL {interval} AND request_timestamp <= TIMESTAMP '{AS_OF}'"


@check(
    "d9_version_distribution",
    f"""SELECT model_version, count(*) AS inference_count, min(request_timestamp) AS first_seen, max(request_timestamp) AS last_seen,
               avg(inference_latency_ms) AS avg_latency_ms FROM pred WHERE endpoint_name = 'ep-a' AND {span('48 HOUR')} GROUP BY 1""",
    "avg_latency_ms",
)
def version_distribution(t: Tables):
    return ops.version_distribution(t.pred, "ep-a", AS_OF, 48)


@check(
    "d10_version_drift",
    f"""SELECT 'ep-a' AS endpoint_name, 48 AS time_window_hours, count(*) > 1 AS has_drift, count(*) AS version_count,
               coalesce(string_agg(model_version, ', ' ORDER BY last_seen DESC), '') AS versions,
               CASE count(*) WHEN 0 THEN 'No inferences found in last 48 hours' WHEN 1 THEN 'Single version serving: ' || max(model_version)
                    ELSE 'Multiple versions serving ep-a: ' || string_agg(model_version, ', ' ORDER BY last_seen DESC) END AS drift_message
        FROM (SELECT model_version, max(request_timestamp) AS last_seen FROM pred WHERE endpoint_name = 'ep-a' AND {span('48 HOUR')} GROUP BY 1)""",
)
def version_drift(t: Tables):
    return ops.version_drift(t.pred, "ep-a", AS_OF, 48)


@check(
    "d11_latest_version",
    """SELECT e.endpoint_name, model_version, mlflow_run_id, request_timestamp AS last_inference_time, inference_latency_ms AS latency_ms,
              CASE WHEN model_version IS NULL THEN 'NO_DATA' ELSE 'OK' END AS status
       FROM (VALUES ('ep-a'), ('ep-b'), ('ep-c')) e(endpoint_name)
       LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY endpoint_name ORDER BY request_timestamp DESC, inference_id DESC) AS rn FROM pred) WHERE rn = 1) p
         ON p.endpoint_name = e.endpoint_name""",
    "latency_ms",
)
def latest_version(t: Tables):
    endpoints = t.spark.createDataFrame([("ep-a",), ("ep-b",), ("ep-c",)], "endpoint_name string")
    return ops.latest_version(t.pred, endpoints)


@check(
    "d12_version_comparison",
    f"""SELECT *, fraud_count / total_predictions AS fraud_rate, high_confidence_count / total_predictions AS high_confidence_rate
        FROM (SELECT model_version, count(*) AS total_predictions, CAST(sum(prediction) AS BIGINT) AS fraud_count,
                     avg(probability_fraud) AS avg_fraud_probability, avg(inference_latency_ms) AS avg_latency_ms,
                     stddev_samp(inference_latency_ms) AS stddev_latency_ms, min(inference_latency_ms) AS min_latency_ms,
                     max(inference_latency_ms) AS max_latency_ms, CAST(sum(CASE WHEN is_high_confidence THEN 1 ELSE 0 END) AS BIGINT) AS high_confidence_count,
                     min(request_timestamp) AS first_seen, max(request_timestamp) AS last_seen
              FROM pred WHERE endpoint_name = 'ep-a' AND {span('20 DAY')} GROUP BY 1)""",
    "avg_fraud_probability avg_latency_ms stddev_latency_ms min_latency_ms max_latency_ms fraud_rate high_confidence_rate",
)
def version_comparison(t: Tables):
    return ops.version_comparison(t.pred, "ep-a", AS_OF, 20)


def report_sql(unit: str) -> str:
    return f"""
    SELECT date_trunc('{unit}', request_timestamp)::TIMESTAMP AS period, endpoint_name, model_version, count(*) AS inference_count,
           CAST(sum(prediction) AS BIGINT) AS fraud_count, avg(probability_fraud) AS avg_fraud_probability,
           avg(inference_latency_ms) AS avg_latency_ms, min(request_timestamp) AS first_seen, max(request_timestamp) AS last_seen
    FROM pred GROUP BY ALL"""


@check("d13_daily_version_report", report_sql("day"), "avg_fraud_probability avg_latency_ms", digits=8)
def daily_report(t: Tables):
    return ops.version_report(t.pred, "day")


@check("d14_hourly_version_transitions", report_sql("hour"), "avg_fraud_probability avg_latency_ms", digits=8)
def hourly_transitions(t: Tables):
    return ops.version_report(t.pred, "hour")


@check(
    "d15_endpoint_metrics",
    f"""SELECT *, coalesce(fraud_count / nullif(total_predictions, 0), 0) AS fraud_rate,
               coalesce(high_confidence_count / nullif(total_predictions, 0), 0) AS high_confidence_rate,
               coalesce(low_confidence_count / nullif(total_predictions, 0), 0) AS low_confidence_rate
        FROM (SELECT count(*) AS total_predictions, avg(probability_fraud) AS avg_fraud_prob, coalesce(CAST(sum(prediction) AS BIGINT), 0) AS fraud_count,
                     coalesce(CAST(sum(1 - prediction) AS BIGINT), 0) AS non_fraud_count, avg(inference_latency_ms) AS avg_latency_ms,
                     stddev_samp(inference_latency_ms) AS std_latency_ms, max(inference_latency_ms) AS max_latency_ms, min(inference_latency_ms) AS min_latency_ms,
                     CAST(count(*) FILTER (is_high_confidence) AS BIGINT) AS high_confidence_count, CAST(count(*) FILTER (is_low_confidence) AS BIGINT) AS low_confidence_count,
                     count(DISTINCT date_trunc('minute', request_timestamp)) AS active_minutes
              FROM pred WHERE endpoint_name = 'ep-b' AND {span('3000 MINUTE')})""",
    "avg_fraud_prob avg_latency_ms std_latency_ms max_latency_ms min_latency_ms fraud_rate high_confidence_rate low_confidence_rate",
)
def endpoint_metrics(t: Tables):
    return ops.endpoint_metrics(t.pred, "ep-b", AS_OF, 3000)


LATENCY = """count(inference_latency_ms) AS n, avg(inference_latency_ms) AS mean_ms, min(inference_latency_ms) AS min_ms, max(inference_latency_ms) AS max_ms,
    quantile_cont(inference_latency_ms, 0.5) AS p50_ms, quantile_cont(inference_latency_ms, 0.95) AS p95_ms, quantile_cont(inference_latency_ms, 0.99) AS p99_ms"""
LATENCY_FLOATS = "mean_ms min_ms max_ms p50_ms p95_ms p99_ms"


@check("d16_latency_summary", f"SELECT {LATENCY} FROM pred", LATENCY_FLOATS)
def latency(t: Tables):
    return ops.latency_summary(t.pred)


@check("d16_latency_by_endpoint", f"SELECT endpoint_name, {LATENCY} FROM pred GROUP BY 1", LATENCY_FLOATS)
def latency_by_endpoint(t: Tables):
    return ops.latency_summary(t.pred, ["endpoint_name"])


def volume_sql(unit: str) -> str:
    return f"""
    SELECT date_trunc('{unit}', request_timestamp)::TIMESTAMP AS period, count(*) AS prediction_count, CAST(sum(prediction) AS BIGINT) AS fraud_count,
           avg(probability_fraud) AS avg_fraud_probability, avg(confidence_score) AS avg_confidence FROM pred GROUP BY 1"""


@check("d17_volume_hourly", volume_sql("hour"), "avg_fraud_probability avg_confidence", digits=8)
def volume_hourly(t: Tables):
    return ops.prediction_volume(t.pred, "hour")


@check("d17_volume_daily", volume_sql("day"), "avg_fraud_probability avg_confidence", digits=8)
def volume_daily(t: Tables):
    return ops.prediction_volume(t.pred, "day")


@check("d17_volume_weekly", volume_sql("week"), "avg_fraud_probability avg_confidence", digits=8)
def volume_weekly(t: Tables):
    return ops.prediction_volume(t.pred, "week")


@check(
    "d18_latency_heatmap",
    """SELECT CAST(request_timestamp AS DATE) AS day, CAST(hour(request_timestamp) AS INTEGER) AS hour, avg(inference_latency_ms) AS avg_latency_ms,
              stddev_samp(inference_latency_ms) AS std_latency_ms, count(*) AS request_count FROM pred GROUP BY ALL""",
    "avg_latency_ms std_latency_ms",
    digits=8,
)
def latency_heatmap(t: Tables):
    return ops.latency_heatmap(t.pred)


@check(
    "d18_latency_heatmap_wide",
    "SELECT CAST(request_timestamp AS DATE) AS day, "
    + ", ".join(f"avg(inference_latency_ms) FILTER (hour(request_timestamp) = {h}) AS h{h}" for h in range(24))
    + " FROM pred GROUP BY 1",
    " ".join(f"h{h}" for h in range(24)),
    digits=8,
)
def latency_heatmap_wide(t: Tables):
    return ops.latency_heatmap_wide(t.pred)


@check(
    "d19_confidence_summary",
    """SELECT *, high_confidence_count / n AS high_confidence_rate, low_confidence_count / n AS low_confidence_rate
       FROM (SELECT count(*) AS n, avg(confidence_score) AS avg_confidence, count(*) FILTER (is_high_confidence) AS high_confidence_count,
                    count(*) FILTER (is_low_confidence) AS low_confidence_count FROM pred)""",
    "avg_confidence high_confidence_rate low_confidence_rate",
)
def confidence_summary(t: Tables):
    return ops.confidence_summary(t.pred)


def histogram_sql(bins: int, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return f"""
    SELECT {lead}bin, bin * (0.5::DOUBLE / {bins}) + 0.5 AS bin_start, count(*) AS n
    FROM (SELECT *, CAST(least(floor((confidence_score - 0.5) / (0.5::DOUBLE / {bins})), {bins - 1}) AS INTEGER) AS bin FROM pred
          WHERE confidence_score BETWEEN 0.5 AND 1.0) GROUP BY ALL"""


@check("d20_confidence_histogram", histogram_sql(50), "bin_start")
def confidence_histogram(t: Tables):
    return ops.histogram(t.pred, "confidence_score", 0.5, 1.0, 50)


@check("d20_confidence_histogram_by_prediction", histogram_sql(30, "prediction"), "bin_start")
def confidence_histogram_split(t: Tables):
    return ops.histogram(t.pred, "confidence_score", 0.5, 1.0, 30, ["prediction"])


@check(
    "d21_scoring_summary",
    """SELECT *, fraud_detected / total_predictions AS fraud_rate
       FROM (SELECT count(*) AS total_predictions, CAST(sum(prediction) AS BIGINT) AS fraud_detected, avg(probability_fraud) AS avg_fraud_probability,
                    count(*) FILTER (probability_fraud >= 0.8) AS high_risk_count FROM pred)""",
    "avg_fraud_probability fraud_rate",
)
def scoring_summary(t: Tables):
    return ops.scoring_summary(t.pred)


@check(
    "d22_log_arrival",
    "SELECT endpoint_name, count(*) AS n, min(request_timestamp) AS earliest, max(request_timestamp) AS latest FROM pred GROUP BY 1",
)
def log_arrival(t: Tables):
    return ops.log_arrival(t.pred)


@check(
    "d23_dashboard_readiness",
    """SELECT count(*) AS inference_records, count(ground_truth) AS inference_with_ground_truth, any_value(n) AS monitoring_runs, any_value(n) > 0 AS has_drift_data
       FROM lpred CROSS JOIN (SELECT count(*) AS n FROM runs)""",
)
def dashboard_readiness(t: Tables):
    return ops.dashboard_readiness(t.lpred, t.runs)


@check(
    "d23_dashboard_readiness_without_runs",
    """SELECT count(*) AS inference_records, count(ground_truth) AS inference_with_ground_truth, 0 AS monitoring_runs, false AS has_drift_data FROM lpred""",
)
def dashboard_readiness_without_runs(t: Tables):
    return ops.dashboard_readiness(t.lpred, None)


@check(
    "d26_version_run_distribution",
    f"""SELECT endpoint_name, model_version, mlflow_run_id, count(*) AS n, max(request_timestamp) AS last_seen FROM pred WHERE {span('48 HOUR')} GROUP BY ALL""",
)
def version_run_distribution(t: Tables):
    return ops.version_run_distribution(t.pred, AS_OF, 48)


@check(
    "d29_published_metrics",
    """SELECT endpoint_name, metric, value,
              coalesce(value > CASE metric WHEN 'DataDriftShare' THEN 0.2 WHEN 'ROCAUCDegradation' THEN 0.05 END, false) AS breached
       FROM (SELECT endpoint_name, unnest([
               {'metric': 'DataDriftShare', 'value': drifted_columns_share}, {'metric': 'BaselineROCAUC', 'value': baseline_roc_auc},
               {'metric': 'CurrentROCAUC', 'value': current_roc_auc}, {'metric': 'ROCAUCDegradation', 'value': roc_auc_degradation},
               {'metric': 'Accuracy', 'value': accuracy}, {'metric': 'Precision', 'value': "precision"}, {'metric': 'Recall', 'value': recall}], recursive := true)
             FROM (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY endpoint_name ORDER BY monitoring_timestamp DESC) = 1))
       WHERE value IS NOT NULL""",
    "value",
)
def published_metrics(t: Tables):
    return ops.published_metrics(t.runs)


@check(
    "d29_metrics_against_baselines",
    """WITH latest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY endpoint_name ORDER BY monitoring_timestamp DESC) = 1),
            long AS (SELECT endpoint_name, unnest([
               {'metric': 'Accuracy', 'value': accuracy}, {'metric': 'Precision', 'value': "precision"}, {'metric': 'Recall', 'value': recall}], recursive := true) FROM latest),
            base AS (SELECT endpoint_name, unnest([
               {'metric': 'Accuracy', 'expected': max(accuracy)}, {'metric': 'Precision', 'expected': max("precision")}, {'metric': 'Recall', 'expected': max(recall)}], recursive := true)
             FROM runs GROUP BY 1)
       SELECT endpoint_name, metric, value, coalesce(expected - value > 0.05, false) AS breached FROM long JOIN base USING (endpoint_name, metric) WHERE value IS NOT NULL""",
    "value",
)
def metrics_against_baselines(t: Tables):
    """Accuracy, precision and recall against the best that each endpoint has shown."""
    best = t.runs.groupBy("endpoint_name").agg(*[F.max(c).alias(c) for c in ("accuracy", "precision", "recall")])
    rows = ops.published_metrics(t.runs, baselines=best)
    return rows.where(F.col("metric").isin("Accuracy", "Precision", "Recall"))
