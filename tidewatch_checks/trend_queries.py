"""Trend visuals (M, T, F) and ad-hoc analyses (N)."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidewatch.functions.columns import as_of_literal
from tidewatch.operators import drift, trends
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, Tables

DAY = "date_trunc('day', monitoring_timestamp)::TIMESTAMP AS day"
MINUTE = "date_trunc('minute', monitoring_timestamp)::TIMESTAMP AS minute"
LAST = f"CAST(DATE '{AS_OF[:10]}' - INTERVAL {{}} DAY AS TIMESTAMP)"


@check(
    "m1_auc_baseline_vs_current",
    f"SELECT {DAY}, avg(baseline_roc_auc) AS avg_baseline_roc_auc, avg(current_roc_auc) AS avg_current_roc_auc FROM runs GROUP BY 1",
    "avg_baseline_roc_auc avg_current_roc_auc",
)
def m1(t: Tables):
    return trends.auc_baseline_vs_current(t.runs)


@check(
    "m2_quality_over_time",
    f"""SELECT {DAY}, avg(accuracy) AS avg_accuracy, avg("precision") AS avg_precision, avg(recall) AS avg_recall, avg(f1_score) AS avg_f1_score FROM runs GROUP BY 1""",
    "avg_accuracy avg_precision avg_recall avg_f1_score",
)
def m2(t: Tables):
    return trends.quality_over_time(t.runs)


@check("m3_auc_by_version", f"SELECT {DAY}, model_version, avg(current_roc_auc) AS avg_current_roc_auc FROM runs GROUP BY ALL", "avg_current_roc_auc")
def m3(t: Tables):
    return trends.auc_by_version(t.runs)


def rate_sql(key: str) -> str:
    return f"SELECT {key}, avg(CAST(model_drift_detected AS INT)) AS model_drift_rate FROM runs GROUP BY 1"


@check("m4_verdict_rate_by_package", rate_sql("model_package_arn"), "model_drift_rate")
def m4(t: Tables):
    return trends.verdict_rate(t.runs, "model_package_arn")


@check("m5_verdict_rate_by_endpoint", rate_sql("endpoint_name"), "model_drift_rate")
def m5(t: Tables):
    return trends.verdict_rate(t.runs, "endpoint_name")


@check(
    "m6_by_training_snapshot",
    """SELECT training_snapshot_id, avg(current_roc_auc) AS avg_roc_auc, avg(accuracy) AS avg_accuracy,
              avg(CAST(model_drift_detected AS INT)) AS model_drift_rate, count(monitoring_run_id) AS runs FROM runs GROUP BY 1""",
    "avg_roc_auc avg_accuracy model_drift_rate",
)
def m6(t: Tables):
    return trends.by_training_snapshot(t.runs)


@check(
    "m7_lineage_audit",
    f"""SELECT {MINUTE}, monitoring_run_id, endpoint_name, model_version, model_package_arn, training_snapshot_id, evaluation_snapshot_id,
               data_drift_detected, model_drift_detected, avg(current_roc_auc) AS avg_roc_auc FROM runs GROUP BY ALL""",
    "avg_roc_auc",
)
def m7(t: Tables):
    return trends.lineage_audit(t.runs)


def kpi_sql(value: str) -> str:
    return f"""
    SELECT max(day) AS latest_day, arg_max(value, day) AS latest, CASE WHEN count(*) > 1 THEN arg_min(value, day) END AS previous,
           arg_max(value, day) - CASE WHEN count(*) > 1 THEN arg_min(value, day) END AS change
    FROM (SELECT * FROM (SELECT {DAY}, {value} AS value FROM runs GROUP BY 1) WHERE value IS NOT NULL ORDER BY day DESC LIMIT 2)"""


@check("m8_latest_auc", kpi_sql("avg(current_roc_auc)"), "latest previous change")
def m8(t: Tables):
    return trends.latest_kpi(t.runs, "current_roc_auc")


@check(
    "m9_confusion_over_time",
    """SELECT inference_date AS day, count(*) FILTER (prediction_category = 'True Positive') AS true_positive,
              count(*) FILTER (prediction_category = 'True Negative') AS true_negative, count(*) FILTER (prediction_category = 'False Positive') AS false_positive,
              count(*) FILTER (prediction_category = 'False Negative') AS false_negative FROM acc GROUP BY 1""",
)
def m9(t: Tables):
    return trends.confusion_over_time(t.acc)


@check("m10_degradation", f"SELECT {DAY}, model_version, avg(roc_auc_degradation_pct) AS avg_degradation_pct FROM runs GROUP BY ALL", "avg_degradation_pct")
def m10(t: Tables):
    return trends.degradation_over_time(t.runs)


@check(
    "m11_label_coverage",
    f"""SELECT *, coalesce(gt_count / nullif(inference_count, 0), 0) AS coverage
        FROM (SELECT {DAY}, CAST(sum(gt_count) AS BIGINT) AS gt_count, CAST(sum(inference_count) AS BIGINT) AS inference_count FROM joined GROUP BY 1)""",
    "coverage",
)
def m11(t: Tables):
    return trends.coverage_over_time(t.joined)


@check(
    "m12_latency",
    """SELECT date_trunc('day', request_timestamp)::TIMESTAMP AS day, avg(inference_latency_ms) AS avg_latency_ms, max(inference_latency_ms) AS max_latency_ms
       FROM pred GROUP BY 1""",
    "avg_latency_ms max_latency_ms",
)
def m12(t: Tables):
    return trends.latency_over_time(t.pred)


@check("t1_drift_share", f"SELECT {DAY}, avg(drifted_columns_share) AS avg_share FROM runs GROUP BY 1", "avg_share")
def t1(t: Tables):
    return trends.share_over_time(t.runs)


@check("t2_drifted_count", f"SELECT {DAY}, avg(drifted_columns_count) AS avg_count FROM runs GROUP BY 1", "avg_count")
def t2(t: Tables):
    return trends.count_over_time(t.runs)


@check("t3_alerts_by_severity", f"SELECT {DAY}, drift_severity, CAST(sum(CAST(alert_sent AS INT)) AS BIGINT) AS alerts FROM runs GROUP BY ALL")
def t3(t: Tables):
    return trends.alerts_by_severity(t.runs)


@check("t4_share_by_version", f"SELECT {DAY}, model_version, avg(drifted_columns_share) AS avg_share FROM runs GROUP BY ALL", "avg_share")
def t4(t: Tables):
    return trends.share_by(t.runs, "model_version")


@check("t5_share_by_endpoint", f"SELECT {DAY}, endpoint_name, avg(drifted_columns_share) AS avg_share FROM runs GROUP BY ALL", "avg_share")
def t5(t: Tables):
    return trends.share_by(t.runs, "endpoint_name")


VOLUME = f"SELECT {DAY}, CAST(sum(inference_count) AS BIGINT) AS inference_count, avg(drifted_columns_share) AS avg_share FROM joined GROUP BY 1"


@check("t6_volume_vs_share", VOLUME, "avg_share")
def t6(t: Tables):
    return trends.volume_vs_share(t.joined)


@check("t7_latest_share", kpi_sql("avg(drifted_columns_share)"), "latest previous change")
def t7(t: Tables):
    return trends.latest_kpi(t.runs, "drifted_columns_share")


@check(
    "t8_verdict_rows",
    f"""SELECT {MINUTE}, monitoring_run_id, endpoint_name, model_version, drift_severity, data_drift_detected, avg(drifted_columns_share) AS avg_share,
               avg(drifted_columns_count) AS avg_count, avg(features_analyzed) AS avg_features_analyzed, avg(data_sample_size) AS avg_sample_size
        FROM runs GROUP BY ALL""",
    "avg_share avg_count avg_features_analyzed avg_sample_size",
)
def t8(t: Tables):
    return trends.verdict_rows(t.runs)


@check(
    "t9_score_box_plot",
    f"""SELECT {DAY}, min(drift_score) AS min_score, quantile_cont(drift_score, 0.25) AS q1_score, quantile_cont(drift_score, 0.5) AS median_score,
               quantile_cont(drift_score, 0.75) AS q3_score, max(drift_score) AS max_score FROM feat GROUP BY 1""",
    "min_score q1_score median_score q3_score max_score",
)
def t9(t: Tables):
    return trends.score_box_plot(t.feat)


@check(
    "t10_sample_reliability",
    f"""SELECT {DAY}, model_version, avg(data_sample_size) AS avg_sample_size, avg(data_sample_size) < 1000 AS below_minimum FROM runs GROUP BY ALL""",
    "avg_sample_size",
)
def t10(t: Tables):
    return trends.sample_reliability(t.runs)


@check(
    "f1_feature_timeline",
    f"SELECT {DAY}, feature_name, avg(drift_score) AS avg_score, avg(drift_magnitude) AS avg_magnitude FROM feat GROUP BY ALL",
    "avg_score avg_magnitude",
)
def f1(t: Tables):
    return trends.feature_timeline(t.feat)


@check("f2_top_features", "SELECT feature_name, avg(drift_score) AS avg_score FROM feat GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15", "avg_score")
def f2(t: Tables):
    return trends.top_features(t.feat)


@check("f3_severity_mix", "SELECT feature_name, feature_severity AS drift_severity, count(*) AS n FROM feat GROUP BY ALL")
def f3(t: Tables):
    return trends.severity_mix(t.feat)


@check("f4_feature_by_day", f"SELECT {DAY}, feature_name, avg(drift_score) AS avg_score FROM feat GROUP BY ALL", "avg_score")
def f4(t: Tables):
    return trends.feature_by_day(t.feat)


@check(
    "f5_feature_detail_rows",
    f"SELECT {MINUTE}, feature_name, feature_severity AS drift_severity, model_version, avg(drift_score) AS avg_score FROM feat GROUP BY ALL",
    "avg_score",
)
def f5(t: Tables):
    return trends.feature_detail_rows(t.feat)


@check("f6_highest_score", f"SELECT {DAY}, max(drift_score) AS max_score FROM feat GROUP BY 1", "max_score")
def f6(t: Tables):
    return trends.highest_score(t.feat)


@check(
    "f7_feature_by_version",
    """SELECT feature_name, avg(drift_score) FILTER (model_version = 'v1') AS v1, avg(drift_score) FILTER (model_version = 'v2') AS v2 FROM feat GROUP BY 1""",
    "v1 v2",
)
def f7(t: Tables):
    return trends.feature_by_version(t.feat, ["v1", "v2"])


@check("f8_worst_feature_per_run", f"SELECT {DAY}, model_version, max(drift_score) AS max_score FROM feat GROUP BY ALL", "max_score")
def f8(t: Tables):
    return trends.worst_per_run(t.feat)


OFFENDERS = "SELECT feature_name, CAST(sum(CAST(drift_detected AS INT)) AS BIGINT) AS times_flagged FROM feat GROUP BY 1"


@check("f9_repeat_offenders", OFFENDERS)
def f9(t: Tables):
    return trends.repeat_offenders(t.feat)


def raw_sql(test: str, line: float) -> str:
    return f"""SELECT {DAY}, feature_name, avg(drift_score) AS avg_score, CAST({line} AS DOUBLE) AS reference_line FROM feat WHERE {test} GROUP BY ALL"""


@check("f10_raw_p_values", raw_sql("drift_method LIKE '%p_value%'", 0.05), "avg_score reference_line")
def f10(t: Tables):
    return trends.raw_scores(t.feat, True)


@check("f11_raw_distances", raw_sql("drift_method NOT LIKE '%p_value%'", 0.1), "avg_score reference_line")
def f11(t: Tables):
    return trends.raw_scores(t.feat, False)


@check(
    "n1_drift_stability",
    """SELECT *, CASE WHEN avg_magnitude <= 1 THEN CASE WHEN var_magnitude > avg_magnitude THEN 'sporadic' ELSE 'stable' END
                      WHEN var_magnitude > avg_magnitude * avg_magnitude THEN 'sporadic' ELSE 'systematic' END AS pattern
       FROM (SELECT feature_name, avg(drift_magnitude) AS avg_magnitude, var_pop(drift_magnitude) AS var_magnitude FROM feat GROUP BY 1)""",
    "avg_magnitude var_magnitude",
)
def n1(t: Tables):
    return trends.drift_stability(t.feat)


@check(
    "n2_top_features_by_day",
    f"""WITH daily AS (SELECT {DAY}, feature_name, avg(drift_magnitude) AS avg_magnitude FROM feat GROUP BY ALL)
        SELECT day, feature_name, avg_magnitude, features_over, inference_count, features_over > 1 AS busy_day
        FROM daily JOIN (SELECT day, count(*) FILTER (avg_magnitude > 1) AS features_over FROM daily GROUP BY 1) USING (day)
             JOIN (SELECT {DAY}, CAST(sum(inference_count) AS BIGINT) AS inference_count FROM joined GROUP BY 1) USING (day)
        WHERE feature_name IN (SELECT feature_name FROM feat GROUP BY 1 ORDER BY avg(drift_magnitude) DESC, 1 LIMIT 2)""",
    "avg_magnitude",
)
def n2(t: Tables):
    return trends.top_features_by_day(t.feat, t.joined, k=2, many=1)


#: The last 14 days up to the reference time, and the day it began.
LAST_DAYS = [str(datetime.date.fromisoformat(AS_OF[:10]) - datetime.timedelta(days=d)) for d in range(14, -1, -1)]


@check(
    "n3_feature_day_heatmap",
    f"SELECT {DAY}, feature_name, avg(drift_score) AS avg_score FROM feat WHERE monitoring_timestamp >= {LAST.format(14)} GROUP BY ALL",
    "avg_score",
)
def n3(t: Tables):
    return trends.feature_by_day(trends.recent(t.feat, "monitoring_timestamp", AS_OF, 14))


@check(
    "n3_feature_day_heatmap_wide",
    "SELECT feature_name, "
    + ", ".join(f"avg(drift_score) FILTER (CAST(monitoring_timestamp AS DATE) = DATE '{d}') AS \"{d}\"" for d in LAST_DAYS)
    + f" FROM feat WHERE monitoring_timestamp >= {LAST.format(14)} GROUP BY 1",
    " ".join(LAST_DAYS),
)
def n3_wide(t: Tables):
    long = trends.feature_by_day(trends.recent(t.feat, "monitoring_timestamp", AS_OF, 14)).withColumn("d", F.date_format("day", "yyyy-MM-dd"))
    return trends.wide(long, "feature_name", "d", "avg_score", LAST_DAYS)


@check(
    "n4_version_slopes",
    """SELECT model_version, avg(drifted_columns_share) AS avg_share,
              regr_slope(drifted_columns_share, date_diff('day', DATE '1970-01-01', CAST(monitoring_timestamp AS DATE))) AS slope_per_day, count(*) AS runs
       FROM runs GROUP BY 1""",
    "avg_share slope_per_day",
)
def n4(t: Tables):
    return trends.version_slopes(t.runs)


@check(
    "n5_worst_auc_days",
    f"""SELECT *, avg_current_roc_auc >= avg_baseline_roc_auc AS above_baseline
        FROM (SELECT {DAY}, avg(baseline_roc_auc) AS avg_baseline_roc_auc, avg(current_roc_auc) AS avg_current_roc_auc FROM runs GROUP BY 1)
        WHERE avg_current_roc_auc IS NOT NULL ORDER BY avg_current_roc_auc, day LIMIT 5""",
    "avg_baseline_roc_auc avg_current_roc_auc",
)
def n5(t: Tables):
    return trends.worst_auc_days(t.runs)


@check(
    "n6_bucket_shift",
    f"""SELECT *, current_pct - baseline_pct AS change_points, abs(current_pct - baseline_pct) > 10 AS flagged
        FROM (SELECT prediction_bucket AS bucket, count(*) FILTER (side = 'baseline') / sum(count(*) FILTER (side = 'baseline')) OVER () * 100 AS baseline_pct,
                     count(*) FILTER (side = 'current') / sum(count(*) FILTER (side = 'current')) OVER () * 100 AS current_pct
              FROM (SELECT *, CASE WHEN request_timestamp < TIMESTAMP '2024-01-08' THEN 'baseline'
                                   WHEN request_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY THEN 'current' END AS side FROM pred)
              WHERE side IS NOT NULL GROUP BY 1)""",
    "baseline_pct current_pct change_points",
)
def n6(t: Tables):
    ts = F.col("request_timestamp")
    side = F.when(ts < as_of_literal("2024-01-08 00:00:00"), "baseline").when(
        ts >= as_of_literal(AS_OF) - F.make_dt_interval(F.lit(7)), "current"
    )
    return trends.bucket_shift(t.pred, side)


@check(
    "n7_daily_coverage",
    """SELECT *, labelled / predictions * 100 AS coverage_pct, labelled / predictions < 0.2 AS low_coverage
       FROM (SELECT date_trunc('day', request_timestamp)::TIMESTAMP AS day, count(*) AS predictions, count(ground_truth) AS labelled,
                    avg(CASE WHEN ground_truth IS NOT NULL THEN CAST(prediction = ground_truth AS INT) END) AS accuracy FROM lpred GROUP BY 1)""",
    "accuracy coverage_pct",
)
def n7(t: Tables):
    return trends.daily_coverage(t.lpred)


@check(
    "n8_distribution_comparison",
    """SELECT bin, bin * (60.0::DOUBLE / 20) AS bin_start, CAST(a AS BIGINT) AS baseline_n, CAST(b AS BIGINT) AS current_n, a / sum(a) OVER () AS baseline_share,
              b / sum(b) OVER () AS current_share, b / sum(b) OVER () > 2 * (a / sum(a) OVER ()) AS over_represented
       FROM (SELECT CAST(least(floor(value / (60.0::DOUBLE / 20)), 19) AS INTEGER) AS bin, sum(1 - is_current) AS a, sum(is_current) AS b
             FROM line_sides WHERE feature = 'l_quantity' AND value BETWEEN 0 AND 60 GROUP BY 1)""",
    "bin_start baseline_share current_share",
)
def n8(t: Tables):
    sides = drift.stack_sides(t.base_side, t.current_side, ["l_quantity"])
    return trends.distribution_comparison(sides, "l_quantity", 0.0, 60.0, 20)


@check(
    "n8_side_summary",
    """SELECT is_current, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS stddev, quantile_cont(value, 0.5) AS median
       FROM line_sides WHERE feature = 'l_quantity' GROUP BY 1""",
    "mean stddev median",
)
def n8_summary(t: Tables):
    return trends.side_summary(drift.stack_sides(t.base_side, t.current_side, ["l_quantity"]), "l_quantity")


@check(
    "n9_offender_bands",
    f"SELECT *, CASE WHEN times_flagged >= 6 THEN '6+' WHEN times_flagged >= 3 THEN '3-5' ELSE '0-2' END AS band FROM ({OFFENDERS})",
)
def n9(t: Tables):
    return trends.offender_bands(trends.recent(t.feat, "monitoring_timestamp", AS_OF, 30))


@check(
    "n10_volume_drift_outliers",
    f"""SELECT day, inference_count, avg_share, slope, intercept, correlation, avg_share - (slope * inference_count + intercept) AS residual,
               CASE WHEN abs(avg_share - (slope * inference_count + intercept)) > 2 * std_share
                    THEN CASE WHEN inference_count < mean_volume THEN 'low_volume_drift' ELSE 'high_volume_drift' END END AS outlier
        FROM ({VOLUME}) CROSS JOIN (SELECT regr_slope(avg_share, inference_count) AS slope, regr_intercept(avg_share, inference_count) AS intercept,
             covar_pop(inference_count, avg_share) / nullif(stddev_pop(inference_count) * stddev_pop(avg_share), 0) AS correlation, avg(inference_count) AS mean_volume, stddev_samp(avg_share) AS std_share FROM ({VOLUME}))""",
    "avg_share slope intercept correlation residual",
)
def n10(t: Tables):
    return trends.volume_drift_outliers(t.joined)


@check(
    "n11_drift_by_version",
    """SELECT model_version, feature_severity AS drift_severity, avg(drift_score) AS avg_score, count(*) AS n, any_value(v) AS inference_count
       FROM feat JOIN (SELECT model_version, CAST(sum(inference_count) AS BIGINT) AS v FROM joined GROUP BY 1) USING (model_version) GROUP BY ALL""",
    "avg_score",
)
def n11(t: Tables):
    return trends.drift_by_version(t.feat, t.joined)


@check(
    "n12_drift_timeline",
    f"SELECT {DAY}, endpoint_name, drifted_columns_count, drifted_columns_share FROM runs WHERE monitoring_timestamp >= {LAST.format(30)}",
    "drifted_columns_share",
)
def n12(t: Tables):
    return trends.drift_timeline(t.runs, AS_OF)


@check(
    "n13_daily_accuracy",
    f"""SELECT date_trunc('day', request_timestamp)::TIMESTAMP AS day, count(*) AS predictions, avg(CAST(prediction = ground_truth AS INT)) AS accuracy
        FROM labelled WHERE request_timestamp >= {LAST.format(30)} GROUP BY 1""",
    "accuracy",
)
def n13(t: Tables):
    return trends.daily_accuracy(t.lpred, AS_OF)
