"""Late labels (C1-C3, W1, D1-D3, B13-B19) and run lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import columns as c
from tidewatch.operators import drift, labels, lineage, ops, quality
from tidewatch.plans.scoring import with_scores  # noqa: F401 - used through the prediction table
from tidewatch_checks.quality_queries import COVERAGE_SQL, ranking_sql  # noqa: F401
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, NUMERIC, Tables

JOINED = "(SELECT p.*, k.actual_fraud, k.confirmation_timestamp, k.confirmation_source, k.days_since_prediction FROM pred p JOIN known k USING (inference_id))"


@check(
    "c1_matched_updates",
    f"""SELECT inference_id, request_timestamp, endpoint_name, prediction, actual_fraud, confirmation_timestamp, confirmation_source,
               days_since_prediction FROM {JOINED}""",
    "days_since_prediction",
)
def matched_updates(t: Tables):
    return labels.matched_updates(t.pred, t.known).select(
        "inference_id", "request_timestamp", "endpoint_name", "prediction", "actual_fraud", "confirmation_timestamp",
        "confirmation_source", "days_since_prediction",
    )


LABEL_COLUMNS = "inference_id, request_timestamp, endpoint_name, prediction, ground_truth, ground_truth_timestamp, ground_truth_source, days_to_ground_truth"


@check("c2_label_merge", f"SELECT {LABEL_COLUMNS} FROM lpred", "days_to_ground_truth")
def label_merge(t: Tables):
    return t.lpred.select(*LABEL_COLUMNS.split(", "))


@check(
    "c2_label_merge_recent_force",
    f"""WITH old AS (SELECT inference_id, CAST(actual_fraud AS INTEGER) AS ground_truth, confirmation_timestamp AS ground_truth_timestamp FROM known WHERE batch_id = 'b1'),
             recent AS (SELECT inference_id, arg_max(CAST(actual_fraud AS INTEGER), (confirmation_timestamp, batch_id)) AS g, max(confirmation_timestamp) AS g_ts
                        FROM known WHERE confirmation_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR GROUP BY 1)
        SELECT inference_id, coalesce(g, ground_truth) AS ground_truth, coalesce(g_ts, ground_truth_timestamp) AS ground_truth_timestamp
        FROM pred LEFT JOIN old USING (inference_id) LEFT JOIN recent USING (inference_id)""",
)
def label_merge_recent_force(t: Tables):
    labelled_before = labels.merge_labels(t.pred, t.known.where("batch_id = 'b1'"))
    merged = labels.merge_labels(labelled_before, t.upd, force=True, as_of=AS_OF, window_hours=72)
    return merged.select("inference_id", "ground_truth", "ground_truth_timestamp")


@check(
    "c2_dry_run_changes",
    """SELECT inference_id, ground_truth AS new_ground_truth, ground_truth_timestamp AS new_ground_truth_timestamp,
              ground_truth_source AS new_ground_truth_source, days_to_ground_truth AS new_days_to_ground_truth FROM lab""",
    "new_days_to_ground_truth",
)
def dry_run(t: Tables):
    return labels.changed_predictions(t.pred, t.known)


@check(
    "c3_latest_label_by_key",
    """SELECT inference_id, (SELECT CAST(actual_fraud AS INTEGER) FROM known k WHERE k.inference_id = p.inference_id
                             ORDER BY confirmation_timestamp DESC, batch_id DESC LIMIT 1) AS ground_truth
       FROM pred p WHERE inference_id IN (SELECT DISTINCT inference_id FROM known)""",
)
def latest_by_key(t: Tables):
    ids = t.pred.select("inference_id").join(t.known.select("inference_id"), "inference_id", "left_semi")
    return ids.join(labels.latest_labels(t.known).select("inference_id", "ground_truth"), "inference_id")


@check("w1_latest_confirmation", "SELECT * FROM lab", "days_to_ground_truth")
def latest_confirmation(t: Tables):
    return labels.latest_labels(t.known)


@check("w1_latest_confirmation_ranked", "SELECT * FROM lab", "days_to_ground_truth")
def latest_confirmation_ranked(t: Tables):
    return labels.latest_labels_ranked(t.known)


@check("d1_label_coverage", f"SELECT {COVERAGE_SQL} FROM lpred", "avg_days_to_ground_truth coverage coverage_pct")
def label_coverage(t: Tables):
    return labels.label_coverage(t.lpred)


@check("d2_pending_updates", f"SELECT count(DISTINCT inference_id) AS pending_count FROM {JOINED}")
def pending(t: Tables):
    return labels.pending_count(t.pred, t.known)


@check(
    "d3_update_statistics",
    f"""SELECT *, correct_predictions / total_updates AS accuracy, false_positives / total_updates AS false_positive_rate,
               false_negatives / total_updates AS false_negative_rate
        FROM (SELECT count(*) AS total_updates, count(DISTINCT inference_id) AS distinct_predictions,
                     CAST(sum(CAST(actual_fraud AS INT)) AS BIGINT) AS fraud_cases,
                     CAST(sum(CASE WHEN prediction = CAST(actual_fraud AS INT) THEN 1 ELSE 0 END) AS BIGINT) AS correct_predictions,
                     CAST(sum(CASE WHEN prediction = 1 AND NOT actual_fraud THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
                     CAST(sum(CASE WHEN prediction = 0 AND actual_fraud THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives,
                     avg(days_since_prediction) AS avg_days_to_confirmation, min(confirmation_timestamp) AS earliest_confirmation,
                     max(confirmation_timestamp) AS latest_confirmation FROM {JOINED})""",
    "avg_days_to_confirmation accuracy false_positive_rate false_negative_rate",
)
def update_statistics(t: Tables):
    return labels.update_statistics(t.pred, t.known)


@check(
    "b19_update_preview",
    f"""SELECT inference_id, transaction_id, request_timestamp AS prediction_timestamp, prediction AS current_prediction,
               probability_fraud AS predicted_probability, CAST(NULL AS INTEGER) AS current_ground_truth, actual_fraud AS new_ground_truth,
               confirmation_timestamp, confirmation_source, days_since_prediction,
               CASE WHEN prediction = CAST(actual_fraud AS INT) THEN 'correct' ELSE 'incorrect' END AS prediction_correctness,
               CASE WHEN prediction = 1 AND NOT actual_fraud THEN 'false_positive' WHEN prediction = 0 AND actual_fraud THEN 'false_negative'
                    ELSE 'correct' END AS error_type
        FROM {JOINED}""",
    "predicted_probability days_since_prediction",
)
def update_preview(t: Tables):
    return labels.preview_updates(t.pred, t.known, limit=None)


@check(
    "b13_prediction_status",
    """SELECT inference_id, CASE WHEN ground_truth IS NULL THEN 'Pending' WHEN prediction = ground_truth THEN 'Correct' ELSE 'Incorrect' END AS prediction_accuracy
       FROM lpred""",
)
def prediction_status(t: Tables):
    return t.lpred.select("inference_id", c.prediction_status("prediction", "ground_truth").alias("prediction_accuracy"))


@check(
    "b14_risk_tier",
    """SELECT risk_tier, count(*) AS n FROM (SELECT CASE WHEN probability_fraud > 0.8 THEN 'High Risk' WHEN probability_fraud > 0.5 THEN 'Medium Risk'
              WHEN probability_fraud > 0.2 THEN 'Low Risk' ELSE 'Minimal Risk' END AS risk_tier FROM pred) GROUP BY 1""",
)
def risk_tier(t: Tables):
    return t.pred.groupBy(c.risk_tier("probability_fraud").alias("risk_tier")).agg(F.count("*").alias("n"))


@check("b15_run_severity", "SELECT monitoring_run_id, drift_severity FROM runs")
def run_severity(t: Tables):
    return t.runs.select("monitoring_run_id", c.run_severity("drifted_columns_share").alias("drift_severity"))


@check("b16_performance_status", "SELECT monitoring_run_id, performance_status FROM runs")
def performance_status(t: Tables):
    return t.runs.select("monitoring_run_id", c.performance_status("current_roc_auc").alias("performance_status"))


@check(
    "b17_accuracy_percent",
    """SELECT endpoint_name, model_version, count(inference_id) AS n, sum(prediction_match) / count(inference_id) * 100 AS accuracy_pct
       FROM acc GROUP BY ALL""",
    "accuracy_pct",
)
def accuracy_percent(t: Tables):
    return lineage.accuracy_percent(t.acc, ["endpoint_name", "model_version"])


@check("b18_accuracy_rows", "SELECT * FROM acc", "days_since_prediction")
def accuracy_rows(t: Tables):
    return t.acc


# -- lineage --------------------------------------------------------------------------------------

RUN_COLUMNS = ", ".join(f'"{x}"' for x in lineage.RUN_COLUMNS)


@check(
    "c4_runs_with_predictions",
    f"SELECT {RUN_COLUMNS}, endpoint_name, inference_count, avg_fraud_prob, gt_count, window_start, window_end FROM joined",
    "drifted_columns_share baseline_roc_auc current_roc_auc accuracy precision recall f1_score avg_fraud_prob",
    digits=8,
)
def runs_with_predictions(t: Tables):
    return t.joined


@check("c5_run_tags", "SELECT inference_id, request_timestamp, endpoint_name, monitoring_run_id FROM tagged")
def run_tags(t: Tables):
    return t.tagged.select("inference_id", "request_timestamp", "endpoint_name", "monitoring_run_id")


@check("d28_tagged_counts", "SELECT monitoring_run_id, count(*) AS n FROM tagged WHERE monitoring_run_id IS NOT NULL GROUP BY 1")
def tagged_counts(t: Tables):
    return ops.tagged_counts(t.tagged)


@check(
    "c6_feature_drift_detail",
    """SELECT monitoring_run_id, monitoring_timestamp, model_version, model_package_arn, evaluation_snapshot_id, training_snapshot_id,
              endpoint_name, data_drift_detected, drifted_columns_count, drifted_columns_share, baseline_roc_auc, current_roc_auc,
              feature_name, drift_score, drift_magnitude, drift_method, drift_threshold, feature_severity AS drift_severity, drift_detected
       FROM feat""",
    "drifted_columns_share baseline_roc_auc current_roc_auc drift_score drift_magnitude drift_threshold",
)
def feature_detail(t: Tables):
    return t.feat


@check(
    "c7_trace_latest_run",
    """SELECT inference_id, request_timestamp, prediction, probability_fraud, ground_truth, monitoring_run_id FROM tagged
       WHERE monitoring_run_id = (SELECT monitoring_run_id FROM runs ORDER BY monitoring_timestamp DESC, monitoring_run_id DESC LIMIT 1)""",
    "probability_fraud",
)
def trace_run(t: Tables):
    return lineage.trace_run(t.runs, t.tagged)


@check(
    "c8_drift_by_importance",
    """WITH m AS (SELECT feature, score / 0.1 AS drift_magnitude FROM (
            SELECT feature, sum(abs(fa - fb) * (next_value - value)) / any_value(sd) AS score
            FROM side_prefix JOIN (SELECT feature, stddev_samp(value) AS sd FROM line_sides WHERE is_current = 0 GROUP BY 1) USING (feature) GROUP BY feature)),
            i AS (SELECT unnest([{'feature': 'l_quantity', 'importance': avg(abs(phi_quantity))}, {'feature': 'l_discount', 'importance': avg(abs(phi_discount))},
                                 {'feature': 'l_tax', 'importance': avg(abs(phi_tax))}], recursive := true) FROM attributions),
            r AS (SELECT feature, drift_magnitude, importance, row_number() OVER (ORDER BY drift_magnitude DESC, feature) AS drift_rank,
                         row_number() OVER (ORDER BY importance DESC, feature) AS importance_rank, count(*) OVER () AS n FROM m JOIN i USING (feature))
       SELECT feature, drift_magnitude, importance, drift_rank, importance_rank,
              CASE WHEN drift_magnitude > 1 AND importance_rank <= ceil(n * 0.5) THEN 'high_risk' WHEN drift_magnitude > 1 THEN 'low_risk_noise'
                   WHEN importance_rank <= ceil(n * 0.5) THEN 'watch' ELSE 'stable' END AS verdict FROM r""",
    "drift_magnitude importance",
)
def drift_by_importance(t: Tables):
    from tidewatch.operators.attribution import mean_attribution

    scored = drift.explicit_test(t.base_side, t.current_side, NUMERIC, "wasserstein")
    shown = t.attributions.withColumnsRenamed({"l_quantity": "x1", "l_discount": "x2", "l_tax": "x3"}).withColumnsRenamed(
        {"phi_quantity": "l_quantity", "phi_discount": "l_discount", "phi_tax": "l_tax"}
    )
    return lineage.drift_by_importance(scored, mean_attribution(shown, ["l_quantity", "l_discount", "l_tax"])).select(
        "feature", "drift_magnitude", "importance",
        F.col("drift_rank").cast("bigint").alias("drift_rank"), F.col("importance_rank").cast("bigint").alias("importance_rank"), "verdict",
    )


@check(
    "c9_version_consistency",
    f"""WITH e AS (SELECT * FROM (VALUES ('ep-a', 'v2', 'run-v2'), ('ep-b', 'v1', 'run-v1'), ('ep-c', 'v1', 'unknown')) v(endpoint_name, expected_version, expected_run_id)),
             o AS (SELECT endpoint_name, arg_max(model_version, (n, model_version)) AS observed_version, arg_max(mlflow_run_id, (n, model_version)) AS observed_run_id, max(n) AS n
                   FROM (SELECT endpoint_name, model_version, mlflow_run_id, count(*) AS n FROM pred
                         WHERE request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR AND request_timestamp <= TIMESTAMP '{AS_OF}' GROUP BY ALL) GROUP BY 1)
        SELECT coalesce(e.endpoint_name, o.endpoint_name) AS endpoint_name, expected_version, observed_version, expected_run_id, observed_run_id,
               coalesce(n, 0) AS observed_count,
               CASE WHEN o.endpoint_name IS NULL OR expected_version IS NULL THEN 'WARNING' WHEN observed_version = expected_version THEN 'PASS' ELSE 'FAIL' END AS version_check,
               CASE WHEN coalesce(observed_run_id, 'unknown') = 'unknown' OR coalesce(expected_run_id, 'unknown') = 'unknown' THEN 'WARNING'
                    WHEN observed_run_id = expected_run_id THEN 'PASS' ELSE 'WARNING' END AS run_id_check,
               CASE WHEN o.endpoint_name IS NOT NULL AND expected_version IS NOT NULL AND observed_version <> expected_version THEN 'FAIL' ELSE 'PASS' END AS status
        FROM e FULL OUTER JOIN o ON e.endpoint_name = o.endpoint_name""",
)
def version_consistency(t: Tables):
    expected = t.spark.createDataFrame(
        [("ep-a", "v2", "run-v2"), ("ep-b", "v1", "run-v1"), ("ep-c", "v1", "unknown")],
        "endpoint_name string, model_version string, mlflow_run_id string",
    )
    return lineage.version_consistency(expected, t.pred, AS_OF, hours=48)


@check(
    "c10_common_features",
    """SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature, n FROM (SELECT count(*) AS n FROM both_sides)""",
)
def common_features(t: Tables):
    current = t.current_side.drop("l_returnflag")
    shared = drift.common_features(t.base_side, current, [*NUMERIC, "l_returnflag", "not_there"])
    stacked = drift.melt_numeric(drift.stack_sides(t.base_side, current, shared), shared)
    return stacked.groupBy("feature").agg(F.count("*").alias("n"))


@check(
    "d24_view_summary",
    """SELECT count(*) AS total_rows, count(DISTINCT feature_name) AS features, count(DISTINCT monitoring_run_id) AS runs,
              min(monitoring_timestamp) AS first_run, max(monitoring_timestamp) AS last_run FROM feat""",
)
def view_summary(t: Tables):
    return ops.view_summary(t.feat)


@check(
    "d25_tracking_audit",
    """SELECT *, unique_ids = tracked_runs AS all_unique FROM (
         SELECT count(*) AS total_runs, count(mlflow_run_id) AS tracked_runs, count(DISTINCT mlflow_run_id) AS unique_ids,
                count(*) - count(mlflow_run_id) AS null_ids
         FROM (SELECT * FROM runs ORDER BY monitoring_timestamp DESC, monitoring_run_id LIMIT 10))""",
)
def tracking_audit(t: Tables):
    return ops.tracking_audit(t.runs)
