"""Model quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.columns import as_of_literal
from tidewatch.operators import attribution, baselines, quality
from tidewatch.plans import drift_check, scoring
from tidewatch.plans.performance_report import labelled_predictions, performance_report
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, LINE_SCHEMA, Tables

CONFUSION = """
    count(*) AS sample_count,
    CAST(sum(CASE WHEN p = 1 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS true_positives,
    CAST(sum(CASE WHEN p = 0 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS true_negatives,
    CAST(sum(CASE WHEN p = 1 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
    CAST(sum(CASE WHEN p = 0 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives"""
RATES = """
    (true_positives + true_negatives) / sample_count AS accuracy,
    coalesce(true_positives / nullif(true_positives + false_positives, 0), 0) AS "precision",
    coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0) AS recall,
    coalesce(true_negatives / nullif(true_negatives + false_positives, 0), 0) AS specificity,
    coalesce(2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1_score,
    coalesce(false_positives / nullif(false_positives + true_negatives, 0), 0) AS false_positive_rate,
    coalesce(false_negatives / nullif(false_negatives + true_positives, 0), 0) AS false_negative_rate,
    (true_positives + false_negatives) / sample_count AS positive_rate,
    (true_positives + false_positives) / sample_count AS prediction_rate"""
RATE_NAMES = "accuracy precision recall specificity f1_score false_positive_rate false_negative_rate positive_rate prediction_rate"


def confusion_sql(source: str, p: str = "prediction", keys: str = "") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"SELECT {lead}{CONFUSION} FROM (SELECT *, {p} AS p, ground_truth AS y FROM {source}) {group}"


def ranking_sql(source: str, keys: str = "") -> str:
    """AUC, trapezoid PR area and average precision per key, NULL where a class is missing."""
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
    SELECT {lead}CAST(max(pt) AS BIGINT) AS positive_samples, CAST(max(nt) AS BIGINT) AS negative_samples,
           CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN sum(pos * (nt - fp + neg / 2)) / (max(pt) * max(nt)) END AS roc_auc,
           CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN sum(pos * (tp / (tp + fp)
                + coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), 1)) / 2) / max(pt) END AS pr_auc,
           CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN sum(pos * tp / (tp + fp)) / max(pt) END AS average_precision
    FROM (SELECT *, sum(pos) OVER ({part}) AS pt, sum(neg) OVER ({part}) AS nt,
                 sum(pos) OVER ({part} ORDER BY s DESC) AS tp, sum(neg) OVER ({part} ORDER BY s DESC) AS fp
          FROM (SELECT {lead}probability_fraud AS s, sum(ground_truth)::DOUBLE AS pos, sum(1 - ground_truth)::DOUBLE AS neg
                FROM {source} GROUP BY ALL)) {group}"""


@check("e1_confusion", confusion_sql("labelled"))
def confusion(t: Tables):
    return quality.confusion(t.lpred, "ground_truth", "prediction")


@check(
    "e2_confusion_at_threshold",
    f"""SELECT *, {RATES}, CAST(0.7 AS DOUBLE) AS threshold, CASE WHEN sample_count >= 10 THEN 'ok' ELSE 'insufficient_samples' END AS status
        FROM ({confusion_sql("labelled", "CASE WHEN probability_fraud >= 0.7 THEN 1 ELSE 0 END")})""",
    RATE_NAMES + " threshold",
)
def confusion_at_threshold(t: Tables):
    return quality.confusion_at_threshold(t.lpred, "ground_truth", "probability_fraud", 0.7)


@check("e3_rates_by_endpoint", f"SELECT *, {RATES} FROM ({confusion_sql('labelled', keys='endpoint_name')})", RATE_NAMES)
def rates(t: Tables):
    return quality.with_rates(quality.confusion(t.lpred, "ground_truth", "prediction", ["endpoint_name"]))


@check("e4_roc_auc", f"SELECT roc_auc FROM ({ranking_sql('labelled')})", "roc_auc")
def roc_auc(t: Tables):
    return quality.ranking_metrics(t.lpred, "ground_truth", "probability_fraud").select("roc_auc")


@check("e5_pr_auc", f"SELECT pr_auc FROM ({ranking_sql('labelled')})", "pr_auc")
def pr_auc(t: Tables):
    return quality.ranking_metrics(t.lpred, "ground_truth", "probability_fraud").select("pr_auc")


@check("e6_average_precision", f"SELECT average_precision FROM ({ranking_sql('labelled')})", "average_precision")
def average_precision(t: Tables):
    return quality.ranking_metrics(t.lpred, "ground_truth", "probability_fraud").select("average_precision")


@check("e4_ranking_by_version", ranking_sql("labelled", "model_version"), "roc_auc pr_auc average_precision")
def ranking_by_version(t: Tables):
    return quality.ranking_metrics(t.lpred, "ground_truth", "probability_fraud", ["model_version"])


@check("e7_roc_curve", "SELECT s AS threshold, tp / pt AS tpr, fp / nt AS fpr FROM score_prefix", "threshold tpr fpr")
def roc_curve(t: Tables):
    return quality.roc_curve(t.lpred, "ground_truth", "probability_fraud")


@check(
    "e7_pr_curve", """SELECT s AS threshold, tp / (tp + fp) AS "precision", tp / pt AS recall FROM score_prefix""", "threshold precision recall"
)
def pr_curve(t: Tables):
    return quality.pr_curve(t.lpred, "ground_truth", "probability_fraud")


def class_report_sql(source: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
    WITH conf AS ({confusion_sql(source, keys=keys)}),
    per_class AS (
      SELECT {lead}'0' AS class, coalesce(true_negatives / nullif(true_negatives + false_negatives, 0), 0) AS "precision",
             coalesce(true_negatives / nullif(true_negatives + false_positives, 0), 0) AS recall,
             coalesce(2 * true_negatives / nullif(2 * true_negatives + false_negatives + false_positives, 0), 0) AS f1_score,
             true_negatives + false_positives AS support, (true_positives + true_negatives) / sample_count AS accuracy FROM conf
      UNION ALL
      SELECT {lead}'1', coalesce(true_positives / nullif(true_positives + false_positives, 0), 0),
             coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0),
             coalesce(2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0),
             true_positives + false_negatives, (true_positives + true_negatives) / sample_count FROM conf)
    SELECT {lead}class, "precision", recall, f1_score, support, accuracy FROM per_class
    UNION ALL SELECT {lead}'macro avg', avg("precision"), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT), max(accuracy) FROM per_class {group}
    UNION ALL SELECT {lead}'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
                     sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT), max(accuracy) FROM per_class {group}"""


@check("e8_class_report", f"SELECT * FROM ({class_report_sql('labelled')})", "precision recall f1_score accuracy")
def class_report(t: Tables):
    return quality.class_report(t.lpred, "ground_truth", "prediction")


@check(
    "e9_class_counts",
    """SELECT count(*) AS test_samples, CAST(sum(ground_truth) AS BIGINT) AS positive_samples,
              CAST(sum(1 - ground_truth) AS BIGINT) AS negative_samples, CAST(0.5 AS DOUBLE) AS threshold FROM labelled""",
    "threshold",
)
def class_counts(t: Tables):
    return quality.class_counts(t.lpred, "ground_truth")


@check(
    "e10_quality_gates",
    f"""SELECT metric, value, threshold, value >= threshold AS passed,
               CASE WHEN value < threshold THEN printf('%s %.4f < %.4f', metric, value, threshold) END AS failure
        FROM (SELECT unnest([{{'metric': 'roc_auc', 'value': roc_auc, 'threshold': 0.95::DOUBLE}},
                             {{'metric': 'average_precision', 'value': average_precision, 'threshold': 0.5::DOUBLE}}], recursive := true)
              FROM ({ranking_sql('labelled')}))""",
    "value threshold",
)
def quality_gates(t: Tables):
    metrics = quality.ranking_metrics(t.lpred, "ground_truth", "probability_fraud")
    return quality.quality_gates(metrics, {"roc_auc": 0.95, "average_precision": 0.5})


def windows_sql(unit: str, minimum: int) -> str:
    source = f"(SELECT *, date_trunc('{unit}', request_timestamp)::TIMESTAMP AS period FROM labelled)"
    return f"""
    SELECT c.*, roc_auc, pr_auc, average_precision, period_start, period_end
    FROM (SELECT *, {RATES} FROM ({confusion_sql(source, keys='period')}) WHERE sample_count >= {minimum}) c
    JOIN ({ranking_sql(source, 'period')}) r USING (period)
    JOIN (SELECT period, min(request_timestamp) AS period_start, max(request_timestamp) AS period_end FROM {source} GROUP BY 1) s
      USING (period)"""


WINDOW_FLOATS = RATE_NAMES + " roc_auc pr_auc average_precision"


@check("e11_daily_metrics", windows_sql("day", 20), WINDOW_FLOATS)
def daily_metrics(t: Tables):
    return quality.windowed_metrics(t.labelled, "request_timestamp", "day", min_samples=20)


@check("e11_weekly_metrics", windows_sql("week", 20), WINDOW_FLOATS)
def weekly_metrics(t: Tables):
    return quality.windowed_metrics(t.labelled, "request_timestamp", "week", min_samples=20)


@check(
    "e12_degradation_alerts",
    f"""SELECT period, 'roc_auc' AS metric, roc_auc AS value, base AS baseline, CAST(0.9 AS DOUBLE) AS threshold, base - roc_auc AS degradation,
               (base - roc_auc) / base * 100 AS degradation_pct, CASE WHEN roc_auc < 0.9 - 0.05 THEN 'critical' ELSE 'warning' END AS severity,
               sample_count
        FROM ({windows_sql('day', 20)}) CROSS JOIN (SELECT avg(roc_auc) AS base FROM ({windows_sql('day', 20)}))
        WHERE roc_auc < 0.9""",
    "value baseline threshold degradation degradation_pct",
)
def degradation_alerts(t: Tables):
    return quality.degradation_alerts(quality.windowed_metrics(t.labelled, "request_timestamp", "day", min_samples=20), 0.9)


REPORT_ROWS = f"""(SELECT * FROM labelled WHERE request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND endpoint_name = 'ep-b')"""


@check(
    "e13_performance_report",
    f"""SELECT c.*, {RATES}, roc_auc, pr_auc, average_precision FROM ({confusion_sql(REPORT_ROWS)}) c CROSS JOIN ({ranking_sql(REPORT_ROWS)}) r
        WHERE sample_count >= 100""",
    WINDOW_FLOATS,
)
def report_overall(t: Tables):
    return performance_report(t.lpred, AS_OF, "ep-b").overall


COVERAGE_SQL = """
    count(*) AS total_predictions, count(ground_truth) AS with_ground_truth, count(*) - count(ground_truth) AS without_ground_truth,
    min(request_timestamp) AS earliest_prediction, max(request_timestamp) AS latest_prediction,
    min(ground_truth_timestamp) AS earliest_confirmation, max(ground_truth_timestamp) AS latest_confirmation,
    avg(days_to_ground_truth) AS avg_days_to_ground_truth, coalesce(count(ground_truth) / nullif(count(*), 0), 0) AS coverage,
    coalesce(count(ground_truth) / nullif(count(*), 0), 0) * 100 AS coverage_pct"""


@check(
    "e13_report_coverage",
    f"""SELECT {COVERAGE_SQL}, CASE WHEN count(ground_truth) >= 100 THEN 'ok' ELSE 'insufficient_ground_truth' END AS status
        FROM lpred WHERE request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND endpoint_name = 'ep-b'""",
    "avg_days_to_ground_truth coverage coverage_pct",
)
def report_coverage(t: Tables):
    return performance_report(t.lpred, AS_OF, "ep-b").coverage


@check(
    "e14_model_drift_check",
    f"""SELECT CAST(0.92 AS DOUBLE) AS baseline_roc_auc, 'default' AS baseline_source, roc_auc AS current_roc_auc, {RATES.replace('specificity', 'sp_')},
               sample_count AS model_sample_size, 0.92 - roc_auc AS roc_auc_degradation, (0.92 - roc_auc) / 0.92 * 100 AS roc_auc_degradation_pct,
               (0.92 - roc_auc) / 0.92 * 100 >= 5 AND sample_count >= 100 AS model_drift_detected,
               CASE WHEN sample_count >= 100 THEN 'ok' ELSE 'insufficient_samples' END AS model_status
        FROM ({confusion_sql(REPORT_ROWS)}) CROSS JOIN ({ranking_sql(REPORT_ROWS)})""".replace(
        RATES.replace("specificity", "sp_"),
        ",".join(p for p in RATES.split(",\n") if any(k in p for k in ("AS accuracy", 'AS "precision"', "AS recall", "AS f1_score"))),
    ),
    "baseline_roc_auc current_roc_auc accuracy precision recall f1_score roc_auc_degradation roc_auc_degradation_pct",
)
def model_drift(t: Tables):
    return drift_check.model_drift_check(t.lpred, AS_OF, 30, "ep-b")


SIDES = "(SELECT *, CASE WHEN request_timestamp < TIMESTAMP '2024-01-16' THEN 'baseline' ELSE 'current' END AS side FROM labelled)"


@check(
    "e15_side_comparison",
    f"""WITH rep AS ({class_report_sql(SIDES, 'side')})
        SELECT class, b."precision" AS baseline_precision, b.recall AS baseline_recall, b.f1_score AS baseline_f1_score, b.support AS baseline_support,
               b.accuracy AS baseline_accuracy, c."precision" AS current_precision, c.recall AS current_recall, c.f1_score AS current_f1_score,
               c.support AS current_support, c.accuracy AS current_accuracy, c."precision" - b."precision" AS delta_precision,
               c.recall - b.recall AS delta_recall, c.f1_score - b.f1_score AS delta_f1_score, c.accuracy - b.accuracy AS delta_accuracy
        FROM (SELECT * FROM rep WHERE side = 'baseline') b JOIN (SELECT * FROM rep WHERE side = 'current') c USING (class)""",
    "baseline_precision baseline_recall baseline_f1_score baseline_accuracy current_precision current_recall current_f1_score "
    "current_accuracy delta_precision delta_recall delta_f1_score delta_accuracy",
)
def side_comparison(t: Tables):
    cut = as_of_literal("2024-01-16 00:00:00")
    _, report = drift_check.classification_comparison(
        t.labelled.where(F.col("request_timestamp") < cut), t.labelled.where(F.col("request_timestamp") >= cut)
    )
    return report


@check(
    "e15_degenerate_columns",
    f"""SELECT side, "column", n_classes FROM (
          SELECT side, unnest([{{'column': 'ground_truth', 'n_classes': count(DISTINCT ground_truth)}},
                               {{'column': 'high', 'n_classes': count(DISTINCT high)}}], recursive := true)
          FROM (SELECT *, 0 AS high FROM {SIDES}) GROUP BY side) WHERE n_classes < 2""",
)
def degenerate(t: Tables):
    side = F.when(F.col("request_timestamp") < as_of_literal("2024-01-16 00:00:00"), "baseline").otherwise("current")
    rows = t.labelled.select(side.alias("side"), "ground_truth", F.lit(0).alias("high"))
    return quality.degenerate_columns(rows, ["ground_truth", "high"]).withColumn("n_classes", F.col("n_classes").cast("bigint"))


@check(
    "e16_labelled_predictions",
    f"""SELECT inference_id, request_timestamp, prediction, probability_fraud, ground_truth, ground_truth_source, days_to_ground_truth
        FROM {REPORT_ROWS} ORDER BY request_timestamp DESC""",
    "probability_fraud days_to_ground_truth",
)
def labelled_rows(t: Tables):
    rows = labelled_predictions(t.lpred, AS_OF, "ep-b")
    return rows.select(
        "inference_id", "request_timestamp", "prediction", "probability_fraud", "ground_truth", "ground_truth_source", "days_to_ground_truth"
    ).orderBy(F.desc("request_timestamp"))


PHI = ["phi_quantity", "phi_discount", "phi_tax"]


@check(
    "e17_mean_attribution",
    """SELECT unnest([{'feature': 'phi_quantity', 'importance': avg(abs(phi_quantity))}, {'feature': 'phi_discount', 'importance': avg(abs(phi_discount))},
                      {'feature': 'phi_tax', 'importance': avg(abs(phi_tax))}], recursive := true) FROM attributions""",
    "importance",
)
def mean_attribution(t: Tables):
    return attribution.mean_attribution(t.attributions, PHI)


ADDITIVE = """(SELECT *, base_value + phi_quantity + phi_discount + phi_tax AS attribution_sum,
                     abs(1 / (1 + exp(-(base_value + phi_quantity + phi_discount + phi_tax))) - prediction) AS error FROM attributions)"""


@check(
    "e18_additivity",
    f"""SELECT count(*) AS n, max(error) AS max_error, avg(error) AS mean_error, CAST(sum(CASE WHEN error > 0.0001 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
               sum(CASE WHEN error > 0.0001 THEN 1 ELSE 0 END) = 0 AS passed FROM {ADDITIVE}""",
    "max_error mean_error",
)
def additivity(t: Tables):
    return attribution.additivity(t.attributions, PHI, "base_value", "prediction")


@check(
    "e18_additivity_failures",
    f"SELECT row_key, l_partkey, attribution_sum, error FROM {ADDITIVE} WHERE error > 0.0001",
    "attribution_sum error",
)
def additivity_failures(t: Tables):
    rows = attribution.additivity_failures(t.attributions, PHI, "base_value", "prediction")
    return rows.select("row_key", "l_partkey", "attribution_sum", "error")


@check(
    "e19_extreme_cases",
    """SELECT 'highest' AS "case", max(prediction) AS prediction FROM attributions
       UNION ALL SELECT 'lowest', min(prediction) FROM attributions""",
    "prediction",
)
def extreme_cases(t: Tables):
    return attribution.extreme_rows(t.attributions, "prediction", "row_key").select("case", "prediction")


@check(
    "e19_dependence_pairs",
    """WITH m AS (SELECT unnest([{'feature': 'l_quantity', 'i': avg(abs(phi_quantity))}, {'feature': 'l_discount', 'i': avg(abs(phi_discount))},
                                 {'feature': 'l_tax', 'i': avg(abs(phi_tax))}], recursive := true) FROM attributions),
            top AS (SELECT feature FROM m ORDER BY i DESC, feature LIMIT 2)
       SELECT row_key, feature, value, attribution FROM (
         SELECT row_key, unnest([{'feature': 'l_quantity', 'value': l_quantity, 'attribution': phi_quantity},
                                 {'feature': 'l_discount', 'value': l_discount, 'attribution': phi_discount},
                                 {'feature': 'l_tax', 'value': l_tax, 'attribution': phi_tax}], recursive := true) FROM attributions)
       WHERE feature IN (SELECT feature FROM top)""",
    "value attribution",
)
def dependence_pairs(t: Tables):
    pairs = {"l_quantity": "phi_quantity", "l_discount": "phi_discount", "l_tax": "phi_tax"}
    return attribution.dependence_pairs(t.attributions, pairs, "row_key", 2)


# -- baselines ------------------------------------------------------------------------------------


def _baseline_frames(t: Tables):
    """Deployments and baselines seen in the log: version, first use, AUC; only v1 is approved."""
    first = t.lpred.groupBy("endpoint_name", "model_version").agg(F.min("request_timestamp").alias("valid_from"))
    auc = quality.ranking_metrics(t.lpred, "ground_truth", "probability_fraud", ["model_version"]).select("model_version", "roc_auc")
    created = t.lpred.groupBy("model_version").agg(F.min("request_timestamp").alias("created_at"))
    records = auc.join(created, "model_version").withColumn(
        "approval_status", F.when(F.col("model_version") == "v1", "Approved").otherwise("Rejected")
    )
    return first, records


@check(
    "d31_baseline_resolution",
    f"""WITH dep AS (SELECT endpoint_name, model_version, min(request_timestamp) AS valid_from FROM lpred GROUP BY ALL),
             live AS (SELECT endpoint_name, arg_max(model_version, (valid_from, model_version)) AS deployed_version FROM dep
                      WHERE valid_from <= TIMESTAMP '{AS_OF}' GROUP BY 1),
             rec AS (SELECT model_version, roc_auc, created_at, CASE WHEN model_version = 'v1' THEN 'Approved' ELSE 'Rejected' END AS approval_status
                     FROM ({ranking_sql('labelled', 'model_version')})
                     JOIN (SELECT model_version, min(request_timestamp) AS created_at FROM lpred GROUP BY 1) USING (model_version))
        SELECT endpoint_name, deployed_version, deployed_version AS model_version, 'deployed' AS source, roc_auc, created_at, approval_status
        FROM live JOIN rec ON rec.model_version = live.deployed_version""",
    "roc_auc",
)
def baseline_resolution(t: Tables):
    deployments, records = _baseline_frames(t)
    return baselines.resolve_baselines(deployments, records, AS_OF)


@check(
    "d31_baseline_fallback",
    f"""WITH rec AS (SELECT model_version, roc_auc FROM ({ranking_sql('labelled', 'model_version')}) WHERE model_version = 'v1')
        SELECT endpoint_name, 'v9' AS deployed_version, model_version, 'latest_approved' AS source, roc_auc
        FROM (SELECT DISTINCT endpoint_name FROM lpred) CROSS JOIN rec""",
    "roc_auc",
)
def baseline_fallback(t: Tables):
    deployments, records = _baseline_frames(t)
    unknown = deployments.withColumn("model_version", F.lit("v9"))
    return baselines.resolve_baselines(unknown, records, AS_OF).drop("created_at", "approval_status")


@check(
    "d30_baseline_record",
    f"""SELECT 2 AS schema_version, TIMESTAMP '{AS_OF}' AS created_at, 'v1' AS model_version, 'training_data' AS training_table, 'evaluation_data' AS evaluation_table,
               'l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,l_linestatus:string' AS feature_schema,
               roc_auc, pr_auc, coalesce(true_positives / nullif(true_positives + false_positives, 0), 0) AS "precision",
               coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0) AS recall, (true_positives + true_negatives) / sample_count AS accuracy,
               sample_count AS sample_size, true_positives + false_negatives AS positive_samples, true_negatives + false_positives AS negative_samples
        FROM ({confusion_sql('labelled')}) CROSS JOIN (SELECT roc_auc, pr_auc FROM ({ranking_sql('labelled')}))""",
    "roc_auc pr_auc precision recall accuracy",
)
def baseline_record(t: Tables):
    """The nested record, flattened for comparison."""
    metrics = quality.performance_metrics(t.labelled)
    record = baselines.baseline_record(metrics, LINE_SCHEMA, "v1", AS_OF, "training_data", "evaluation_data")
    listed = F.array_join(F.transform("feature_schema", lambda f: F.concat(f["name"], F.lit(":"), f["dtype"])), ",")
    return record.select(
        "schema_version", "created_at", "model_version", "training_table", "evaluation_table", listed.alias("feature_schema"),
        *[F.col(f"metrics.{m}").alias(m) for m in ("roc_auc", "pr_auc", "precision", "recall", "accuracy")],
        "sample_size", "positive_samples", "negative_samples",
    )


SCORED_LINES = """(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS ground_truth, s AS probability_fraud, CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS prediction
                   FROM (SELECT *, ((l_orderkey * 31 + l_linenumber * 17) % 1000) / 1000.0::DOUBLE AS s FROM lineitem))"""


@check(
    "v3_evaluation_of_scores",
    f"""SELECT 'v9' AS model_version, roc_auc, pr_auc, coalesce(true_positives / nullif(true_positives + false_positives, 0), 0) AS "precision",
               coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0) AS recall, sample_count AS sample_size,
               true_positives + false_negatives AS positive_samples, (roc_auc >= 0.4)::INT + (pr_auc >= 0.9)::INT AS gates_passed,
               CASE WHEN roc_auc >= 0.4 AND pr_auc >= 0.9 THEN 'Approved' ELSE 'PendingManualApproval' END AS approval_status
        FROM ({confusion_sql(SCORED_LINES)}) CROSS JOIN (SELECT roc_auc, pr_auc FROM ({ranking_sql(SCORED_LINES)}))""",
    "roc_auc pr_auc precision recall",
)
def evaluation_of_scores(t: Tables):
    """Scored rows to gates and a baseline record; the scores are a formula, so that SQL can follow."""
    p = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 1000 / 1000.0
    rows = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), p.alias("probability_fraud"))
    gates, record = scoring.evaluate(
        scoring.with_scores(rows), "y", LINE_SCHEMA, {"roc_auc": 0.4, "pr_auc": 0.9}, "v9", AS_OF, "training_data", "evaluation_data"
    )
    passed = gates.agg(F.count_if("passed").cast("int").alias("gates_passed"))
    return record.crossJoin(F.broadcast(passed)).select(
        "model_version", *[F.col(f"metrics.{m}").alias(m) for m in ("roc_auc", "pr_auc", "precision", "recall")],
        "sample_size", "positive_samples", "gates_passed", "approval_status",
    )
