"""Joins between monitoring runs, predictions, per-feature scores, and expected versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import feature_severity, prediction_category, prediction_match
from tidewatch.operators import windows as spans
from tidewatch.operators.kernel import join_on

RUN_COLUMNS = (
    "monitoring_run_id", "monitoring_timestamp", "model_version", "model_package_arn", "evaluation_snapshot_id",
    "training_snapshot_id", "drifted_columns_count", "drifted_columns_share", "features_analyzed", "baseline_roc_auc",
    "current_roc_auc", "data_drift_detected", "accuracy", "precision", "recall", "f1_score",
)


def run_windows(runs: DataFrame) -> DataFrame:
    """(endpoint_name, run_id, lo, hi]: the span each run covers; the first has no lower bound."""
    per_endpoint = Window.partitionBy("endpoint_name").orderBy("monitoring_timestamp", "monitoring_run_id")
    return runs.select(
        "endpoint_name",
        F.col("monitoring_run_id").alias("run_id"),
        F.lag("monitoring_timestamp").over(per_endpoint).alias("lo"),
        F.col("monitoring_timestamp").alias("hi"),
    )


def tag_runs(predictions: DataFrame, windows: DataFrame) -> DataFrame:
    """Fill ``monitoring_run_id`` of untagged predictions with the run whose window holds them.

    A range join made equal: every window is cut into the days it touches, so predictions meet only
    the runs of their own endpoint and day.  What is older than the first day on which any run ended can belong to first runs only, which
    have no lower bound: it is looked up under that day, so the log is read once and its own first day does not matter.
    Tagged rows and rows after the last run stay as they are.
    """
    begin = windows.agg(F.min(F.to_date("hi"))).scalar()
    days = F.sequence(F.coalesce(F.to_date("lo"), begin), F.to_date("hi"), F.expr("interval 1 day"))
    per_day = windows.where("hi IS NOT NULL").select(
        F.col("endpoint_name").alias("__ep"), "run_id", "lo", "hi", F.explode(days).alias("__day")
    )
    ts = F.col("request_timestamp")
    dated = predictions.withColumn("__at", F.greatest(F.to_date(ts), begin))
    match = (
        (F.col("endpoint_name") == F.col("__ep"))
        & (F.col("__at") == F.col("__day"))
        & (F.col("lo").isNull() | (ts > F.col("lo")))
        & (ts <= F.col("hi"))
    )
    joined = dated.join(per_day, match, "left")
    return joined.select(
        *[
            F.coalesce("monitoring_run_id", "run_id").alias(c) if c == "monitoring_run_id" else F.col(c)
            for c in predictions.columns
        ]
    )


def runs_with_predictions(runs: DataFrame, tagged: DataFrame) -> DataFrame:
    """Every run with volume, mean score, labelled count and time span of its predictions.

    Predictions are reduced to one row per run before they meet the wide run rows.
    """
    keys = ["monitoring_run_id", "endpoint_name"]
    per_run = tagged.where(F.col("monitoring_run_id").isNotNull()).groupBy(*keys).agg(
        F.countDistinct("inference_id").alias("inference_count"),
        F.avg("probability_fraud").alias("avg_fraud_prob"),
        F.count("ground_truth").alias("gt_count"),
        F.min("request_timestamp").alias("window_start"),
        F.max("request_timestamp").alias("window_end"),
    )
    return join_on(runs, per_run, keys, "left").select(
        *RUN_COLUMNS,
        "endpoint_name",
        F.coalesce("inference_count", F.lit(0)).alias("inference_count"),
        "avg_fraud_prob",
        F.coalesce("gt_count", F.lit(0)).alias("gt_count"),
        "window_start",
        "window_end",
    )


def feature_drift_detail(runs: DataFrame, significant: float = 2.5, moderate: float = 1.0) -> DataFrame:
    """One row per (run, feature) out of the JSON score map; values may be scalars or objects."""
    scores = F.col("per_feature_drift_scores")
    usable = runs.where(scores.isNotNull() & ~scores.isin("null", "{}"))
    exploded = usable.select(
        "monitoring_run_id", "monitoring_timestamp", "model_version", "model_package_arn", "evaluation_snapshot_id",
        "training_snapshot_id", "endpoint_name", "data_drift_detected", "drifted_columns_count",
        "drifted_columns_share", "baseline_roc_auc", "current_roc_auc",
        F.explode(F.from_json(scores, "map<string,string>")).alias("feature_name", "__v"),
    )
    v = F.col("__v")
    scalar = v.try_cast("double")
    field = lambda name: F.get_json_object(v, f"$.{name}")
    magnitude = F.coalesce(field("magnitude").try_cast("double"), scalar)
    return exploded.select(
        *[c for c in exploded.columns if c != "__v"],
        F.coalesce(scalar, field("score").try_cast("double")).alias("drift_score"),
        magnitude.alias("drift_magnitude"),
        field("method").alias("drift_method"),
        field("threshold").try_cast("double").alias("drift_threshold"),
    ).select(
        "*",
        feature_severity("drift_magnitude", significant, moderate).alias("drift_severity"),
        F.coalesce(F.col("drift_magnitude") > moderate, F.lit(False)).alias("drift_detected"),
    )


def trace_run(runs: DataFrame, tagged: DataFrame) -> DataFrame:
    """The predictions behind the latest run."""
    latest = runs.orderBy(F.desc("monitoring_timestamp"), F.desc("monitoring_run_id")).limit(1)
    one = F.broadcast(latest.select(F.col("monitoring_run_id").alias("__run"), F.col("endpoint_name").alias("__ep")))
    mine = (F.col("monitoring_run_id") == F.col("__run")) & F.col("endpoint_name").eqNullSafe(F.col("__ep"))
    return tagged.join(one, mine, "left_semi").select(
        "inference_id", "request_timestamp", "prediction", "probability_fraud", "ground_truth", "monitoring_run_id"
    )


def drift_by_importance(
    magnitudes: DataFrame, importance: DataFrame, top_share: float = 0.5, drifted_above: float = 1.0
) -> DataFrame:
    """Cross-reference of drift magnitude and model importance, with ranks and a verdict.

    Both inputs hold one row per feature, so the ranks are over a schema-sized table.
    """
    joined = magnitudes.select("feature", "drift_magnitude").join(importance.select("feature", "importance"), "feature")
    by = lambda c: F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(c), "feature"))
    ranked = joined.select(
        "*",
        by("drift_magnitude").alias("drift_rank"),
        by("importance").alias("importance_rank"),
        F.count("*").over(Window.partitionBy(F.lit(0))).alias("__n"),
    )
    important = F.col("importance_rank") <= F.ceil(F.col("__n") * top_share)
    drifted = F.col("drift_magnitude") > drifted_above
    verdict = (
        F.when(drifted & important, "high_risk")
        .when(drifted, "low_risk_noise")
        .when(important, "watch")
        .otherwise("stable")
    )
    return ranked.select("feature", "drift_magnitude", "importance", "drift_rank", "importance_rank", verdict.alias("verdict"))


def version_consistency(expected: DataFrame, predictions: DataFrame, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """Expected (endpoint, model_version, mlflow_run_id) against the dominant logged one.

    A version mismatch fails the endpoint; a run-id mismatch, an unknown id and no recent record are warnings.
    """
    counts = (
        spans.last(predictions, "request_timestamp", as_of, hours=hours)
        .groupBy("endpoint_name", "model_version", "mlflow_run_id")
        .agg(F.count("*").alias("n"))
    )
    observed = counts.groupBy("endpoint_name").agg(
        F.max_by(F.struct("model_version", "mlflow_run_id", "n"), F.struct("n", "model_version", "mlflow_run_id")).alias("o")
    )
    joined = expected.select(
        "endpoint_name", F.col("model_version").alias("expected_version"), F.col("mlflow_run_id").alias("expected_run_id")
    ).join(observed, "endpoint_name", "full_outer")
    seen, want = F.col("o.model_version"), F.col("expected_version")
    version = (
        F.when(F.col("o").isNull(), "WARNING")
        .when(want.isNull(), "WARNING")
        .when(seen.eqNullSafe(want), "PASS")
        .otherwise("FAIL")
    )
    run_seen, run_want = F.coalesce("o.mlflow_run_id", F.lit("unknown")), F.coalesce("expected_run_id", F.lit("unknown"))
    unknown = (run_seen == "unknown") | (run_want == "unknown")
    run = F.when(unknown, "WARNING").when(run_seen == run_want, "PASS").otherwise("WARNING")
    return joined.select(
        "endpoint_name",
        "expected_version",
        seen.alias("observed_version"),
        "expected_run_id",
        F.col("o.mlflow_run_id").alias("observed_run_id"),
        F.coalesce(F.col("o.n"), F.lit(0)).alias("observed_count"),
        version.alias("version_check"),
        run.alias("run_id_check"),
        F.when(version == "FAIL", "FAIL").otherwise("PASS").alias("status"),
    )


def accuracy_rows(predictions: DataFrame, updates: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    """Recent predictions joined with their confirmations: category, match flag, lag."""
    truth = F.col("actual_fraud").cast("int")
    labels = updates.where(F.col("actual_fraud").isNotNull()).select(
        "inference_id", "actual_fraud", "confirmation_timestamp", "days_since_prediction"
    )
    start = F.date_sub(F.lit(str(as_of)).cast("date"), days).cast("timestamp_ntz")
    return (
        spans.since(predictions, "request_timestamp", start)
        .join(labels, "inference_id")
        .select(
            F.to_date("request_timestamp").alias("inference_date"),
            "inference_id",
            "endpoint_name",
            "model_version",
            F.col("prediction").alias("predicted_fraud"),
            truth.alias("actual_fraud"),
            prediction_match("prediction", truth).alias("prediction_match"),
            prediction_category("prediction", truth).alias("prediction_category"),
            F.col("request_timestamp").alias("prediction_time"),
            F.col("confirmation_timestamp").alias("ground_truth_time"),
            "days_since_prediction",
            F.when(prediction_match("prediction", truth) == 1, "Correct").otherwise("Incorrect").alias("is_correct"),
        )
    )


def accuracy_percent(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("inference_id").alias("n"),
        (F.sum("prediction_match") / F.count("inference_id") * 100).alias("accuracy_pct"),
    )
