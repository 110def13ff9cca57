"""One verdict row per monitoring run, and the alert and metric rows derived from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import as_of_literal, run_severity
from tidewatch.functions.stats import safe_ratio
from tidewatch.operators.kernel import join_on

_D, _S, _I, _B, _TS = T.DoubleType(), T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()

# The stored verdict columns in order.
VERDICT_SCHEMA = T.StructType(
    [
        T.StructField(n, t)
        for n, t in (
            ("monitoring_run_id", _S), ("monitoring_timestamp", _TS), ("endpoint_name", _S), ("model_version", _S),
            ("model_package_arn", _S), ("evaluation_snapshot_id", _S), ("training_snapshot_id", _S),
            ("data_drift_detected", _B), ("drifted_columns_count", _I), ("drifted_columns_share", _D),
            ("features_analyzed", _I), ("data_sample_size", _I), ("model_drift_detected", _B),
            ("baseline_roc_auc", _D), ("current_roc_auc", _D), ("roc_auc_degradation", _D),
            ("roc_auc_degradation_pct", _D), ("accuracy", _D), ("precision", _D), ("recall", _D), ("f1_score", _D),
            ("model_sample_size", _I), ("per_feature_drift_scores", _S), ("evidently_report_s3_path", _S),
            ("mlflow_run_id", _S), ("alert_sent", _B), ("detection_engine", _S), ("created_at", _TS),
        )
    ]
)
DETECTION_ENGINE = "spark"


def conform_verdicts(df: DataFrame) -> DataFrame:
    """Cast to the verdict layout; columns the frame lacks become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in VERDICT_SCHEMA.fields
        ]
    )


def scores_json(verdicts: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Per-feature results as one JSON object per group, features in name order."""
    entry = F.struct(
        F.col("feature").alias("key"),
        F.struct(
            F.col("drift_score").alias("score"),
            F.col("drift_magnitude").alias("magnitude"),
            "method",
            "threshold",
        ).alias("value"),
    )
    # One entry per feature column: bounded by the schema.
    packed = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))))
    return verdicts.groupBy(*(groups or [])).agg(packed.alias("per_feature_drift_scores"))


def degradation(baseline: Column, current: Column, limit_pct: float = 5.0) -> list[Column]:
    """Columns roc_auc_degradation, roc_auc_degradation_pct, model_drift_detected."""
    diff = baseline - current
    pct = safe_ratio(diff, baseline, None) * 100
    return [
        diff.alias("roc_auc_degradation"),
        pct.alias("roc_auc_degradation_pct"),
        F.coalesce(pct >= limit_pct, F.lit(False)).alias("model_drift_detected"),
    ]


def run_id(as_of: datetime | str, endpoint: str) -> str:
    """Id of a run: endpoints that are checked at the same time have runs of their own."""
    stamp = str(as_of)
    digits = "".join(ch for ch in stamp if ch.isdigit())[:14].ljust(14, "0")
    return f"drift-{digits[:8]}-{digits[8:]}-{endpoint}"


def verdict_row(
    data: DataFrame | None,
    scores: DataFrame | None,
    model: DataFrame | None,
    spark,
    as_of: datetime | str,
    endpoint: str,
    model_version: str,
    lineage: dict[str, str | None] | None = None,
) -> DataFrame:
    """Assemble the 28-column row from the one-row results of the data and model checks.

    Either check may be missing (too few samples); its columns are then NULL and not detected.
    """
    fixed = {
        "monitoring_run_id": run_id(as_of, endpoint),
        "endpoint_name": endpoint,
        "model_version": model_version,
        "detection_engine": DETECTION_ENGINE,
        **(lineage or {}),
    }
    row = spark.range(1).select(
        *[F.lit(v).cast("string").alias(k) for k, v in fixed.items()],
        as_of_literal(as_of).alias("monitoring_timestamp"),
        as_of_literal(as_of).alias("created_at"),
    )
    for part in (data, scores, model):
        if part is not None:
            row = row.join(F.broadcast(part), how="left")
    for flag in ("data_drift_detected", "model_drift_detected"):
        found = F.coalesce(F.col(flag), F.lit(False)) if flag in row.columns else F.lit(False)
        row = row.withColumn(flag, found)
    return conform_verdicts(row.withColumn("alert_sent", F.col("data_drift_detected") | F.col("model_drift_detected")))


# -- alerts ---------------------------------------------------------------------------------------

# Texts of the alert payload.
ACTION_DATA = "Investigate data pipeline or consider model retraining"
ACTION_MODEL = "Compare with the registered baseline and consider retraining"


def alerts(runs: DataFrame, details: DataFrame, top: int = 5) -> DataFrame:
    """One row per (run, kind of drift) with its columns and, for receivers, all of them as a JSON payload; no drift, no alert."""
    drifted = details.where("drift_detected")
    best = F.slice(
        F.sort_array(
            F.collect_list(F.struct((-F.col("drift_magnitude")).alias("o"), F.col("feature_name").alias("feature"), F.col("drift_score").alias("score")))
        ),
        1,
        top,
    )
    # One entry per feature of a run: bounded by the schema.
    features = drifted.groupBy("monitoring_run_id", "endpoint_name").agg(
        F.transform(best, lambda s: F.struct(s["feature"].alias("feature"), s["score"].alias("score"))).alias("top_features")
    )
    hit = join_on(runs.where(F.col("data_drift_detected") | F.col("model_drift_detected")), features, ["monitoring_run_id", "endpoint_name"], "left")
    kinds = F.explode(
        F.array_compact(
            F.array(
                F.when(F.col("data_drift_detected"), "DATA_DRIFT_DETECTED"),
                F.when(F.col("model_drift_detected"), "MODEL_DRIFT_DETECTED"),
            )
        )
    )
    rows = hit.select("*", kinds.alias("alert_type"))
    stamp = F.date_format("monitoring_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    is_data = F.col("alert_type") == "DATA_DRIFT_DETECTED"
    message = F.when(
        is_data,
        F.format_string(
            "Data drift: %d of %d features drifted (share %.3f)",
            "drifted_columns_count", "features_analyzed", "drifted_columns_share",
        ),
    ).otherwise(
        F.format_string(
            "Model drift: ROC-AUC %.4f against baseline %.4f (degradation %.1f%%)",
            "current_roc_auc", "baseline_roc_auc", "roc_auc_degradation_pct",
        )
    )
    severity = F.when(is_data, run_severity("drifted_columns_share")).otherwise("HIGH")
    action = F.when(is_data, ACTION_DATA).otherwise(ACTION_MODEL)
    payload = F.struct(
        "alert_type", severity.alias("severity"), "endpoint_name", "monitoring_run_id", stamp.alias("check_timestamp"),
        F.col("drifted_columns_share").alias("drift_share"), F.col("top_features").alias("drifted_features"),
        message.alias("message"), action.alias("recommended_action"),
    )
    return rows.select(
        "monitoring_run_id",
        F.col("monitoring_timestamp").alias("check_timestamp"),
        "endpoint_name",
        "alert_type",
        severity.alias("severity"),
        F.col("drifted_columns_share").alias("drift_share"),
        F.when(is_data, F.transform("top_features", lambda s: s["feature"])).alias("drifted_features"),
        message.alias("message"),
        action.alias("recommended_action"),
        F.to_json(payload).alias("payload"),
    )


RUN_METRICS = (
    "data_drift_detected", "features_analyzed", "drifted_columns_count", "drifted_columns_share", "data_sample_size",
    "model_drift_detected", "baseline_roc_auc", "current_roc_auc", "roc_auc_degradation", "roc_auc_degradation_pct",
    "accuracy", "precision", "recall", "f1_score", "model_sample_size",
)


def safe_metric_name(name: Column) -> Column:
    """Lower-case name of the characters that metric stores take: letters, digits, ``_``, ``-``, ``.``, ``/``.

    What stands in parentheses at the end is left out; words are joined by underscores.
    """
    words = F.split(F.lower(F.substring_index(name, "(", 1)), r"[\s:]+")
    clean = F.transform(words, lambda w: F.regexp_replace(w, "[^a-z0-9_./-]", ""))
    return F.array_join(F.filter(clean, lambda w: w != ""), "_")


def run_metrics(runs: DataFrame, details: DataFrame) -> DataFrame:
    """(monitoring_run_id, metric, value): run-level numbers and one score per feature."""
    entries = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("int").cast("double").alias("value"))
               if c.endswith("_detected") else F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
               for c in RUN_METRICS]
    flat = runs.select("monitoring_run_id", F.inline(F.array(*entries)))
    scored = details.select(
        "monitoring_run_id",
        safe_metric_name(F.concat(F.lit("drift_score_"), "feature_name")).alias("metric"),
        F.col("drift_score").alias("value"),
    )
    return flat.unionByName(scored).where("value is not null")
