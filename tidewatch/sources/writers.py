"""Writing training files, exports, log rows and verdict rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import spark_type
from tidewatch.operators import windows
from tidewatch.operators.prep import NON_FEATURES, training_projection
from tidewatch.operators.verdict import conform_verdicts

FORMATS = ("parquet", "csv", "json")


def write_training_csv(df: DataFrame, path: str, target: str, single_file: bool = False) -> list[str]:
    """Label-first numeric CSV without header; returns the feature order.

    One file per task by default; ``single_file`` funnels everything through one task and is meant
    for small tables only.
    """
    rows = training_projection(df, target)
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("header", False).csv(path)
    return rows.columns[1:]


def write_feature_metadata(spark: SparkSession, path: str, target: str, features: Sequence[str]) -> None:
    """Sidecar with target, names, count and order."""
    row = spark.range(1).select(
        F.lit(target).alias("target_column"),
        F.array(*map(F.lit, features)).alias("feature_names"),
        F.lit(len(features)).alias("num_features"),
        F.array(*map(F.lit, [target, *features])).alias("column_order"),
    )
    row.write.mode("overwrite").json(path)


def require_rows(df: DataFrame, what: str) -> None:
    """Raise when there is nothing to write (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")


def scoring_rows(df: DataFrame, target: str, drop: Sequence[str] = NON_FEATURES) -> DataFrame:
    """Features only: label, id and metadata columns that exist are dropped."""
    present = [c for c in df.columns if c == target or c in set(drop)]
    return df.drop(*present)


def export_for_scoring(df: DataFrame, path: str, target: str, drop: Sequence[str] = NON_FEATURES) -> None:
    """JSON lines for batch scoring."""
    require_rows(df, "scoring export")
    scoring_rows(df, target, drop).write.mode("overwrite").json(path)


def export(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {', '.join(FORMATS)}")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def time_slice(
    df: DataFrame, ts: str, start: datetime | str, end: datetime | str, columns: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Feature columns of ``[start, end)``, oldest first when a row limit is given."""
    rows = windows.half_open(df, ts, start, end)
    if limit is not None:
        rows = rows.orderBy(ts, *columns).limit(limit)
    return rows.select(*columns)


def export_slice(
    df: DataFrame, ts: str, start: datetime | str, end: datetime | str, columns: Sequence[str], path: str, limit: int | None = None
) -> None:
    """The slice as comma text without a header, as batch scoring reads it."""
    time_slice(df, ts, start, end, columns, limit).write.mode("overwrite").csv(path, header=False)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Append, or overwrite the partitions present in ``df`` (all rows when unpartitioned).

    Rows are clustered by partition value first, so a task writes to few directories.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported mode {mode!r}")
    rows = df
    writer = rows.write.mode(mode)
    if partition_by:
        # A rebalance, not a repartition: a partition value with very many rows is split over tasks.
        rows = df.hint("rebalance", *partition_by)
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


# Prediction log columns in order, with their types.
LOG_COLUMNS = (
    ("inference_id", "string"), ("request_timestamp", "timestamp_ntz"), ("endpoint_name", "string"),
    ("model_version", "string"), ("mlflow_run_id", "string"), ("input_features", "string"), ("prediction", "int"),
    ("probability_fraud", "double"), ("probability_non_fraud", "double"), ("confidence_score", "double"),
    ("ground_truth", "int"), ("ground_truth_timestamp", "timestamp_ntz"), ("ground_truth_source", "string"),
    ("days_to_ground_truth", "double"), ("inference_latency_ms", "double"), ("model_load_time_ms", "double"),
    ("preprocessing_time_ms", "double"), ("transaction_id", "string"), ("transaction_amount", "double"),
    ("customer_id", "string"), ("is_high_confidence", "boolean"), ("is_low_confidence", "boolean"),
    ("prediction_bucket", "string"), ("request_id", "string"), ("response_time", "timestamp_ntz"),
    ("error_message", "string"), ("inference_mode", "string"), ("monitoring_run_id", "string"),
)
LOG_SCHEMA = T.StructType([T.StructField(n, spark_type(t)) for n, t in LOG_COLUMNS])


def conform_log(df: DataFrame) -> DataFrame:
    """Cast to the prediction log layout; missing columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in LOG_COLUMNS])


def batch_log_rows(
    scored: DataFrame,
    features: Sequence[str],
    endpoint: str,
    model_version: str,
    run_id: str,
    scored_at: datetime | str,
    key: str,
) -> DataFrame:
    """Scored rows as prediction log rows of a batch run (endpoint suffixed ``-batch``).

    Ids are hashes of ``key``, so a retried task writes the same ids.
    """
    stamp = F.lit(str(scored_at)).cast("timestamp_ntz")
    identity = F.md5(F.concat_ws("|", F.lit(endpoint), F.lit(str(scored_at)), F.col(key).cast("string")))
    rows = scored.withColumns(
        {
            "inference_id": identity,
            "request_timestamp": stamp,
            "response_time": stamp,
            "endpoint_name": F.lit(f"{endpoint}-batch"),
            "model_version": F.lit(model_version),
            "mlflow_run_id": F.lit(run_id),
            "input_features": F.to_json(F.struct(*features)),
            "inference_mode": F.lit("batch"),
        }
    )
    return conform_log(rows)


def append_verdict(verdict: DataFrame, path: str) -> None:
    """Append verdict rows in the one declared column order, partitioned by day."""
    rows = conform_verdicts(verdict).withColumn("monitoring_date", F.to_date("monitoring_timestamp"))
    rows.write.mode("append").partitionBy("monitoring_date").parquet(path)
