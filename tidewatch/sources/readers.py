"""Reading tables, staged text and scoring output."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import FeatureSchema
from tidewatch.operators import windows


def read_table(
    spark: SparkSession, table: str, columns: Sequence[str] | None = None, where: str | None = None, limit: int | None = None
) -> DataFrame:
    """A catalog table, or a parquet path, with projection, predicate and optional limit."""
    df = spark.read.parquet(table) if "/" in table else spark.table(table)
    if where:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def read_log(
    spark: SparkSession,
    table: str,
    start: datetime | str,
    end: datetime | str,
    endpoint: str | None = None,
    columns: Sequence[str] | None = None,
    ts: str = "request_timestamp",
) -> DataFrame:
    """Rows of ``[start, end)`` of a table by day: only the folders of those days (and of the endpoint) are listed and read."""
    rows = windows.half_open(read_table(spark, table), ts, start, end, endpoint)
    return rows.select(*columns) if columns else rows


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """CSV with a declared schema; types are inferred (an extra pass) only when none is given."""
    reader = spark.read.option("header", header)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_csv_staging(spark: SparkSession, path: str, schema: FeatureSchema) -> DataFrame:
    """All columns as text, bound by position; the header line is skipped."""
    return (
        spark.read.schema(schema.string_struct()).option("header", True).option("enforceSchema", True)
        .option("mode", "PERMISSIVE").csv(path)
    )


RESPONSE_SCHEMA = (
    "row_key string, predictions array<int>, "
    "probabilities struct<non_fraud: array<double>, fraud: array<double>>, "
    "metadata struct<model_version: string, mlflow_run_id: string, endpoint_name: string>"
)


def read_responses(spark: SparkSession, *paths: str) -> DataFrame:
    """Scoring responses (JSON lines, one scored row each) of any number of result files."""
    raw = spark.read.schema(RESPONSE_SCHEMA).json(list(paths))
    return raw.select(
        "row_key",
        F.element_at("predictions", 1).alias("prediction"),
        F.element_at("probabilities.fraud", 1).alias("probability_fraud"),
        F.element_at("probabilities.non_fraud", 1).alias("probability_non_fraud"),
        F.col("metadata.model_version").alias("model_version"),
        F.col("metadata.mlflow_run_id").alias("mlflow_run_id"),
        F.col("metadata.endpoint_name").alias("endpoint_name"),
    )


def attach_responses(inputs: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """Inputs with their predictions, by key: files and rows have no position in a distributed table."""
    return inputs.join(responses.withColumnRenamed("row_key", key), key)


def response_mismatch(inputs: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """One row: rows without response and responses without row."""
    keyed = inputs.select(F.col(key).cast("string").alias("row_key"), F.lit(1).alias("i"))
    joined = keyed.join(responses.select("row_key", F.lit(1).alias("r")), "row_key", "full_outer")
    return joined.agg(
        F.count_if(F.col("r").isNull()).alias("inputs_without_response"),
        F.count_if(F.col("i").isNull()).alias("responses_without_input"),
    )
