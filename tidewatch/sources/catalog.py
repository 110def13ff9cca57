"""Table definitions from the schema config, and catalog inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import FeatureSchema, spark_type
from tidewatch.operators.verdict import VERDICT_SCHEMA
from tidewatch.sources.writers import LOG_SCHEMA


def _fields(*pairs: tuple[str, str]) -> list[T.StructField]:
    return [T.StructField(n, spark_type(t)) for n, t in pairs]


def table_definitions(schema: FeatureSchema) -> dict[str, tuple[T.StructType, list[str]]]:
    """Name -> (columns, partition columns) of the seven tables.

    Day partitioning uses a derived date column, since parquet has no hidden partition transform.
    """
    features = [T.StructField(n, spark_type(t)) for n, t in schema.features]
    aux = [T.StructField(n, spark_type(t)) for n, t in schema.auxiliary]
    ident = _fields((schema.identifier, "string"))
    target = _fields((schema.target, schema.target_type))
    stamps = _fields(("data_version", "string"), ("created_at", "timestamp"), ("updated_at", "timestamp"))
    day = lambda name: [T.StructField(name, T.DateType())]
    labelled = T.StructType(ident + features + aux + target + stamps)
    log = list(LOG_SCHEMA.fields)
    return {
        "training_data": (labelled, []),
        "evaluation_data": (labelled, []),
        "ground_truth": (
            T.StructType(
                ident + _fields(("prediction_timestamp", "timestamp"), ("window_id", "int")) + features
                + _fields(
                    ("ground_truth_fraud", "boolean"), ("observed_fraud", "boolean"), ("fraud_probability", "double"),
                    ("data_source", "string"), ("ingestion_timestamp", "timestamp"), ("batch_id", "string"),
                )
                + day("prediction_date")
            ),
            ["prediction_date"],
        ),
        "inference_responses": (
            # Column order: partition columns come last in a file table.
            T.StructType([f for f in log if f.name != "endpoint_name"] + day("request_date") + _fields(("endpoint_name", "string"))),
            ["request_date", "endpoint_name"],
        ),
        "drifted_data": (T.StructType(ident + features + target), []),
        "ground_truth_updates": (
            T.StructType(
                ident
                + _fields(
                    ("inference_id", "string"), ("actual_fraud", "boolean"), ("confirmation_timestamp", "timestamp"),
                    ("confirmation_source", "string"), ("transaction_timestamp", "timestamp"),
                    ("prediction_timestamp", "timestamp"), ("days_since_transaction", "double"),
                    ("days_since_prediction", "double"), ("investigation_notes", "string"),
                    ("investigation_priority", "string"), ("false_positive", "boolean"), ("false_negative", "boolean"),
                    ("window_id", "int"), ("batch_id", "string"), ("created_at", "timestamp"), ("updated_at", "timestamp"),
                )
                + day("confirmation_date")
            ),
            ["confirmation_date"],
        ),
        "monitoring_responses": (T.StructType(list(VERDICT_SCHEMA.fields) + day("monitoring_date")), ["monitoring_date"]),
    }


def create_table_sql(database: str, name: str, columns: T.StructType, partitions: list[str], location: str | None = None) -> str:
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {database}.{name} ({body}) USING parquet"
    if partitions:
        sql += f" PARTITIONED BY ({', '.join(partitions)})"
    if location:
        sql += f" LOCATION '{location.rstrip('/')}/{name}'"
    return sql


def create_all_tables(spark: SparkSession, database: str, schema: FeatureSchema, location: str | None = None, recreate: bool = False) -> list[str]:
    """Create the database and its seven tables (no-op for those that exist)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name, (columns, partitions) in table_definitions(schema).items():
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(create_table_sql(database, name, columns, partitions, location))
        made.append(name)
    return made


def drop_all_tables(spark: SparkSession, database: str, schema: FeatureSchema) -> None:
    for name in table_definitions(schema):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """(column, type, is_partition)."""
    rows = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "column string, type string, is_partition boolean")


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("table"), F.count("*").alias("n"))


def table_stats(df: DataFrame, name: str, ts: str | None = None) -> DataFrame:
    """(table, n, n_columns, first, last)."""
    stamp = F.col(ts) if ts else F.lit(None)
    return df.agg(
        F.lit(name).alias("table"),
        F.count("*").alias("n"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(stamp.cast("timestamp_ntz")).alias("first"),
        F.max(stamp.cast("timestamp_ntz")).alias("last"),
    )


def verify_tables(spark: SparkSession, database: str, schema: FeatureSchema) -> DataFrame:
    """(table, present, n): row counts of the tables that exist."""
    parts = None
    for name in table_definitions(schema):
        full = f"{database}.{name}"
        if table_exists(spark, full):
            part = row_count(spark.table(full), name).select("table", F.lit(True).alias("present"), "n")
        else:
            part = spark.range(1).select(F.lit(name).alias("table"), F.lit(False).alias("present"), F.lit(0).cast("bigint").alias("n"))
        parts = part if parts is None else parts.unionByName(part)
    return parts
