"""Streaming ingest of prediction and verdict messages."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.verdict import VERDICT_SCHEMA
from tidewatch.sources.lake import path_exists
from tidewatch.sources.writers import LOG_SCHEMA
from tidewatch.streaming import locator

MICRO_BATCH = "30 seconds"


def message_files(spark: SparkSession, path: str, max_files: int = 10) -> DataFrame:
    """Messages (column ``value``) arriving as text files, one JSON object per line."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def message_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int = 100_000) -> DataFrame:
    """Messages from a Kafka topic (needs the Kafka connector on the classpath)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns plus ``value`` and ``malformed``; missing keys are typed NULLs."""
    permissive = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = messages.select(
        "value",
        F.from_json("value", permissive, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("m"),
    )
    malformed = F.col("m").isNull() | F.col("m._bad").isNotNull()
    return parsed.select("value", malformed.alias("malformed"), *[F.col(f"m.{f.name}").alias(f.name) for f in schema.fields])


def split_messages(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows, malformed texts)."""
    good = parsed.where(~F.col("malformed")).drop("value", "malformed")
    return good, parsed.where("malformed").select("value")


def prediction_messages(messages: DataFrame) -> DataFrame:
    good, _ = split_messages(parse_messages(messages, LOG_SCHEMA))
    return good


def verdict_messages(messages: DataFrame) -> DataFrame:
    good, _ = split_messages(parse_messages(messages, VERDICT_SCHEMA))
    return good


def append_new(batch: DataFrame, path: str, key: str, partition_by: Sequence[str], name: str) -> None:
    """Append the rows of a micro-batch whose ``key`` is not stored yet; rows without a key are all kept.

    Stored ids are looked up in the table's locator (``<path>-ids``, see :mod:`tidewatch.streaming.locator`), so what is read follows
    the batch.  No row is too late.  ``name`` tells the batch from all others: a replay after a failure finds it in the locator and takes up
    what the first try left, so it adds nothing twice and loses nothing.  A table without a locator gets one first.
    """
    spark = batch.sparkSession
    ids_path = f"{path.rstrip('/')}-ids"
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        if path_exists(spark, path) and not path_exists(spark, ids_path):
            locator.build(spark, path, ids_path, key, partition_by)
        new = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        loose = batch.where(F.col(key).isNull())
        held = locator.known(spark, ids_path, new, key)
        replayed = held is not None and not held.where(F.col("batch") == name).isEmpty()
        if held is not None:
            new = new.join(held.where(F.col("batch") != name).select(F.col("id").alias(key)), key, "left_anti").select(batch.columns)
        if replayed:
            # Some of this batch may be stored: look into the days it went to. Its keyless rows were written with the others.
            if path_exists(spark, path):
                days = [r[0] for r in held.where(F.col("batch") == name).select(partition_by[0]).distinct().collect()]
                stored = spark.read.schema(batch.schema).parquet(path).where(F.col(partition_by[0]).isin(days) | F.col(partition_by[0]).isNull())
                here = stored.select(key).join(new.select(key), key, "left_semi")
                new = new.join(here, key, "left_anti").select(batch.columns)
                if not here.isEmpty():
                    loose = loose.limit(0)
        else:
            new = new.persist()
            locator.add(ids_path, new, key, partition_by, name)
        new.unionByName(loose).write.mode("append").partitionBy(*partition_by).parquet(path)
        new.unpersist()
    finally:
        batch.unpersist()


def start_once_sink(
    rows: DataFrame, path: str, checkpoint: str, key: str, partition_by: Sequence[str], once: bool = False, interval: str = MICRO_BATCH
) -> StreamingQuery:
    """Append to parquet, each ``key`` once, although delivery is at least once (see :func:`append_new`)."""
    writer = rows.writeStream.foreachBatch(lambda batch, number: append_new(batch, path, key, partition_by, f"{checkpoint}#{number}"))
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    once: bool = False,
    interval: str = MICRO_BATCH,
) -> StreamingQuery:
    """Append to parquet; ``once`` drains what is available and stops."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def ingest_predictions(messages: DataFrame, path: str, bad_path: str, checkpoint: str, once: bool = False) -> list[StreamingQuery]:
    """Typed log rows by date and endpoint, each once and however late; malformed messages go to a side table."""
    good, bad = split_messages(parse_messages(messages, LOG_SCHEMA))
    dated = good.withColumn("request_date", F.to_date("request_timestamp"))
    return [
        start_once_sink(dated, path, f"{checkpoint}/rows", "inference_id", ("request_date", "endpoint_name"), once),
        start_sink(bad, bad_path, f"{checkpoint}/bad", (), once),
    ]


def ingest_verdicts(messages: DataFrame, path: str, bad_path: str, checkpoint: str, once: bool = False) -> list[StreamingQuery]:
    """Verdict rows by date, each run once although delivery is at least once; malformed messages go to a side table."""
    good, bad = split_messages(parse_messages(messages, VERDICT_SCHEMA))
    dated = good.withColumn("monitoring_date", F.to_date("monitoring_timestamp"))
    return [
        start_once_sink(dated, path, f"{checkpoint}/rows", "monitoring_run_id", ("monitoring_date",), once),
        start_sink(bad, bad_path, f"{checkpoint}/bad", (), once),
    ]


def _moved(query: StreamingQuery) -> tuple:
    """What changes while a query works: its micro-batch, and the tasks that are done in the stages running now."""
    tracker = SparkSession.active().sparkContext.statusTracker()
    stages = [tracker.getStageInfo(i) for i in tracker.getActiveStageIds()]
    return (query.lastProgress or {}).get("batchId"), sorted((s.stageId, s.numCompletedTasks) for s in stages if s)


def wait(queries: list[StreamingQuery], seconds: int = 300) -> None:
    """Wait for draining queries; raises their error, or stops them and raises when nothing has moved for ``seconds``."""
    for query in queries:
        seen, since = None, time.monotonic()
        while not query.awaitTermination(min(seconds, 5)):
            if (now := _moved(query)) != seen:
                seen, since = now, time.monotonic()
            elif time.monotonic() - since >= seconds:
                for q in queries:
                    q.stop()
                raise TimeoutError(f"streaming query {query.name or query.id} has not moved for {seconds} s")
