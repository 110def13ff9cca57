"""The id locator: what a batch reads, replays after a failure, and merges that find their days."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import lake, writers
from tidewatch.streaming import ingest, locator

DAY = datetime.date(2024, 1, 5)


def rows(spark, ids, day=DAY):
    return spark.createDataFrame([(i, day, 1) for i in ids], "id string, day date, v int")


def stored(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def test_a_batch_reads_its_own_buckets_and_ids(spark, tmp_path):
    path = str(tmp_path / "t-ids")
    every = spark.range(20_000).select(F.concat(F.lit("id-"), "id").alias("id"), F.lit(DAY).alias("day"))
    locator.add(path, every, "id", ["day"], "b", buckets=64)
    few = rows(spark, ["id-5", "id-6", "new"])
    held = locator.known(spark, path, few, "id", buckets=64)
    plan = spark._jvm.PythonSQLUtils.explainString(held._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ IN \(|PartitionFilters: \[.*bucket#\d+ = ", plan) and "In(id" in plan
    assert len(held.inputFiles()) == 64 and held.select(F.input_file_name()).distinct().count() <= 2
    assert sorted(r["id"] for r in held.collect()) == ["id-5", "id-6"]
    assert locator.partitions_of(spark, path, few, "id", "day", buckets=64) == [DAY]


def test_more_ids_than_are_named(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(locator, "NAMED_IDS", 2)
    path = str(tmp_path / "t-ids")
    locator.add(path, rows(spark, [f"x{i}" for i in range(100)]), "id", ["day"], "b")
    held = locator.known(spark, path, rows(spark, ["x1", "x2", "x3", "y", None]), "id")
    assert sorted(r["id"] for r in held.collect()) == ["x1", "x2", "x3"]


@pytest.mark.parametrize("left", ["nothing", "ids", "rows"])
def test_replays_add_nothing_twice_and_lose_nothing(spark, tmp_path, left):
    path = str(tmp_path / "t")
    ingest.append_new(rows(spark, ["a", "b"]), path, "id", ["day"], "s#0")
    batch = rows(spark, ["b", "c", "d", None])
    if left == "ids":  # the first try ended between locator and rows
        locator.add(f"{path}-ids", rows(spark, ["c", "d"]), "id", ["day"], "s#1")
    if left == "rows":  # it ended after the rows, before the stream noted the batch
        ingest.append_new(batch, path, "id", ["day"], "s#1")
    ingest.append_new(batch, path, "id", ["day"], "s#1")
    found = [r["id"] for r in spark.read.parquet(path).collect()]
    assert sorted(i for i in found if i) == ["a", "b", "c", "d"] and found.count(None) == 1
    ingest.append_new(rows(spark, ["d", "e"], DAY - datetime.timedelta(days=90)), path, "id", ["day"], "s#2")
    assert sorted(i["id"] for i in spark.read.parquet(path).where("id is not null").collect()) == ["a", "b", "c", "d", "e"]


def test_a_table_without_locator_gets_one(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, ["a", "b"]).write.partitionBy("day").parquet(path)
    ingest.append_new(rows(spark, ["b", "c"]), path, "id", ["day"], "s#0")
    assert stored(spark, path) == ["a", "b", "c"]


def test_merges_search_the_days_of_their_ids(spark, tmp_path):
    log, ids = str(tmp_path / "log"), str(tmp_path / "log-ids")
    base = spark.createDataFrame([(f"p{i}", f"2024-01-{i + 1:02d} 10:00:00") for i in range(20)], "inference_id string, s string")
    full = writers.conform_log(base.withColumn("request_timestamp", F.col("s").cast("timestamp_ntz")).withColumn("endpoint_name", F.lit("e")))
    writers.write_table(full.withColumn("request_date", F.to_date("request_timestamp")), log, "append", ["request_date", "endpoint_name"])
    locator.build(spark, log, ids, "inference_id", ["request_date", "endpoint_name"])
    updates = spark.createDataFrame(
        [("p3", True, "c", 1.0, "b", "2024-02-01 00:00:00"), ("nobody", True, "c", 1.0, "b", "2024-02-01 00:00:00")],
        "inference_id string, actual_fraud boolean, confirmation_source string, days_since_prediction double, batch_id string, s string",
    ).withColumn("confirmation_timestamp", F.col("s").cast("timestamp_ntz")).drop("s")
    asked = []

    def days_of(found):
        asked.append(locator.partitions_of(spark, ids, found, "inference_id", "request_date"))
        return asked[-1]

    assert lake.merge_labels_into(spark, log, updates, days_of=days_of) == 1
    assert asked == [[datetime.date(2024, 1, 4)]]
    assert [r["inference_id"] for r in spark.read.parquet(log).where("ground_truth = 1").collect()] == ["p3"]
    assert lake.merge_labels_into(spark, log, updates.where("inference_id = 'nobody'"), days_of=days_of) == 0 and asked[-1] == []
