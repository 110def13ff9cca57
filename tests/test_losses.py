"""Nothing is lost: late messages, NULL partitions, filters that would cut partitions, staged copies."""

from __future__ import annotations

import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import stats
from tidewatch.operators import drift, kernel
from tidewatch.session import scratch_root
from tidewatch.sources import lake, writers
from tidewatch.streaming import ingest

DAY = datetime.date(2024, 1, 5)


def rows_of(spark, path):
    return spark.read.parquet(path).count()


def test_compaction_takes_partition_columns_only(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(100).withColumn("part", (F.col("id") % 4).cast("int"))
    df.write.partitionBy("part").parquet(path)
    with pytest.raises(ValueError, match="partition columns"):
        lake.compact(spark, path, ["part"], "id < 10")
    with pytest.raises(ValueError, match="as a whole"):
        lake.compact(spark, path, [], "id < 10")
    lake.compact(spark, path, ["part"], "part < 2")
    assert rows_of(spark, path) == 100
    assert os.listdir(tmp_path) == ["table"]  # no staged copy is left


def test_merge_reaches_null_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    base = [("a", "ep", DAY), ("b", None, DAY), ("c", "ep", None), ("d", None, None)]
    log = spark.createDataFrame([(i, e, d) for i, e, d in base], "inference_id string, endpoint_name string, request_date date")
    log = writers.conform_log(log.withColumn("request_timestamp", F.col("request_date").cast("timestamp_ntz"))).withColumn("request_date", F.to_date("request_timestamp"))
    log.write.partitionBy("request_date", "endpoint_name").parquet(path)
    schema = "inference_id string, actual_fraud boolean, confirmation_timestamp timestamp_ntz, confirmation_source string, days_since_prediction double, batch_id string"
    updates = spark.createDataFrame([(i, True, datetime.datetime(2024, 1, 9), "x", 1.0, "b") for i in "abcd"], schema)
    assert lake.merge_labels_into(spark, path, updates) == 4
    assert {r["inference_id"]: r["ground_truth"] for r in spark.read.parquet(path).collect()} == dict.fromkeys("abcd", 1)
    assert os.listdir(tmp_path) == ["log"]


def test_prediction_days_prune_the_merge(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame([(str(i), "ep", datetime.datetime(2024, 1, 1 + i)) for i in range(5)], "inference_id string, endpoint_name string, request_timestamp timestamp_ntz")
    writers.conform_log(log).withColumn("request_date", F.to_date("request_timestamp")).write.partitionBy("request_date", "endpoint_name").parquet(path)
    schema = "inference_id string, actual_fraud boolean, confirmation_timestamp timestamp_ntz, confirmation_source string, days_since_prediction double, batch_id string, prediction_timestamp timestamp_ntz"
    late = datetime.datetime(2024, 1, 9)
    updates = spark.createDataFrame([("1", True, late, "x", 1.0, "b", datetime.datetime(2024, 1, 2)), ("3", False, late, "x", 1.0, "b", datetime.datetime(2024, 1, 4))], schema)
    assert lake.merge_labels_into(spark, path, updates) == 2


def test_late_and_repeated_messages_are_stored_once(spark, tmp_path):
    out = str(tmp_path / "out")
    new = lambda ids, day: spark.createDataFrame([(i, day, "v") for i in ids], "id string, day date, v string")
    ingest.append_new(new(["a", "b", "b", None], DAY), out, "id", ["day"], "batch 1")
    ingest.append_new(new(["c", "c"], DAY - datetime.timedelta(days=40)), out, "id", ["day"], "batch 2")
    ingest.append_new(new(["b", "d"], DAY), out, "id", ["day"], "batch 3")
    ingest.append_new(new(["e", "e"], None), out, "id", ["day"], "batch 4")
    ingest.append_new(new(["e"], None), out, "id", ["day"], "batch 5")
    ingest.append_new(new([], DAY), out, "id", ["day"], "batch 6")
    assert sorted(str(r["id"]) for r in spark.read.parquet(out).collect()) == ["None", "a", "b", "c", "d", "e"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "app"

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_root(Session)


def test_chi_square_tail_of_many_degrees(spark):
    cases = [(1e6, 1_000_000, 0.49981), (999_000.0, 1_000_000, 0.76022), (1_100.0, 1_001, 0.01542), (0.0, 5_000, 1.0)]
    df = spark.createDataFrame([(x, d) for x, d, _ in cases], "x double, d long")
    got = [r[0] for r in df.select(stats.chi_square_sf(F.col("x"), F.col("d"))).collect()]
    assert np.allclose(got, [p for *_, p in cases], atol=2e-4)
    # The two forms meet where one takes over.
    near = spark.createDataFrame([(1_040.0, 1_000), (1_041.0, 1_001)], "x double, d long")
    a, b = (r[0] for r in near.select(stats.chi_square_sf(F.col("x"), F.col("d"))).collect())
    assert abs(a - b) < 1e-3


def test_infinity_does_not_stop_a_check(spark):
    values = [(float(v), i % 2) for i, v in enumerate([1, 2, 3, 4, 5, 6, "inf", "-inf", "inf"])]
    sides = spark.createDataFrame(values, "value double, is_current int").withColumn("feature", F.lit("f"))
    row = drift.numeric_distances(sides).first()
    assert row["n_baseline"] + row["n_current"] == 9 and row["wasserstein"] is None
    assert drift.psi(sides, 3).count() == 1
    quantiles = kernel.exact_quantiles(sides, ["feature"], "value", [0.0, 0.5, 1.0]).first()["quantiles"]
    assert quantiles[0] == float("-inf") and quantiles[2] == float("inf") and quantiles[1] == 4.0
