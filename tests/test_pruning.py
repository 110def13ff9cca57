"""Time windows over the log by day and endpoint list the folders they touch, and lose no row."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import labels, lineage, ops, sampling, windows
from tidewatch.plans import drift_check, performance_report
from tidewatch.sources import readers, writers
from tidewatch_checks import drift_queries
from tidewatch_checks.tables import AS_OF, PAYLOAD_SCHEMA, Tables

TS = "request_timestamp"


def scans(df) -> list[str]:
    """Partition filters of each scan of the partitioned log."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"PartitionFilters: \[(.*)\]", plan)


def files_read(df) -> int:
    return len({r[0] for r in df.select(F.input_file_name().alias("f")).distinct().collect()})


def drift_summary(t):
    return drift_check.data_drift_check(t.log, t.training, PAYLOAD_SCHEMA, drift_queries._encoders(t), AS_OF, 7, "ep-a")[0]


PLANS = {
    "p10": (drift_summary, 2),
    "e14": (lambda t: drift_check.model_drift_check(t.labelled_log, AS_OF, 14, "ep-a", 0.9), 1),
    "d12": (lambda t: ops.version_comparison(t.log, "ep-a", AS_OF, 7), 1),
    "a8": (lambda t: writers.time_slice(t.log, TS, "2024-01-10 00:00:00", "2024-01-12 00:00:00", ["inference_id"]), 1),
    "a1": (lambda t: readers.read_log(t.spark, t.by_day(t.pred, "log"), "2024-01-10 00:00:00", "2024-01-12 00:00:00"), 1),
    "e13": (lambda t: performance_report.performance_report(t.labelled_log, AS_OF, days=5).overall, 1),
    "c9": (lambda t: lineage.version_consistency(t.log.select("endpoint_name", "model_version", "mlflow_run_id").limit(1), t.log, AS_OF, 2), 1),
    "b18": (lambda t: lineage.accuracy_rows(t.log, t.known, AS_OF, 3), 1),
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_windows_prune_days(spark, sf_dir, name):
    build, least = PLANS[name]
    filters = [f for f in scans(build(Tables(spark, sf_dir))) if "request_date" in f]
    assert len(filters) >= least
    assert all(re.search(r"request_date#\d+ >= 2024-\d\d-\d\d", f) for f in filters), filters


def test_the_last_run_prunes_days(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = sampling.since_last_run(t.log, TS, t.runs, "ep-a", "2024-01-20 12:00:00")
    assert any("subquery" in f and "request_date" in f for f in scans(rows)), scans(rows)
    assert rows.count() == sampling.since_last_run(t.pred, TS, t.runs, "ep-a", "2024-01-20 12:00:00").count()
    assert files_read(rows) <= 2  # days 19 and 20 of one endpoint


def test_whole_days_and_borders(spark, tmp_path):
    stamps = ["2024-01-09 23:59:59.999999", "2024-01-10 00:00:00", "2024-01-10 12:00:00", "2024-01-11 23:59:59.999999", "2024-01-12 00:00:00", "2024-01-12 00:00:00.000001", None]
    rows = spark.createDataFrame([(s, "e") for s in stamps], "s string, endpoint_name string").select(
        F.col("s").cast("timestamp_ntz").alias(TS), "endpoint_name", F.to_date("s").alias("request_date"), F.col("s").alias("id")
    )
    path = str(tmp_path / "log")
    writers.write_table(rows, path, "append", ["request_date", "endpoint_name"])
    log = spark.read.parquet(path)

    def ids(df):
        return sorted(r["id"] for r in df.collect())

    assert ids(windows.half_open(log, TS, "2024-01-10", "2024-01-12")) == sorted(stamps[1:4])
    assert ids(windows.closed(log, TS, "2024-01-10", "2024-01-12")) == sorted(stamps[1:5])
    assert ids(windows.last(log, TS, "2024-01-12 00:00:00", days=2)) == sorted(stamps[2:5])
    assert ids(windows.since(log, TS, "2024-01-12")) == sorted(stamps[4:6])
    assert ids(windows.until(log, TS, "2024-01-10")) == sorted(stamps[:2])
    assert files_read(windows.half_open(log, TS, "2024-01-10", "2024-01-12")) == 2
    # The same rows from a table without the day.
    bare = log.drop("request_date")
    assert ids(windows.last(bare, TS, "2024-01-12 00:00:00", days=2)) == sorted(stamps[2:5])
    assert "request_date" not in "".join(scans(windows.last(bare, TS, "2024-01-12 00:00:00", days=2)))


def test_recent_updates_by_day(spark):
    rows = spark.createDataFrame([("a", "2024-01-30 01:00:00"), ("b", "2024-01-31 01:00:00")], "inference_id string, s string").select(
        "inference_id", F.col("s").cast("timestamp_ntz").alias("confirmation_timestamp"), F.to_date("s").alias("confirmation_date")
    )
    assert [r["inference_id"] for r in labels.recent_updates(rows, AS_OF).collect()] == ["a"]
    assert labels.recent_updates(rows, AS_OF, 5).count() == 0
