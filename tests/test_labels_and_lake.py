"""Label merge rules, run tags, per-feature score maps, snapshots and partition rewrites."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.operators import baselines, labels, lineage, ops, verdict
from tidewatch.session import scratch_path
from tidewatch.sources import catalog, lake, writers
from tidewatch.sources.writers import conform_log

T0 = "2024-01-05 10:00:00"
UPDATES = "inference_id string, actual_fraud boolean, t string, confirmation_source string, days_since_prediction double, batch_id string"


def log(spark, rows):
    """rows: (inference_id, prediction, ground_truth)"""
    df = spark.createDataFrame(rows, "inference_id string, prediction int, ground_truth int")
    return conform_log(df.withColumn("request_timestamp", F.lit(T0).cast("timestamp_ntz")).withColumn("endpoint_name", F.lit("ep")))


def updates(spark, rows):
    return spark.createDataFrame(rows, UPDATES).withColumn("confirmation_timestamp", F.to_timestamp_ntz("t")).drop("t")


def feed(spark):
    return updates(
        spark,
        [
            ("a", True, "2024-01-07 00:00:00", "s", 2.0, "b1"), ("a", False, "2024-01-06 00:00:00", "s", 1.0, "b1"),
            ("b", True, "2024-01-06 00:00:00", "s", 1.0, "b1"), ("b", False, "2024-01-06 00:00:00", "s", 1.0, "b2"),
            ("c", True, "2024-01-06 00:00:00", "s", 1.0, "b1"), ("unknown", True, "2024-01-06 00:00:00", "s", 1.0, "b1"),
        ],
    )


def merged(df):
    return {r["inference_id"]: r["ground_truth"] for r in df.collect()}


def test_latest_confirmation_wins_and_ties_go_to_the_later_batch(spark):
    rows = log(spark, [("a", 1, None), ("b", 1, None), ("c", 0, 0), ("d", 1, None)])
    assert merged(labels.merge_labels(rows, feed(spark))) == {"a": 1, "b": 0, "c": 0, "d": None}
    assert merged(labels.merge_labels(rows, feed(spark), force=True))["c"] == 1


def test_window_limits_the_merge(spark):
    rows = log(spark, [("a", 1, None), ("b", 1, None)])
    got = labels.merge_labels(rows, feed(spark), as_of="2024-01-07 01:00:00", window_hours=2)
    assert merged(got) == {"a": 1, "b": None}
    assert merged(labels.merge_labels(rows, feed(spark), as_of="2024-01-06 12:00:00")) == {"a": 0, "b": 0}


def test_both_forms_of_latest_agree(spark):
    assert sorted(labels.latest_labels(feed(spark)).collect()) == sorted(labels.latest_labels_ranked(feed(spark)).collect())


def test_counts(spark):
    rows = log(spark, [("a", 1, None), ("b", 1, None), ("c", 0, 0)])
    assert labels.pending_count(rows, feed(spark)).first()[0] == 2
    s = labels.update_statistics(rows, feed(spark)).first()
    assert s["total_updates"] == 4 and s["distinct_predictions"] == 2 and s["accuracy"] == 0.5
    empty = labels.update_statistics(rows.limit(0), feed(spark)).first()
    assert empty["total_updates"] == 0 and empty["accuracy"] == 0.0


def test_partition_rewrite_touches_only_changed_partitions(spark):
    path = scratch_path(spark, "log")
    rows = log(spark, [("a", 1, None), ("c", 0, 0)]).unionByName(
        log(spark, [("x", 1, None)]).withColumn("request_timestamp", F.lit("2024-01-09 00:00:00").cast("timestamp_ntz"))
    ).withColumn("request_date", F.to_date("request_timestamp"))
    writers.write_table(rows, path, "append", ["request_date", "endpoint_name"])
    files = lambda: {r[0] for r in spark.read.parquet(path).where("inference_id = 'x'").select("_metadata.file_path").collect()}
    before = files()
    assert lake.merge_labels_into(spark, path, feed(spark), dry_run=True) == 1
    assert merged(spark.read.parquet(path))["a"] is None
    assert lake.merge_labels_into(spark, path, feed(spark)) == 1
    assert merged(spark.read.parquet(path)) == {"a": 1, "c": 0, "x": None}
    assert files() == before
    # A second run has nothing left to do.
    assert lake.merge_labels_into(spark, path, feed(spark)) == 0


def runs(spark, rows):
    return spark.createDataFrame(rows, "monitoring_run_id string, t string, endpoint_name string").select(
        "*", F.to_timestamp_ntz("t").alias("monitoring_timestamp")
    )


def test_run_tags_are_half_open_windows_and_idempotent(spark):
    r = runs(spark, [("r1", "2024-01-05 10:00:00", "ep"), ("r2", "2024-01-08 00:00:00", "ep"), ("other", "2024-01-09 00:00:00", "ep2")])
    times = ["2024-01-01 00:00:00", "2024-01-05 10:00:00", "2024-01-05 10:00:01", "2024-01-08 00:00:00", "2024-01-08 00:00:01"]
    rows = conform_log(
        spark.createDataFrame([(str(i), t, "ep") for i, t in enumerate(times)], "inference_id string, t string, endpoint_name string").withColumn(
            "request_timestamp", F.to_timestamp_ntz("t")
        )
    )
    tagged = lineage.tag_runs(rows, lineage.run_windows(r))
    expected = {"0": "r1", "1": "r1", "2": "r2", "3": "r2", "4": None}
    assert {x["inference_id"]: x["monitoring_run_id"] for x in tagged.collect()} == expected
    again = lineage.tag_runs(tagged, lineage.run_windows(r))
    assert {x["inference_id"]: x["monitoring_run_id"] for x in again.collect()} == expected


def test_score_maps_scalar_object_and_empty(spark):
    rows = [
        ("r1", '{"x": 0.5, "y": {"score": 0.01, "magnitude": 5.0, "method": "K-S p_value", "threshold": 0.05}}'),
        ("r2", "{}"), ("r3", "null"), ("r4", None), ("r5", '{"z": {"score": "bad"}}'),
    ]
    df = verdict.conform_verdicts(spark.createDataFrame(rows, "monitoring_run_id string, per_feature_drift_scores string"))
    got = {(r["monitoring_run_id"], r["feature_name"]): r for r in lineage.feature_drift_detail(df).collect()}
    assert set(got) == {("r1", "x"), ("r1", "y"), ("r5", "z")}
    x, y, z = got[("r1", "x")], got[("r1", "y")], got[("r5", "z")]
    assert (x["drift_score"], x["drift_magnitude"], x["drift_severity"], x["drift_method"]) == (0.5, 0.5, "Low", None)
    assert (y["drift_score"], y["drift_magnitude"], y["drift_severity"], y["drift_detected"]) == (0.01, 5.0, "Significant", True)
    assert z["drift_score"] is None and z["drift_severity"] == "Low" and z["drift_detected"] is False


def test_scores_survive_the_json_round_trip(spark):
    rows = [("a", 0.2, 2.0, "PSI", 0.1), ("b", 1e-12, 5e10, "K-S p_value", 0.05)]
    packed = verdict.scores_json(spark.createDataFrame(rows, "feature string, drift_score double, drift_magnitude double, method string, threshold double"))
    back = lineage.feature_drift_detail(verdict.conform_verdicts(packed)).orderBy("feature_name").collect()
    assert [(r["feature_name"], r["drift_score"], r["drift_magnitude"], r["drift_method"]) for r in back] == [("a", 0.2, 2.0, "PSI"), ("b", 1e-12, 5e10, "K-S p_value")]


def test_no_drift_no_alert(spark):
    base = {"monitoring_run_id": "r", "data_drift_detected": False, "model_drift_detected": False, "per_feature_drift_scores": '{"x": 0.5}'}
    df = verdict.conform_verdicts(spark.createDataFrame([base]))
    assert verdict.alerts(df, lineage.feature_drift_detail(df)).count() == 0
    hot = verdict.conform_verdicts(
        spark.createDataFrame([{**base, "data_drift_detected": True, "model_drift_detected": True, "drifted_columns_count": 2, "features_analyzed": 3,
                                "drifted_columns_share": 0.66, "per_feature_drift_scores": '{"x": 3.0, "y": 4.0}', "current_roc_auc": 0.8, "baseline_roc_auc": 0.9, "roc_auc_degradation_pct": 11.1}])
    )
    rows = {r["alert_type"]: r for r in verdict.alerts(hot, lineage.feature_drift_detail(hot)).collect()}
    assert set(rows) == {"DATA_DRIFT_DETECTED", "MODEL_DRIFT_DETECTED"}
    assert rows["DATA_DRIFT_DETECTED"]["drifted_features"] == ["y", "x"] and rows["DATA_DRIFT_DETECTED"]["severity"] == "HIGH"


def test_metric_names(spark):
    df = spark.createDataFrame([("F1Score()",), ("Class::Recall (macro)",), ("a b!c",)], "n string")
    assert [r[0] for r in df.select(verdict.safe_metric_name(F.col("n"))).collect()] == ["f1score", "class_recall", "a_bc"]


def test_baseline_is_of_the_deployed_model(spark):
    dep = spark.createDataFrame([("ep", "v1", "2024-01-01 00:00:00"), ("ep", "v2", "2024-01-10 00:00:00")], "endpoint_name string, model_version string, t string").withColumn("valid_from", F.to_timestamp_ntz("t"))
    rec = spark.createDataFrame([("v1", "Approved", 0.9, "2024-01-01 00:00:00"), ("v3", "Rejected", 0.99, "2024-01-04 00:00:00")], "model_version string, approval_status string, roc_auc double, t string").withColumn("created_at", F.to_timestamp_ntz("t")).drop("t")
    at = lambda t, r=rec: baselines.resolve_baselines(dep, r, t).first()
    assert (at("2024-01-05 00:00:00")["source"], at("2024-01-05 00:00:00")["roc_auc"]) == ("deployed", 0.9)
    late = at("2024-01-11 00:00:00")
    assert (late["deployed_version"], late["model_version"], late["source"]) == ("v2", "v1", "latest_approved")
    assert at("2024-01-11 00:00:00", rec.where("model_version = 'v3'"))["source"] == "none"


def test_version_drift_messages(spark):
    rows = log(spark, [("a", 1, None), ("b", 1, None)]).withColumn("model_version", F.col("inference_id"))
    none = ops.version_drift(rows, "ep", "2025-01-01 00:00:00").first()
    assert none["version_count"] == 0 and not none["has_drift"] and "No inferences" in none["drift_message"]
    two = ops.version_drift(rows, "ep", "2024-01-05 10:30:00").first()
    assert two["has_drift"] and two["version_count"] == 2


def test_snapshots(spark):
    root = scratch_path(spark, "lake")
    with pytest.raises(FileNotFoundError):
        lake.read_snapshot(spark, root, "t")
    first = lake.snapshot(spark.range(3), root, "t", "2024-01-01 00:00:00")
    second = lake.snapshot(spark.range(5), root, "t", "2024-01-02 00:00:00")
    assert lake.read_snapshot(spark, root, "t", first).count() == 3 and lake.read_snapshot(spark, root, "t").count() == 5
    assert lake.current_snapshot_id(spark, root, "t") == second
    assert lake.expire_snapshots(spark, root, "t", datetime(2024, 2, 1), 7, pinned=[first]) == []
    assert lake.expire_snapshots(spark, root, "t", datetime(2024, 2, 1), 7) == [first]
    assert lake.read_snapshot(spark, root, "t").count() == 5


def test_seeding_checks_both_classes(spark):
    rows = spark.createDataFrame([(True, "train"), (False, "train"), (True, "eval")], "y boolean, split string")
    with pytest.raises(ValueError, match="lacks a class"):
        lake.seed_split(rows, scratch_path(spark, "seed"), "y", "2024-01-01 00:00:00")


def test_export_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported format"):
        writers.export(spark.range(1), str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError, match="no rows"):
        writers.export_for_scoring(spark.range(0), str(tmp_path / "y"), "id")
    with pytest.raises(ValueError, match="unsupported mode"):
        writers.write_table(spark.range(1), str(tmp_path / "z"), "upsert")


def test_table_definitions():
    schema = FeatureSchema("id", "y", (("x", "double"),), auxiliary=(("aux", "double"),))
    tables = catalog.table_definitions(schema)
    assert len(tables) == 7
    assert tables["training_data"][0].names == ["id", "x", "aux", "y", "data_version", "created_at", "updated_at"]
    assert len(tables["monitoring_responses"][0].names) == 29 and tables["monitoring_responses"][1] == ["monitoring_date"]
    assert tables["inference_responses"][1] == ["request_date", "endpoint_name"]


def test_catalog_inspection(spark):
    schema = FeatureSchema("id", "y", (("x", "double"),))
    db = "unit_catalog"
    location = scratch_path(spark, "db")
    assert catalog.create_all_tables(spark, db, schema, location) == catalog.create_all_tables(spark, db, schema, location)
    assert catalog.table_exists(spark, f"{db}.training_data") and not catalog.table_exists(spark, f"{db}.nope")
    assert len(catalog.list_tables(spark, db)) == 7
    info = {r["column"]: r["is_partition"] for r in catalog.table_info(spark, f"{db}.inference_responses").collect()}
    assert info["request_date"] and not info["prediction"]
    assert catalog.table_partitions(spark, f"{db}.inference_responses").count() == 0
    assert catalog.verify_tables(spark, db, schema).where("present").count() == 7
    catalog.drop_all_tables(spark, db, schema)
    assert catalog.verify_tables(spark, db, schema).where("present").count() == 0
    spark.sql(f"DROP DATABASE {db}")
