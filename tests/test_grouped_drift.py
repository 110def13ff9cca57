"""Drift of many groups in one pass against the single check group by group, and groups that have nothing to check."""

from __future__ import annotations

import json
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift, grouped_drift, kernel, lineage, verdict
from tidewatch.operators.verdict import VERDICT_SCHEMA
from tidewatch.plans import drift_check

GROUPS = ["endpoint_name", "day"]


def frames(spark, seed=4):
    rng = np.random.default_rng(seed)
    base = [(float(round(v, 2)), float(k), c) for v, k, c in zip(rng.lognormal(1, 1, 400), rng.integers(0, 4, 400), rng.choice(list("abcd"), 400))]
    served = []
    for endpoint, day, n, shift in (("x", 1, 150, 0.0), ("x", 2, 80, 0.7), (None, 1, 40, -0.5), ("y", 2, 3, 2.0), ("y", 3, 1, 0.0)):
        values = zip(rng.lognormal(1 + shift, 1, n), rng.integers(0, 6, n), rng.choice(list("abcxz"), n))
        served += [(endpoint, day, float(round(v, 2)), float(k), str(c).upper()) for v, k, c in values]
    served += [("x", 1, None, float("nan"), None), ("z", 1, None, None, None), ("w", 1, float("nan"), 2.0, "q")]
    return (
        spark.createDataFrame([(v, k, str(c)) for v, k, c in base] + [(None, float("nan"), None)], "amount double, k double, kind string"),
        spark.createDataFrame(served, "endpoint_name string, day int, amount double, k double, kind string"),
        served,
    )


def numbers(values):
    return np.array([v for v in values if v is not None and not math.isnan(v)])


def brute_numeric(base, mine):
    scale = float(np.std(base, ddof=1)) if len(base) > 1 and np.std(base) > 0 else 1.0
    grid = np.unique(np.concatenate([base, mine]))
    fa, fb = (np.searchsorted(np.sort(s), grid, side="right") / len(s) for s in (base, mine))
    return float(np.abs(fa - fb).max()), float((np.abs(fa - fb)[:-1] * np.diff(grid)).sum()) / scale


def brute_text(base, mine):
    a, b = Counter(base), Counter(mine)
    na, nb = sum(a.values()), sum(b.values())
    chi = js = 0.0
    for c in a.keys() | b.keys():
        row = a[c] + b[c]
        ea, eb = row * na / (na + nb), row * nb / (na + nb)
        chi += (a[c] - ea) ** 2 / ea + (b[c] - eb) ** 2 / eb
        p, q = a[c] / na, b[c] / nb
        js += sum(s * math.log(2 * s / (p + q)) / 2 for s in (p, q) if s)
    return chi, len(a.keys() | b.keys()) - 1, math.sqrt(max(js, 0.0))


def test_every_group_against_brute_force(spark):
    base, served, rows = frames(spark)
    held = base.collect()
    got = {
        (r["endpoint_name"], r["day"], r["feature"]): r
        for r in grouped_drift.grouped_distances(drift.melt_numeric(base, ["amount", "k"]), drift.melt_numeric(served, ["amount", "k"], GROUPS), GROUPS).collect()
    }
    cats = {
        (r["endpoint_name"], r["day"], r["feature"]): r
        for r in grouped_drift.grouped_categories(drift.melt_text(base, ["kind"]), drift.melt_text(served, ["kind"], GROUPS), GROUPS).collect()
    }
    assert ("z", 1, "amount") not in got and ("w", 1, "amount") not in got and ("w", 1, "k") in got and ("z", 1, "kind") not in cats
    seen = 0
    for endpoint, day in {r[:2] for r in rows}:
        for i, feature in ((2, "amount"), (3, "k")):
            mine = numbers(r[i] for r in rows if r[:2] == (endpoint, day))
            if not len(mine):
                continue
            g = got[(endpoint, day, feature)]
            before = numbers(r[feature] for r in held)
            ks, area = brute_numeric(before, mine)
            assert (g["n_baseline"], g["n_current"]) == (len(before), len(mine))
            assert math.isclose(g["ks_statistic"], ks, abs_tol=1e-12) and math.isclose(g["wasserstein"], area, rel_tol=1e-9, abs_tol=1e-12)
            seen += 1
        mine = [r[4].lower() for r in rows if r[:2] == (endpoint, day) and r[4] is not None]
        if mine:
            g = cats[(endpoint, day, "kind")]
            chi, dof, js = brute_text([r["kind"] for r in held if r["kind"] is not None], mine)
            assert g["dof"] == dof and math.isclose(g["chi_square"], chi, rel_tol=1e-9) and math.isclose(g["jensen_shannon"], js, rel_tol=1e-9, abs_tol=1e-12)
    assert seen == len(got) == 11


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_area_between_ties_and_gaps(spark, seed):
    """Few distinct values on both sides: steps that meet, cross and coincide."""
    rng = np.random.default_rng(seed)
    base = rng.integers(-3, 4, int(rng.integers(1, 30))).astype(float)
    groups = {str(g): rng.integers(-5, 6, int(rng.integers(1, 12))).astype(float) for g in range(12)}
    groups["same"] = base.copy()
    b = spark.createDataFrame([("f", float(v)) for v in base], "feature string, value double")
    c = spark.createDataFrame([(g, "f", float(v)) for g, vs in groups.items() for v in vs], "g string, feature string, value double")
    for r in grouped_drift.grouped_distances(b, c, ["g"]).collect():
        ks, area = brute_numeric(base, groups[r["g"]])
        assert math.isclose(r["ks_statistic"], ks, abs_tol=1e-12) and math.isclose(r["wasserstein"], area, rel_tol=1e-9, abs_tol=1e-12), r["g"]


def test_prefix_carries_sums_and_latest(spark):
    rows = [("a", float(v), 1, v * 0.5, v if v % 3 == 0 else None) for v in range(50)]
    df = spark.createDataFrame(rows, "g string, value double, w long, s double, seen int").withColumn("note", F.col("value") * 2)
    got = kernel.ordered_prefix(df, ["g"], ["w"], 5, sums=["s"], latest=["seen"], keep=["note"]).collect()
    assert len(got) == 50
    for r in got:
        v = int(r["value"])
        assert (r["w_below"], r["s_below"], r["seen_latest"], r["note"]) == (v, sum(range(v)) * 0.5, v // 3 * 3, v * 2.0)


def test_infinite_values_have_no_area(spark):
    b = spark.createDataFrame([("f", 1.0), ("f", 2.0), ("f", 3.0)], "feature string, value double")
    c = spark.createDataFrame([("g", "f", float("inf")), ("g", "f", 2.0), ("h", "f", 2.0)], "g string, feature string, value double")
    got = {r["g"]: r for r in grouped_drift.grouped_distances(b, c, ["g"]).collect()}
    assert got["g"]["wasserstein"] is None and got["g"]["ks_statistic"] == pytest.approx(0.5) and got["h"]["wasserstein"] == pytest.approx(2 / 3)


def odd_groups(spark):
    """``a`` serves one row, ``b`` NULL only, ``c`` NaN only, ``d`` enough; labels for ``a`` (two) and ``d``."""
    rng = np.random.default_rng(12)
    base = spark.createDataFrame([(float(v), str(c)) for v, c in zip(rng.normal(0, 1, 500), rng.choice(list("pq"), 500))], "amount double, kind string")
    rows = [("a", 9.0, "z"), ("b", None, None), ("b", None, None), ("c", float("nan"), None)]
    rows += [("d", float(v) + 3, "p") for v in rng.normal(0, 1, 200)] + [(None, 9.0, "z")]
    served = spark.createDataFrame(rows, "endpoint_name string, amount double, kind string")
    marks = [("a", 1, 0, 0.1), ("a", 0, 1, 0.9)] + [("d", i % 2, i % 2, 0.2 + 0.6 * (i % 2)) for i in range(150)]
    labelled = spark.createDataFrame(marks, "endpoint_name string, ground_truth int, prediction int, probability_fraud double")
    return base, served, labelled, spark.createDataFrame([("a", 0.9), ("d", 0.9)], "endpoint_name string, baseline_roc_auc double")


@pytest.mark.parametrize("test", ["psi", "auto"])
def test_small_and_empty_groups_are_rows_without_alerts(spark, test):
    base, served, labelled, known = odd_groups(spark)
    runs = drift_check.monitoring_runs(base, served, labelled, ["amount"], ["endpoint_name"], known, categorical=["kind"] if test == "auto" else [], test=test)
    got = {r["endpoint_name"]: r for r in runs.collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    assert {g: (r["logged_rows"], r["data_sample_size"], r["model_sample_size"]) for g, r in got.items()} == {
        "a": (1, 1, 2), "b": (2, 0, 0), "c": (1, 0, 0), "d": (200, 200, 150), None: (1, 1, 0),
    }
    for g in ("a", "b", "c", None):
        r = got[g]
        assert (r["data_status"], r["model_status"]) == ("insufficient_samples", "insufficient_samples")
        assert not r["data_drift_detected"] and not r["model_drift_detected"] and not r["alert_sent"]
    assert got["b"]["features_analyzed"] == 0 and got["b"]["drifted_columns_share"] == 0.0 and got["b"]["per_feature_drift_scores"] is None
    assert got["d"]["data_status"] == got["d"]["model_status"] == "ok" and got["d"]["data_drift_detected"] and got["d"]["alert_sent"]
    assert not got["d"]["model_drift_detected"] and got["d"]["current_roc_auc"] == 1.0
    if test == "auto":
        assert {v["method"] for v in json.loads(got["d"]["per_feature_drift_scores"]).values()} == {drift.KS, drift.CHI_SQUARE}


def test_run_records_have_all_columns(spark):
    base, served, labelled, known = odd_groups(spark)
    checked = drift_check.monitoring_runs(base, served, labelled, ["amount"], ["endpoint_name"], known)
    rows = drift_check.run_records(checked, F.lit("2024-02-01 03:04:05"), F.lit("v3"), {"training_snapshot_id": F.lit("s1")})
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in VERDICT_SCHEMA]
    d = rows.where("endpoint_name = 'd'").first()
    assert (d["monitoring_run_id"], d["model_version"], d["training_snapshot_id"], d["detection_engine"]) == ("drift-20240201-030405-d", "v3", "s1", "spark")
    assert d["alert_sent"] and d["data_sample_size"] == 200


def test_alert_payload_tells_everything(spark):
    base, served, labelled, known = odd_groups(spark)
    runs = drift_check.run_records(drift_check.monitoring_runs(base, served, labelled, ["amount"], ["endpoint_name"], known), F.lit("2024-02-01 03:04:05"), F.lit("v3"))
    (row,) = verdict.alerts(runs, lineage.feature_drift_detail(runs)).collect()
    payload = json.loads(row["payload"])
    assert payload["alert_type"] == "DATA_DRIFT_DETECTED" and payload["severity"] == "HIGH" and payload["endpoint_name"] == "d"
    assert payload["check_timestamp"] == "2024-02-01T03:04:05" and payload["drift_share"] == 1.0
    assert [f["feature"] for f in payload["drifted_features"]] == ["amount"] and payload["recommended_action"] == row["recommended_action"]
