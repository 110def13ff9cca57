"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tidewatch_checks.registry import CHECKS
from tidewatch_checks.tables import Tables

PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# Sink, stream and model queries run jobs while they are built; their plans are reads of results.
EAGER = ("a", "r", "v1", "v2", "v3", "c2_partition", "c5_run_membership", "b4", "b5", "b6", "b10", "b22_drop", "b29_filled_with", "p10", "p11")


def plan_of(spark, name, sf_dir):
    df = CHECKS[name].run(Tables(spark, sf_dir))
    return df._jdf.queryExecution().executedPlan().toString(), df._jdf.queryExecution().optimizedPlan().toString()


LAZY = [n for n in CHECKS if not n.startswith(EAGER)]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_nested_loop(spark, sf_dir, name):
    physical, logical = plan_of(spark, name, sf_dir)
    assert not any(node in physical for node in PYTHON_NODES)
    assert "CartesianProduct" not in physical
    # Nested loops only against one row: what is sent around without a key is an aggregate without groups, or a literal row.
    lines = physical.splitlines()
    for i, line in enumerate(lines):
        if "IdentityBroadcastMode" in line:
            below = "".join(lines[i + 1 : i + 9])
            assert "keys=[]" in below or "key=[]" in below or "Range (0, 1," in below, "\n".join(lines[i : i + 9])


@pytest.mark.parametrize(
    "name", ["p3_wasserstein_normed", "p1_psi", "e4_roc_auc", "e7_pr_curve", "e11_daily_metrics", "w2_ordered_prefix", "b24_b25_b28_entity_history", "b26_minutes_since_previous", "c2_label_merge", "d16_latency_summary"]
)
def test_windows_never_gather_rows_in_one_task(spark, sf_dir, name):
    """A single-partition exchange may only sit on aggregated rows: its input has passed an aggregate."""
    physical, _ = plan_of(spark, name, sf_dir)
    lines = physical.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "".join(lines[i + 1 : i + 4])
            assert "HashAggregate" in below or "Aggregate" in below, "\n".join(lines[i : i + 4])


def test_scan_reads_only_needed_columns(spark, sf_dir):
    physical, _ = plan_of(spark, "p3_wasserstein_normed", sf_dir)
    schemas = {line.split("ReadSchema: ")[1] for line in physical.splitlines() if "ReadSchema" in line}
    assert schemas and all("l_partkey" not in s and "l_returnflag" not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(l_shipdate)" in physical


def test_time_filter_reaches_the_scan(spark, sf_dir):
    physical, _ = plan_of(spark, "d12_version_comparison", sf_dir)
    assert "PushedFilters" in physical and "GreaterThan(ts" in physical


def test_label_lookup_is_an_aggregate_not_a_window(spark, sf_dir):
    physical, _ = plan_of(spark, "w1_latest_confirmation", sf_dir)
    assert "Window" not in physical and "max_by" in physical


def test_collapsed_rows_are_shuffled_once(spark, sf_dir):
    df = CHECKS["p3_wasserstein_normed"].run(Tables(spark, sf_dir))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    executed = final.split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in executed
    # Baseline and current side are each scanned once.
    assert executed.count("FileScan parquet") == 2


def test_psi_reads_the_current_side_once(spark, sf_dir):
    df = CHECKS["p1_psi"].run(Tables(spark, sf_dir))
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    # The baseline once for its edges and once for its counts.
    assert executed.count("FileScan parquet") == 3


def test_every_query_is_registered_with_matching_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(CHECKS) - set(entry.oracle_sql())
    # Fitted by an iterative learner.
    assert without == {"v1_trained_model_importance", "v2_scored_table", "v3_hold_out_evaluation"}
