"""Drift statistics on edge cases and against MLlib and numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest, KolmogorovSmirnovTest  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi_square_sf, kolmogorov_sf
from tidewatch.operators import drift


def sides(spark, base, cur, feature="x"):
    rows = [(feature, float(v) if v is not None else None, 0) for v in base] + [(feature, float(v) if v is not None else None, 1) for v in cur]
    return spark.createDataFrame(rows, "feature string, value double, is_current int")


def test_chi_square_p_value_equals_mllib(spark):
    rng = np.random.default_rng(1)
    rows = [(int(s), str(c)) for s, c in zip(rng.integers(0, 2, 500), rng.choice(list("abcd"), 500))]
    rows += [(1, "a")] * 25
    df = spark.createDataFrame(rows, "is_current int, category string").withColumn("feature", F.lit("f"))
    ours = drift.categorical_distances(df).first()
    indexed = StringIndexer(inputCol="category", outputCol="i").fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["i"], outputCol="v").transform(indexed)
    theirs = ChiSquareTest.test(vectors, "v", "is_current").first()
    assert ours["chi_square"] == pytest.approx(theirs["statistics"][0], rel=1e-9)
    assert ours["dof"] == theirs["degreesOfFreedom"][0]
    assert ours["chi_square_p_value"] == pytest.approx(theirs["pValues"][0], rel=1e-6)


def test_chi_square_tail_known_values(spark):
    # Closed form for even degrees of freedom; 1 degree: twice the normal tail.
    cases = [(10.0, 2, np.exp(-5.0)), (60.0, 4, np.exp(-30.0) * 31.0), (3.841458820694124, 1, 0.05), (0.0, 3, 1.0), (5.0, 0, 1.0)]
    df = spark.createDataFrame([(x, d) for x, d, _ in cases], "x double, d int")
    got = [r[0] for r in df.select(chi_square_sf(F.col("x"), F.col("d"))).collect()]
    assert got == pytest.approx([p for _, _, p in cases], rel=1e-9)


def test_kolmogorov_tail(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.999999,), (1.0,), (1.3581,), (5.0,)], "x double")
    got = [r[0] for r in df.select(kolmogorov_sf(F.col("x"))).collect()]
    assert got[0] == 1.0 and got[1] == pytest.approx(0.9999906941986655, abs=1e-9)
    assert got[2] == pytest.approx(got[3], abs=1e-5)
    assert got[4] == pytest.approx(0.05, abs=1e-4) and got[5] < 1e-20


def test_distances_match_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, 400), rng.normal(1, 1, 300)
    got = drift.numeric_distances(sides(spark, a, b)).first()
    grid = np.sort(np.concatenate([a, b]))
    fa, fb = np.searchsorted(np.sort(a), grid, "right") / 400, np.searchsorted(np.sort(b), grid, "right") / 300
    assert got["ks_statistic"] == pytest.approx(np.abs(fa - fb).max(), rel=1e-12)
    w1 = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)) / a.std(ddof=1)
    assert got["wasserstein"] == pytest.approx(w1, rel=1e-9)
    # A shift of one standard deviation is about ten times the threshold.
    assert 8 < got["wasserstein"] / 0.1 < 12


def test_psi_matches_histogram(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(0, 1, 1000), rng.normal(0.5, 1.2, 700)
    edges = np.percentile(a, np.linspace(0, 100, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    p, q = np.histogram(a, edges)[0] / 1000, np.histogram(b, edges)[0] / 700
    p, q = np.where(p == 0, 1e-4, p), np.where(q == 0, 1e-4, q)
    assert drift.psi(sides(spark, a, b)).first()["psi"] == pytest.approx(np.sum((q - p) * np.log(q / p)), rel=1e-9)


def test_empty_side_and_missing_values(spark):
    got = drift.numeric_distances(sides(spark, [1.0, None, float("nan")], [])).first()
    assert (got["n_baseline"], got["n_current"], got["ks_statistic"], got["ks_p_value"]) == (1, 0, 0.0, 1.0)


def test_constant_feature(spark):
    got = drift.numeric_distances(sides(spark, [3.0] * 10, [3.0] * 5)).first()
    assert got["ks_statistic"] == 0.0 and got["wasserstein"] == 0.0 and got["ks_p_value"] == 1.0


def test_selection_by_type_and_size(spark):
    base = spark.range(999).select(F.col("id").cast("double").alias("n"), (F.col("id") % 3).cast("string").alias("c"))
    more = spark.range(1000).select(F.col("id").cast("double").alias("n"), (F.col("id") % 3).cast("string").alias("c"))
    pick = lambda b: {r["feature"]: (r["method"], r["threshold"]) for r in drift.feature_drift(b, more, ["n"], ["c"]).collect()}
    assert pick(base) == {"n": (drift.KS, 0.05), "c": (drift.CHI_SQUARE, 0.05)}
    assert pick(more) == {"n": (drift.WASSERSTEIN, 0.1), "c": (drift.JENSEN_SHANNON, 0.1)}


def test_verdict_directions_and_zero_p_value(spark):
    rows = [("a", 0.01, drift.KS, 0.05), ("b", 0.2, drift.KS, 0.05), ("c", 0.3, drift.WASSERSTEIN, 0.1), ("d", 0.0, drift.KS, 0.05)]
    out = {r["feature"]: r for r in drift.with_verdict(spark.createDataFrame(rows, "feature string, drift_score double, method string, threshold double")).collect()}
    assert [out[f]["drifted"] for f in "abcd"] == [True, False, True, True]
    assert out["a"]["drift_magnitude"] == pytest.approx(5.0) and out["c"]["drift_magnitude"] == pytest.approx(3.0)
    assert out["d"]["drift_magnitude"] == drift.MAX_MAGNITUDE and out["d"]["magnitude_capped"]


def test_dataset_share(spark):
    rows = [(f, 0.3 if f in "ab" else 0.01, drift.WASSERSTEIN, 0.1) for f in "abcd"]
    verdicts = drift.with_verdict(spark.createDataFrame(rows, "feature string, drift_score double, method string, threshold double"))
    assert drift.dataset_verdict(verdicts).first()["data_drift_detected"]
    assert not drift.dataset_verdict(verdicts, 0.51).first()["data_drift_detected"]
    assert [r["feature"] for r in drift.top_drifted(verdicts, 1).collect()] == ["a"]


def test_unknown_test_is_an_error():
    with pytest.raises(ValueError, match="unknown drift test"):
        drift.drift_test("nope")


def test_constant_share_has_no_correlation(spark):
    from tidewatch.operators import trends

    rows = [(f"2024-01-0{i}", 10 * i, 0.0) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "d string, inference_count long, drifted_columns_share double").withColumn(
        "monitoring_timestamp", F.to_timestamp_ntz("d")
    )
    out = trends.volume_drift_outliers(df).collect()
    assert len(out) == 4 and all(r["correlation"] is None and r["outlier"] is None for r in out)
