"""Ordered prefix sums and exact quantiles against brute force, with small buckets to force splitting."""

from __future__ import annotations

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import kernel


def brute(rows):
    out = {}
    groups = {}
    for g, v, w in rows:
        if v is None or math.isnan(v):
            continue
        groups.setdefault(g, {}).setdefault(v, 0)
        groups[g][v] += w
    for g, values in groups.items():
        below = 0
        ordered = sorted(values)
        for i, v in enumerate(ordered):
            nxt = ordered[i + 1] if i + 1 < len(ordered) else None
            out[(g, v)] = (values[v], below, sum(values.values()), nxt)
            below += values[v]
    return out


@pytest.mark.parametrize("bucket_values", [1, 20, 300])
def test_prefix_matches_brute_force(spark, bucket_values):
    rng = np.random.default_rng(3)
    rows = []
    for g in ("a", "b", None):
        values = np.concatenate(
            [rng.normal(1000, 1e-3, 300), rng.normal(0, 50, 200), [0.0, -0.0, 1e12, -1e12, 5e-310, 7.0, 7.0, 7.0], rng.integers(-5, 5, 100)]
        )
        rows += [(g, float(v), int(w)) for v, w in zip(values, rng.integers(1, 4, len(values)))]
    rows += [("a", None, 1), ("b", float("nan"), 1)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    collapsed = kernel.collapse(df, ["g"], "v", {"w": F.col("w")})
    got = kernel.ordered_prefix(collapsed, ["g"], ["w"], bucket_values=bucket_values).collect()
    expected = brute(rows)
    assert {(r["g"], r["value"]) for r in got} == set(expected)
    for r in got:
        assert (r["w"], r["w_below"], r["w_total"], r["next_value"]) == expected[(r["g"], r["value"])]


def test_whole_table_without_groups(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    got = kernel.ordered_prefix(kernel.collapse(df, [], "v", {"n": F.lit(1)}), [], ["n"], bucket_values=10)
    rows = {r["value"]: r for r in got.collect()}
    assert len(rows) == 97 and rows[0.0]["n_below"] == 0 and rows[96.0]["next_value"] is None
    assert all(rows[float(i)]["n_below"] + rows[float(i)]["n"] == rows[float(i + 1)]["n_below"] for i in range(96))


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    data = {"x": rng.lognormal(3, 2, 501), "y": rng.integers(0, 4, 333).astype(float), "z": np.array([2.5])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "g string, v double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["g"]: r["quantiles"] for r in kernel.exact_quantiles(df, ["g"], "v", probabilities).collect()}
    for k, vs in data.items():
        assert np.allclose(got[k], np.percentile(vs, [100 * p for p in probabilities]), rtol=1e-12)


def test_all_values_equal(spark):
    df = spark.range(50).select(F.lit(4.0).alias("v"))
    row = kernel.ordered_prefix(kernel.collapse(df, [], "v", {"n": F.lit(1)}), [], ["n"]).first()
    assert (row["n"], row["n_below"], row["n_total"], row["next_value"]) == (50, 0, 50, None)


def test_empty_input(spark):
    df = spark.range(0).select(F.lit(4.0).alias("v"))
    assert kernel.ordered_prefix(kernel.collapse(df, [], "v", {"n": F.lit(1)}), [], ["n"]).count() == 0


def test_ordered_bits_are_those_of_the_double(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, math.inf, -math.inf, 5e-324, 1.7976931348623157e308]
    for e in range(-1074, 1024):
        power = math.ldexp(1.0, e)
        values += [power, -power, math.nextafter(power, 0), math.nextafter(power, math.inf)]
    values += [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-1060, 1020)) for _ in range(2000)]
    got = kernel.with_bits(spark.createDataFrame([(v,) for v in values], "value double")).collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r["value"])))[0]
        assert r["__bits"] == (-bits if r["value"] < 0 else bits)


def test_no_bucket_above_its_size_where_values_crowd(spark):
    """200,000 values in a millionth of a cell, others spread over it, and two cells without any need to be cut."""
    crowd = spark.range(200_000).select(F.lit("x").alias("g"), (F.lit(1.5) + F.col("id") * 2.0**-38).alias("value"))
    wide = spark.range(2_000).select(F.lit("x").alias("g"), (F.lit(1.0) + F.col("id") / 2_000).alias("value"))
    calm = spark.range(900).select(F.when(F.col("id") % 2 == 0, "x").alias("g"), (F.col("id") + 1024.0).alias("value"))
    rows = crowd.union(wide).union(calm).distinct()
    assert crowd.agg(F.max("value") - F.min("value")).first()[0] < 1e-6
    for most in (1_000, 150_000):
        placed = kernel.bucketed(rows, ["g"], most).cache()
        sizes = placed.groupBy("g", "__cell", "__start").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        assert max(r["n"] for r in sizes) <= most and sum(r["n"] for r in sizes) == rows.count()
        assert len(sizes) <= 4 * rows.count() / most + 8
        for g in {r["g"] for r in sizes}:  # NULL group too
            mine = sorted((r["__cell"], r["__start"], r["lo"], r["hi"]) for r in sizes if r["g"] == g and g is not None)
            assert all(a[3] < b[2] for a, b in zip(mine, mine[1:]))
        placed.unpersist()
    got = kernel.ordered_prefix(rows.withColumn("n", F.lit(1)), ["g"], ["n"], bucket_values=1_000)
    wanted = {r["g"]: r["count"] for r in rows.groupBy("g").count().collect()}
    seen = got.groupBy("g").agg(F.min("n_total").alias("a"), F.max("n_total").alias("b"), F.max("n_below").alias("last")).collect()
    assert {r["g"]: (r["a"], r["b"], r["last"]) for r in seen} == {g: (n, n, n - 1) for g, n in wanted.items()}


def test_bits_are_never_computed_below_the_collapse(spark, tmp_path):
    """Keys of the joins by bits are never NULL, so no test for it goes down through the aggregate to the raw rows."""
    spark.createDataFrame([("x", float(v % 7)) for v in range(50)], "g string, v double").write.parquet(str(tmp_path / "rows"))
    counted = kernel.collapse(spark.read.parquet(str(tmp_path / "rows")), ["g"], "v", {"n": F.lit(1)})
    plan = kernel.ordered_prefix(counted, ["g"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("POWER" in f or "LOG2" in f or "__starts" in f for f in filters)
