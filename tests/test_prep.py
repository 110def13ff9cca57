"""Casts, encoders, payloads, validation, perturbation, sampling and entity history."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.functions import columns as c
from tidewatch.operators import features, prep, sampling, validate

SCHEMA = FeatureSchema("id", "y", (("amount", "double"), ("flag", "boolean"), ("kind", "string")))


def staged(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.string_struct())


def test_casts_follow_the_schema(spark):
    row = prep.typed_table(staged(spark, [("7", "12.5", "True", "Male", "FALSE")]), SCHEMA).first()
    assert (row["id"], row["amount"], row["flag"], row["kind"], row["y"]) == ("7", 12.5, True, "Male", False)


def test_strict_cast_raises_and_lenient_gives_null(spark):
    bad = staged(spark, [("7", "x", "maybe", "k", "true")])
    with pytest.raises(Exception, match="column amount: cannot read x"):
        prep.typed_table(bad, SCHEMA).collect()
    row = prep.typed_table(bad, SCHEMA, strict=False).first()
    assert row["amount"] is None and row["flag"] is None and row["y"] is True


def test_header_problems_are_all_reported():
    assert validate.header_problems(SCHEMA.column_order(), SCHEMA) == []
    problems = validate.header_problems(["id", "flag", "kind", "y", "zzz", "q"], SCHEMA)
    assert len(problems) == 3 and "amount" in problems[1] and "zzz, q" in problems[2]
    assert validate.header_problems(["amount", "id", "flag", "kind", "y"], SCHEMA) == ["columns are present but in the wrong order"]


def test_type_violations_skip_blanks(spark):
    good = [("1", v, b, "k", "1") for v, b in (("12.5", "True"), ("-3", "no"), ("0", "YES"), ("1e10", " "), ("", None))]
    assert validate.type_violations(staged(spark, good), SCHEMA).count() == 0
    bad = good + [("2", "abc", "perhaps", "k", "1"), ("3", "abd", "no", "k", "1")]
    rows = {r["column"]: r for r in validate.type_violations(staged(spark, bad), SCHEMA).collect()}
    assert rows["amount"]["bad_count"] == 2 and rows["amount"]["example"] == "abc" and rows["flag"]["bad_count"] == 1


def test_encoders(spark):
    train = spark.createDataFrame(
        [("Yes", "Male", str(i), True) for i in range(11)] + [("no", "female", "x", False), (None, None, None, None)],
        "b string, g string, wide string, native boolean",
    )
    e = prep.fit_encoders(train)
    assert e.booleans == ("b",) and e.categories == {"g": ("female", "male")} and e.skipped == ("wide",)
    other = spark.createDataFrame([("YES", "MALE", "q", False), ("?", "alien", "q", True), (None, None, None, None)], train.schema)
    assert [tuple(r) for r in e.transform(other).collect()] == [(1, 1, "q", 0), (0, -1, "q", 1), (0, -1, None, None)]


def test_ten_categories_encode_and_eleven_do_not(spark):
    df = spark.createDataFrame([(chr(97 + i), chr(97 + i % 10)) for i in range(11)], "eleven string, ten string")
    e = prep.fit_encoders(df)
    assert e.skipped == ("eleven",) and len(e.categories["ten"]) == 10


def test_payload_rules(spark):
    rows = [
        ("ok", '{"a": 1.5, "b": "2", "extra": {"x": 1}}'), ("missing", '{"a": 3}'), ("bad", '{"a": 1, "b": "text"}'),
        ("null", '{"a": null, "b": 1}'), ("none", '{"extra": 1}'), ("broken", '{"a": '), ("empty", "{}"), ("nil", None), ("bool", '{"a": true}'),
    ]
    df = spark.createDataFrame(rows, "id string, payload string")
    got = {r["id"]: (r["a"], r["b"]) for r in prep.payload_features(df, "payload", ["a", "b"], ["id"]).collect()}
    assert got == {"ok": (1.5, 2.0), "missing": (3.0, None), "bool": (1.0, None)}


def test_request_numbers_use_the_fitted_codes(spark):
    e = prep.Encoders(categories={"g": ("female", "male")})
    df = spark.createDataFrame([('{"g": "Male", "n": "4"}',), ('{"g": "alien", "n": {"z": 1}}',), ('{"n": [1]}',)], "p string")
    assert [tuple(r) for r in prep.payload_numbers(df, "p", ["g", "n"], e).collect()] == [(1.0, 4.0), (-1.0, None), (None, None)]


def test_perturbation(spark):
    df = spark.range(2000).select((F.col("id") % 10).cast("double").alias("x"), F.lit(1.0).alias("z"))
    out = prep.perturb(df, {"x": {"factor": 2.0}, "z": {"shift": -5}, "q": {"shift": 1}}, non_negative=["z"]).agg(F.avg("x"), F.max("z")).first()
    assert out[0] == pytest.approx(9.0) and out[1] == 0.0
    keyed = df.withColumn("id", F.monotonically_increasing_id())
    noisy = prep.perturb(keyed, {"x": {"factor": 2.0, "noise": 0.1}}, key="id")
    assert noisy.agg(F.avg("x")).first()[0] == pytest.approx(9.0, rel=0.02)
    assert sorted(noisy.collect()) == sorted(prep.perturb(keyed.repartition(3), {"x": {"factor": 2.0, "noise": 0.1}}, key="id").collect())
    with pytest.raises(ValueError, match="needs a key"):
        prep.perturb(df, {"x": {"factor": 2.0, "noise": 0.1}})
    with pytest.raises(ValueError, match="unknown drift type"):
        prep.perturb(df, {"x": {"type": "sideways"}})


def test_score_buckets_and_edges(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.19, 0.2, 0.4, 0.5, 0.6, 0.8, 1.0)], "p double")
    rows = df.select(c.score_bucket("p").alias("b"), c.predicted("p").alias("y"), c.is_low_confidence(c.confidence("p")).alias("low"), c.risk_tier("p").alias("t")).collect()
    assert [r["b"] for r in rows] == ["very_low", "very_low", "low", "medium", "medium", "high", "very_high", "very_high"]
    assert [r["y"] for r in rows] == [0, 0, 0, 0, 1, 1, 1, 1]
    assert [r["low"] for r in rows] == [False, False, False, True, True, True, False, False]
    assert [r["t"] for r in rows][-2:] == ["Medium Risk", "High Risk"]


def test_quality_gate(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("y"), F.col("id"))
    report = validate.quality_report(df, "y")
    assert report.first()["errors"] == ["Insufficient samples: 500 < 1000"] and not report.first()["passed"]
    with pytest.raises(ValueError, match="Insufficient samples"):
        validate.require_quality(report)
    skewed = spark.range(2000).select((F.col("id") < 2).alias("y"), F.lit(None).cast("int").alias("gap"))
    row = validate.quality_report(skewed, "y").first()
    assert row["passed"] and len(row["warnings"]) == 1 and row["imbalance_ratio"] == 999.0
    assert row["duplicate_rows"] == 1998 and row["missing_values"] == 2000
    assert "not found" in validate.quality_report(df, "nope").first()["errors"][0]


def test_single_class_split_fails_the_check(spark):
    df = spark.createDataFrame([(True,), (True,)], "y boolean")
    assert not validate.two_class_check({"t": df}, "y").first()["ok"]


def test_hash_sample_is_stable_and_exact(spark):
    df = spark.range(1000)
    a = {r["id"] for r in sampling.hash_sample(df, "id", 100).collect()}
    b = {r["id"] for r in sampling.hash_sample(df.repartition(7), "id", 100).collect()}
    assert a == b and len(a) == 100
    assert a != {r["id"] for r in sampling.hash_sample(df, "id", 100, seed=1).collect()}


def test_split_is_a_partition_near_the_ratio(spark):
    df = sampling.with_split(spark.range(5000), "id", 0.8)
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and 0.77 < counts["train"] / 5000 < 0.83


def test_entity_history_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    n = 600
    # One entity holds most rows, many of them in the same second.
    entity = np.where(rng.random(n) < 0.7, 1, rng.integers(2, 5, n))
    second = 1_700_000_000 + rng.integers(0, 40, n) * rng.integers(1, 90_000, n)
    second[:50] = second[0]
    amount = rng.integers(1, 1000, n) / 4
    df = spark.createDataFrame([(i, int(e), int(s), float(a)) for i, (e, s, a) in enumerate(zip(entity, second, amount))], "id int, e int, s long, a double")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    for r in features.entity_history(df, "e", "ts", "a").collect():
        for days, count in ((1, "num_transactions_24h"), (7, "num_transactions_7days")):
            inside = (entity == r["e"]) & (second <= r["s"]) & (second >= r["s"] - days * 86_400)
            assert r[count] == inside.sum()
        inside = (entity == r["e"]) & (second <= r["s"]) & (second >= r["s"] - 30 * 86_400)
        assert r["max_transaction_amount_30days"] == amount[inside].max()
        assert r["avg_transaction_amount_30days"] == pytest.approx(amount[inside].mean())


def test_previous_event_crosses_blocks(spark):
    rows = [(1, "u", "2024-01-01 00:00:00"), (2, "u", "2024-01-01 00:30:00"), (3, "u", "2024-01-03 00:30:00"), (4, "u", "2024-01-03 00:30:00"), (5, "v", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "id int, u string, t string").withColumn("ts", F.to_timestamp_ntz("t"))
    got = {r["id"]: r["time_since_last_transaction_min"] for r in features.minutes_since_previous(df, "u", "ts", "id").collect()}
    assert got == {1: None, 2: 30.0, 3: 2880.0, 4: 0.0, 5: None}


def test_stratified_sample_of_exactly_n_rows(spark):
    rows = [(f"k{i}", "a" if i % 10 else ("b" if i % 20 else None)) for i in range(1000)] + [("only", "rare")]
    df = spark.createDataFrame(rows, "k string, c string")
    for n in (1, 7, 100, 333, 1000, 1001, 5000):
        got = sampling.stratified_sample(df, "k", "c", n).collect()
        assert len(got) == len({r["k"] for r in got}) == min(n, 1001)
        counts = {c: sum(r["c"] == c for r in got) for c in ("a", "b", None, "rare")}
        for c, size in (("a", 900), ("b", 50), (None, 50), ("rare", 1)):
            assert abs(counts[c] - size * min(n, 1001) / 1001) < 1
        # The rows of least hash of their class.
        order = {k: hashlib.md5(f"42-{k}".encode()).hexdigest() for k, _ in rows}
        for c in counts:
            assert sorted(r["k"] for r in got if r["c"] == c) == sorted(sorted((k for k, d in rows if d == c), key=lambda k: (order[k], k))[: counts[c]])
    assert sampling.stratified_sample(df.limit(0), "k", "c", 5).count() == 0
