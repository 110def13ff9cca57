"""Models for every kind of target."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import scoring

FEATURES = ["x", "z"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(300).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))


def test_regression(rows):
    df = rows.withColumn("y", F.col("x") * 2.0)
    scored = scoring.score(df, scoring.train_model(df, "y", FEATURES, "double", iterations=3, step=0.5), FEATURES)
    assert dict(scored.dtypes)["prediction"] == "double" and scored.count() == 300


def test_more_than_two_classes(rows):
    df = rows.withColumn("y", (F.col("x") % 3).cast("int"))
    scored = scoring.score(df, scoring.train_model(df, "y", FEATURES, "int", iterations=5), FEATURES)
    assert {r["prediction"] for r in scored.select("prediction").distinct().collect()} <= {0, 1, 2}
    assert scored.where("confidence_score between 0.3 and 1").count() == 300 and "probability_fraud" not in scored.columns


def test_integer_target_of_two_classes_is_binary(rows):
    df = rows.withColumn("y", (F.col("x") > 4).cast("int"))
    scored = scoring.score(df, scoring.train_model(df, "y", FEATURES, "int", iterations=3, step=0.5), FEATURES)
    assert {"probability_fraud", "prediction_bucket"} <= set(scored.columns) and scored.where("prediction = y").count() > 290


def test_training_rows_are_computed_once(spark):
    """The learner goes over its input several times; what the rows come from is read for it once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return float(v % 7)

    rows = spark.range(500).select((F.col("id") % 2).cast("int").alias("y"), F.udf(counted, "double").asNondeterministic()("id").alias("x"))
    scoring.train_model(rows, "y", ["x"], iterations=2, max_depth=2)
    assert seen.value == 500
