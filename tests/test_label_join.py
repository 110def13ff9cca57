"""Stream join of labels: what is joined, what goes to the side table, and a state that empties."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.streaming import ingest, monitor

DAY0 = datetime(2024, 1, 1)


def day(n: float) -> datetime:
    return DAY0 + timedelta(days=n)


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


P = "inference_id string, request_timestamp timestamp_ntz, prediction int, probability_fraud double, arrived timestamp_ntz"
U = "inference_id string, actual_fraud boolean, confirmation_timestamp timestamp_ntz, arrived timestamp_ntz"


def run(spark, root, steps):
    """Drain after each step (predictions, labels); returns (joined, side, rows in the state after each)."""
    for name in ("p", "u"):
        spark.createDataFrame([], P if name == "p" else U).write.parquet(f"{root}/{name}")
    states = []
    for predictions, updates in steps:
        write(spark, f"{root}/p", predictions, P)
        write(spark, f"{root}/u", updates, U)
        joined = monitor.label_stream_join(
            spark.readStream.schema(P).parquet(f"{root}/p"), spark.readStream.schema(U).parquet(f"{root}/u"), arrived="arrived"
        )
        query = monitor.start_label_join(joined, f"{root}/out", f"{root}/side", f"{root}/state", once=True)
        ingest.wait([query])
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    out = {(r["inference_id"], r["ground_truth"]) for r in spark.read.parquet(f"{root}/out/*").collect()}
    side = {(r["inference_id"], r["status"]) for r in spark.read.parquet(f"{root}/side/*").collect()}
    return out, side, states


def test_everything_is_joined_or_in_the_side_table_and_state_empties(spark, tmp_path):
    p = lambda i, at, came: (i, day(at), 1, 0.5, day(came))
    u = lambda i, at, came, y=True: (i, y, day(at), day(came))
    steps = [
        # ``early``: label before its prediction; ``twice``: two different labels; ``again``: redelivered; ``old``: event of long ago.
        ([p("plain", 0, 0), p("twice", 0, 0), p("again", 0, 0), p("again", 0, 0), p("gone", 0, 0), p("old", -300, 0)], [u("early", 3, 0), u("lost", 3, 0)]),
        ([p("early", 1, 5)], [u("plain", 4, 5), u("twice", 4, 5), u("twice", 6, 5, False), u("again", 4, 5), u("again", 4, 5), u("old", -290, 5), u("plain", 31, 5)]),
        ([(None, day(5), 1, 0.5, day(5))], [(None, True, day(5), day(5))]),
        ([], [u("tick", 60, 60)]),
        ([], [u("gone", 9, 61)]),
        ([], [u("tick2", 130, 130)]),
        ([], [u("tick3", 200, 200)]),
    ]
    out, side, states = run(spark, str(tmp_path), steps)
    assert out == {("plain", 1), ("twice", 1), ("twice", 0), ("again", 1), ("early", 1), ("old", 1)}
    assert side >= {("plain", "outside"), ("lost", "unmatched"), ("gone", "unmatched"), ("tick", "unmatched")}
    assert spark.read.parquet(f"{tmp_path}/out/*").count() == 6
    assert states[0] == 7 and states[-1] <= 2  # only what came last


def test_null_scores_and_labels(spark, tmp_path):
    steps = [([("a", day(0), None, None, day(0))], [("a", None, day(1), day(0))]), ([], [("z", True, day(90), day(90))])]
    out, _, _ = run(spark, str(tmp_path), steps)
    assert out == {("a", None)}
    row = spark.read.parquet(f"{tmp_path}/out/*").first()
    assert row["prediction"] is None and row["probability_fraud"] is None


def test_calls_are_bounded_by_the_states_not_the_ids(spark, tmp_path):
    """Two hundred ids share four states and meet their own labels only."""
    ids = [f"i{n}" for n in range(200)]
    spark.createDataFrame([(i, day(0), n % 2, 0.5, day(0)) for n, i in enumerate(ids)], P).write.parquet(f"{tmp_path}/p")
    spark.createDataFrame([(i, n % 2 == 0, day(n / 4), day(0)) for n, i in enumerate(ids)] + [("alone", True, day(1), day(0))], U).write.parquet(f"{tmp_path}/u")
    read = lambda name, schema: spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}")
    joined = monitor.label_stream_join(read("p", P), read("u", U), arrived="arrived", states=4)
    query = monitor.start_label_join(joined, f"{tmp_path}/out", f"{tmp_path}/side", f"{tmp_path}/state", once=True)
    ingest.wait([query])
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    out = {(r["inference_id"], r["prediction"], r["ground_truth"]) for r in spark.read.parquet(f"{tmp_path}/out/*").collect()}
    side = {(r["inference_id"], r["status"]) for r in spark.read.parquet(f"{tmp_path}/side/*").collect()}
    assert out == {(i, n % 2, int(n % 2 == 0)) for n, i in enumerate(ids) if n <= 120}
    assert side == {(i, "outside") for n, i in enumerate(ids) if n > 120}


class Working:
    """A query that ends after ``ticks`` looks, with a micro-batch done at each if it ``moves``."""

    id = name = "q"

    def __init__(self, ticks, moves):
        self.ticks, self.moves, self.seen, self.stopped = ticks, moves, 0, False

    def awaitTermination(self, seconds):
        time.sleep(seconds / 2)
        self.seen += 1
        return self.seen > self.ticks

    @property
    def lastProgress(self):
        return {"batchId": self.seen if self.moves else 0}

    def stop(self):
        self.stopped = True


def test_wait_ends_a_query_that_stands_still_and_no_other(spark):
    ingest.wait([Working(6, moves=True)], 1)
    still = Working(100, moves=False)
    with pytest.raises(TimeoutError):
        ingest.wait([still], 1)
    assert still.stopped
