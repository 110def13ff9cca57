"""Streaming label joins, windowed sketches, volume trends and incremental runs."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.stats import safe_ratio
from tidewatch.sources import lake
from tidewatch.streaming import locator

LABEL_DELAY_DAYS = 30
#: Days that a row waits in the state for its partner, from its arrival: the label delay and some for late delivery.
KEEP_DAYS = 32
DAY_US = 86_400_000_000

#: Keyed states that ids are dealt to by their hash. A micro-batch calls Python once for each state that it touches, so at most this often however many
#: ids it brings, and writes the states it touches anew. A checkpoint holds states of the number it was started with.
STATES = 4_096

_MATCHED = "inference_id string, prediction int, probability_fraud double, p_us long, u_us long, ground_truth int, status string"
_ROW = ["inference_id", "kind", "at_us", "prediction", "probability_fraud", "ground_truth", "arrived_us"]
_TYPES = {"inference_id": "object", "prediction": "Int32", "probability_fraud": "Float64", "p_us": "Int64", "u_us": "Int64", "ground_truth": "Int32", "status": "object"}


def _matcher(delay_us: int, keep_us: int):
    """Match the rows of some ids; the state holds for each its prediction, labels that wait for it, and what was seen."""

    def run(_, batches, state):
        ids = json.loads(state.get[0]) if state.exists else {}
        now = state.getCurrentWatermarkMs() * 1000
        out = []

        def close(i, p, u):
            status = "joined" if None not in (p[0], u[0]) and p[0] <= u[0] <= p[0] + delay_us else "outside"
            out.append((i, p[1], p[2], p[0], u[0], u[1], status))

        def forget(i, held, at):
            if held["p"] and at > held["p"][3] + keep_us:
                held.update(p=None, seen=[])
            for u in [u for u in held["u"] if at > u[2] + keep_us]:
                out.append((i, None, None, None, u[0], u[1], "unmatched"))
                held["u"].remove(u)

        rows = [] if state.hasTimedOut else [
            [None if v != v else v for v in r] for pdf in batches for r in zip(*[pdf[c].tolist() for c in _ROW])
        ]
        for i, kind, at, prediction, score, truth, arrived in sorted(rows, key=lambda r: (r[6], r[1], r[2] is not None, r[2] or 0)):
            held = ids.setdefault(i, {"p": None, "u": [], "seen": []})
            forget(i, held, arrived)
            at, truth, arrived = None if at is None else int(at), None if truth is None else int(truth), int(arrived)
            if kind == "p":
                if held["p"] is None:
                    held["p"] = [at, None if prediction is None else int(prediction), score, arrived]
                    for u in held["u"]:
                        close(i, held["p"], u)
                    held["u"] = []
                continue
            if [at, truth] in held["seen"]:
                continue
            held["seen"].append([at, truth])
            if held["p"]:
                close(i, held["p"], [at, truth])
            else:
                held["u"].append([at, truth, arrived])
        for i in list(ids):
            forget(i, ids[i], now)
            if not ids[i]["p"] and not ids[i]["u"]:
                del ids[i]
        if ids:
            state.update((json.dumps(ids, separators=(",", ":")),))
            first = min(arrived for h in ids.values() for arrived in [u[2] for u in h["u"]] + ([h["p"][3]] if h["p"] else []))
            state.setTimeoutTimestamp(max((first + keep_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame({n: pd.array(v, dtype=t) for (n, t), v in zip(_TYPES.items(), zip(*out))})

    return run


def label_stream_join(
    predictions: DataFrame, updates: DataFrame, delay_days: int = LABEL_DELAY_DAYS, keep_days: int = KEEP_DAYS, arrived: str | None = None,
    states: int = STATES,
) -> DataFrame:
    """Confirmations joined with their predictions where they follow within ``delay_days``; ``status`` tells what became of each.

    Rows of an id meet in keyed state, which it shares with others of its hash (``states``).  A row waits ``keep_days`` from its arrival and leaves with
    an event-time timer, so the state holds what arrived in that time and no more.  The clock is the arrival (``arrived``, a timestamp column of both streams that never falls; the time of the
    micro-batch by default), so no row is too late to be seen, however old its event: a confirmation is ``joined``, or ``outside`` the delay, or
    ``unmatched`` when its prediction did not arrive, or had left.  What is not joined belongs to a side table and the batch merge
    (:func:`start_label_join`).  Repeats change nothing while their id is in the state.  Rows without an id are left out.
    """
    clock = F.col(arrived) if arrived else F.current_timestamp()

    def rows(df: DataFrame, kind: str, at: str, **columns: Column) -> DataFrame:
        wanted = {"prediction": "int", "probability_fraud": "double", "ground_truth": "int"}
        return df.where("inference_id IS NOT NULL").select(
            F.col("inference_id").cast("string").alias("inference_id"),
            F.lit(kind).alias("kind"),
            F.unix_micros(F.col(at).cast("timestamp")).alias("at_us"),
            *[columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in wanted.items()],
            clock.cast("timestamp").alias("arrived"),
        )

    p = rows(predictions, "p", "request_timestamp", prediction=F.col("prediction"), probability_fraud=F.col("probability_fraud"))
    u = rows(updates, "u", "confirmation_timestamp", ground_truth=F.col("actual_fraud").cast("int"))
    both = p.unionByName(u).withWatermark("arrived", "0 seconds").withColumns(
        {"arrived_us": F.unix_micros("arrived"), "state": F.pmod(F.xxhash64("inference_id"), F.lit(states)).cast("int")}
    )
    matched = both.groupBy("state").applyInPandasWithState(
        _matcher(delay_days * DAY_US, keep_days * DAY_US), _MATCHED, "held string", "append", "EventTimeTimeout"
    )
    stamp = lambda c: F.timestamp_micros(c)
    return matched.select("inference_id", "prediction", "probability_fraud", stamp("p_us").alias("p_ts"), stamp("u_us").alias("u_ts"), "ground_truth", "status")


def start_label_join(joined: DataFrame, path: str, side_path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Store what :func:`label_stream_join` returns: joined rows, and the confirmations that found no prediction.

    A micro-batch writes folders named by its number, which a replay replaces.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.where("status = 'joined'").drop("status").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            side = batch.where("status != 'joined'").select(
                "inference_id", (F.col("ground_truth") == 1).alias("actual_fraud"), F.col("u_ts").alias("confirmation_timestamp"), "status"
            )
            side.write.mode("overwrite").parquet(f"{side_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = joined.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": "1 minute"})).start()


def label_upserts(updates: DataFrame, log_path: str, checkpoint: str, once: bool = False, force: bool = False) -> StreamingQuery:
    """Merge arriving confirmations into the prediction log, micro-batch by micro-batch.

    Replaying a batch is harmless: only missing labels are filled, and within a batch the latest
    confirmation wins.  Days are found in the log's locator, where ingest left one.
    """
    ids_path = f"{log_path.rstrip('/')}-ids"

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        found = (lambda ids: locator.partitions_of(spark, ids_path, ids, "inference_id", "request_date")) if lake.path_exists(spark, ids_path) else None
        lake.merge_labels_into(spark, log_path, batch, force=force, days_of=found)

    writer = updates.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": "1 minute"})).start()


# -- minute-scale monitoring ----------------------------------------------------------------------


def score_bin(probability: Column | str, bins: int = 100) -> Column:
    """Bin of a score; NULL for NULL and NaN."""
    p = F.col(probability) if isinstance(probability, str) else probability
    known = p.isNotNull() & ~F.isnan(p.cast("double"))
    return F.when(known, F.least(F.greatest(F.floor(p * bins), F.lit(0)), F.lit(bins - 1))).cast("int")


def fixed_bin(value: Column | str, edges: Sequence[float]) -> Column:
    """Number of ``edges`` at or below a value; NULL for NULL and NaN."""
    v = F.col(value) if isinstance(value, str) else value
    place = sum(((v >= float(e)).cast("int") for e in edges), F.lit(0))
    return F.when(v.isNotNull() & ~F.isnan(v.cast("double")), place)


def score_sketch(
    labelled: DataFrame, length: str = "60 minutes", slide: str = "15 minutes", watermark: str | None = "10 minutes", bins: int = 100
) -> DataFrame:
    """(window_start, endpoint, bin) -> positives and negatives: a mergeable sketch of ranking quality.

    Works on a stream (with a watermark) and on a table alike.  Rows without a score or a label say nothing
    about ranking and are left out.
    """
    known = score_bin("probability_fraud", bins).isNotNull() & F.col("ground_truth").isNotNull()
    rows = labelled.where(known).withColumn("event_time", F.col("request_timestamp").cast("timestamp"))
    if rows.isStreaming and watermark:
        rows = rows.withWatermark("event_time", watermark)
    y = F.col("ground_truth").cast("int")
    return rows.groupBy(F.window("event_time", length, slide).alias("w"), "endpoint_name", score_bin("probability_fraud", bins).alias("bin")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    ).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "endpoint_name", "bin", "pos", "neg")


def value_sketch(
    rows: DataFrame, value: str, edges: Sequence[float], length: str = "60 minutes", slide: str = "15 minutes", watermark: str | None = "10 minutes"
) -> DataFrame:
    """(window_start, endpoint, bin) -> n over fixed edges: a mergeable sketch of a feature.

    NULL and NaN have no bin and are left out.
    """
    timed = rows.where(fixed_bin(value, edges).isNotNull()).withColumn("event_time", F.col("request_timestamp").cast("timestamp"))
    if timed.isStreaming and watermark:
        timed = timed.withWatermark("event_time", watermark)
    return timed.groupBy(F.window("event_time", length, slide).alias("w"), "endpoint_name", fixed_bin(value, edges).alias("bin")).agg(
        F.count("*").alias("n")
    ).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "endpoint_name", "bin", "n")


def auc_from_sketch(sketch: DataFrame) -> DataFrame:
    """Rank AUC per window from score bins; rows in the same bin count as ties.

    A window has at most as many rows as bins, so each is folded from one bounded array.
    """
    ordered = F.array_sort(F.collect_list(F.struct("bin", "pos", "neg")))
    start = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(0.0).alias("area"))
    folded = F.aggregate(
        ordered,
        start,
        lambda acc, b: F.struct(
            (acc["below"] + b["neg"]).alias("below"), (acc["area"] + b["pos"] * (acc["below"] + b["neg"] / 2)).alias("area")
        ),
    )["area"]
    totals = sketch.groupBy("window_start", "endpoint_name").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), folded.alias("__area")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return totals.select("window_start", "endpoint_name", "positives", "negatives", safe_ratio(F.col("__area"), pairs, None).alias("roc_auc"))


def psi_from_sketch(sketch: DataFrame, baseline_shares: Sequence[float], floor: float = 1e-4) -> DataFrame:
    """PSI per window from bin counts against fixed baseline shares (one per bin)."""
    bins = len(baseline_shares)
    counts = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    per_window = sketch.groupBy("window_start", "endpoint_name").agg(F.sum("n").alias("n"), counts.alias("c"))
    total = F.lit(0.0)
    for i in range(bins):
        p = max(float(baseline_shares[i]), 0.0) or floor
        share = F.coalesce(F.element_at("c", F.lit(i)), F.lit(0)) / F.col("n")
        q = F.when(share == 0, F.lit(floor)).otherwise(share)
        total = total + (q - p) * F.log(q / F.lit(p))
    return per_window.select("window_start", "endpoint_name", "n", total.alias("psi"))


def volume_by_day(rows: DataFrame, watermark: str | None = "1 hour") -> DataFrame:
    """Serving volume and latency per tumbling day."""
    timed = rows.withColumn("event_time", F.col("request_timestamp").cast("timestamp"))
    if timed.isStreaming and watermark:
        timed = timed.withWatermark("event_time", watermark)
    return timed.groupBy(F.window("event_time", "1 day").alias("w"), "endpoint_name").agg(
        F.count("*").alias("prediction_count"),
        F.sum("inference_latency_ms").alias("latency_sum"),
        F.max("inference_latency_ms").alias("max_latency_ms"),
    ).select(
        F.col("w.start").cast("timestamp_ntz").alias("day"), "endpoint_name", "prediction_count",
        (F.col("latency_sum") / F.col("prediction_count")).alias("avg_latency_ms"), "max_latency_ms",
    )


def incremental_runs(
    log: DataFrame, run: Callable[[DataFrame, int], DataFrame | None], verdict_path: str, checkpoint: str
) -> StreamingQuery:
    """Monitor what arrived since the last run: each drained batch gets one verdict.

    ``run`` maps (new rows, batch id) to verdict rows; the verdict folder of a batch id is replaced,
    so a replayed batch does not add a second verdict.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        verdict = run(batch, batch_id)
        if verdict is not None:
            verdict.write.mode("overwrite").parquet(f"{verdict_path}/batch={batch_id}")

    return log.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
