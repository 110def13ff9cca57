"""Streaming (R) and model training and scoring (V1-V3).

Streams read the given event table as a file source, drain what is available, and are compared with
the same result computed as a batch in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import quality, sampling
from tidewatch.plans import drift_check, scoring
from tidewatch.session import scratch_path
from tidewatch.sources import writers
from tidewatch.streaming import ingest, monitor
from tidewatch_checks.registry import check
from tidewatch_checks.tables import NUMERIC, TREND_FEATURES, Tables


def _event_stream(t: Tables):
    """The event table as a stream."""
    return t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events*.parquet")


class StreamTables(Tables):
    """The derived tables over the streaming source."""

    def __init__(self, t: Tables):
        super().__init__(t.spark, t.sf_dir)
        self.events = _event_stream(t)


def _drain(t: Tables, rows, name: str):
    out, state = scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-state")
    ingest.wait([ingest.start_sink(rows, out, state, once=True)])
    return t.spark.read.schema(rows.schema).parquet(out)


def _messages(t: Tables, rows, name: str, broken: bool = True):
    """Rows as JSON message files; one malformed line is added to each endpoint's messages."""
    path = scratch_path(t.spark, name)
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    text = rows.select(F.to_json(F.struct(*rows.columns), micros).alias("value"))
    if broken:
        text = text.unionByName(rows.select("endpoint_name").distinct().select(F.concat(F.lit("{broken "), "endpoint_name").alias("value")))
    text.write.text(path)
    return path


@check(
    "r1_prediction_ingest",
    """SELECT inference_id, request_timestamp, endpoint_name, prediction, probability_fraud, customer_id, CAST(request_timestamp AS DATE) AS request_date, 2 AS malformed FROM pred""",
    "probability_fraud",
)
def prediction_ingest(t: Tables):
    path = _messages(t, t.pred, "messages")
    out, bad, state = (scratch_path(t.spark, n) for n in ("log", "bad", "state"))
    ingest.wait(ingest.ingest_predictions(ingest.message_files(t.spark, path), out, bad, state, once=True))
    malformed = t.spark.read.schema("value string").parquet(bad).agg(F.count("*").cast("int").alias("malformed"))
    rows = t.spark.read.parquet(out).select(
        "inference_id", "request_timestamp", "endpoint_name", "prediction", "probability_fraud", "customer_id", "request_date"
    )
    return rows.crossJoin(malformed)


@check(
    "r1_late_messages",
    """SELECT inference_id, request_timestamp, endpoint_name, CAST(request_timestamp AS DATE) AS request_date FROM pred""",
)
def late_messages(t: Tables):
    """The newest days arrive first, a file at a time, and the last file comes twice: all are stored, each once."""
    path = scratch_path(t.spark, "late")
    rows = t.pred.withColumn("value", F.to_json(F.struct(*t.pred.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}))
    day = F.dayofmonth("request_timestamp")
    for part in (day > 20, (day > 10) & (day <= 20), day <= 10, day <= 10):
        rows.where(part).select("value").coalesce(1).write.mode("append").text(path)
    out, bad, state = (scratch_path(t.spark, n) for n in ("log", "bad", "state"))
    ingest.wait(ingest.ingest_predictions(ingest.message_files(t.spark, path, 1), out, bad, state, once=True))
    return t.spark.read.parquet(out).select("inference_id", "request_timestamp", "endpoint_name", "request_date")


@check(
    "r2_verdict_ingest",
    """SELECT monitoring_run_id, monitoring_timestamp, endpoint_name, drifted_columns_count, current_roc_auc, data_drift_detected FROM runs""",
    "current_roc_auc",
)
def verdict_ingest(t: Tables):
    path = _messages(t, t.runs, "verdict-messages")
    out, bad, state = (scratch_path(t.spark, n) for n in ("verdicts", "bad", "state"))
    ingest.wait(ingest.ingest_verdicts(ingest.message_files(t.spark, path), out, bad, state, once=True))
    return t.spark.read.parquet(out).select(
        "monitoring_run_id", "monitoring_timestamp", "endpoint_name", "drifted_columns_count", "current_roc_auc", "data_drift_detected"
    )


@check(
    "r3_label_upserts",
    """SELECT inference_id, endpoint_name, ground_truth, ground_truth_timestamp FROM lpred""",
)
def label_upserts(t: Tables):
    """Confirmations arrive as a stream and are merged into the partitioned log."""
    log, updates, state = (scratch_path(t.spark, n) for n in ("log", "updates", "state"))
    writers.write_table(t.pred.withColumn("request_date", F.to_date("request_timestamp")), log, "append", ["request_date", "endpoint_name"])
    t.known.write.parquet(updates)
    stream = t.spark.readStream.schema(t.known.schema).parquet(updates)
    ingest.wait([monitor.label_upserts(stream, log, state, once=True)])
    return t.spark.read.parquet(log).select("inference_id", "endpoint_name", "ground_truth", "ground_truth_timestamp")


@check(
    "r3_label_stream_join",
    """SELECT pred.inference_id, prediction, probability_fraud, request_timestamp AS p_ts, confirmation_timestamp AS u_ts, CAST(actual_fraud AS INTEGER) AS ground_truth
       FROM pred JOIN upd ON pred.inference_id = upd.inference_id AND confirmation_timestamp >= request_timestamp
        AND confirmation_timestamp <= request_timestamp + INTERVAL 30 DAY""",
    "probability_fraud",
)
def label_stream_join(t: Tables):
    s = StreamTables(t)
    return _joined(t, monitor.label_stream_join(s.pred, s.upd))[0]


def _joined(t: Tables, joined, then=None):
    """(joined rows, side table) of a drained stream join, with plain timestamps; ``then`` is called before it is drained once more."""
    out, side, state = (scratch_path(t.spark, n) for n in ("joined", "side", "state"))
    for step in [None] if then is None else [None, then]:
        if step:
            step()
        ingest.wait([monitor.start_label_join(joined, out, side, state, once=True)])
    plain = {"p_ts": F.col("p_ts").cast("timestamp_ntz"), "u_ts": F.col("u_ts").cast("timestamp_ntz")}
    kept = t.spark.read.schema(joined.drop("status").schema).parquet(f"{out}/*").withColumns(plain)
    late = "inference_id string, actual_fraud boolean, confirmation_timestamp timestamp, status string"
    return kept, t.spark.read.schema(late).parquet(f"{side}/*").withColumn("confirmation_timestamp", F.col("confirmation_timestamp").cast("timestamp_ntz"))


@check(
    "r3_late_labels",
    """SELECT inference_id, u_ts, CASE WHEN late THEN 'unmatched' WHEN u_ts <= request_timestamp + INTERVAL 30 DAY THEN 'joined' ELSE 'outside' END AS status
       FROM (SELECT pred.inference_id, request_timestamp, confirmation_timestamp AS u_ts, event_id % 7 = 0 AS late FROM pred JOIN upd USING (inference_id))""",
)
def late_labels(t: Tables):
    """Every seventh id is labelled two months after its prediction arrived, when the state has let it go: those labels go to the side table, none is lost."""
    p, u = scratch_path(t.spark, "arriving-predictions"), scratch_path(t.spark, "arriving-labels")
    first, second = F.lit("2024-03-01 00:00:00").cast("timestamp"), F.lit("2024-05-01 00:00:00").cast("timestamp")
    columns = ["inference_id", "request_timestamp", "prediction", "probability_fraud"]
    t.pred.select(*columns, first.alias("arrived")).write.parquet(p)
    late = F.col("inference_id").cast("long") % 7 == 0
    t.upd.withColumn("arrived", F.when(late, second).otherwise(first)).write.parquet(u)
    read = lambda path: t.spark.readStream.schema(t.spark.read.parquet(path).schema).parquet(path)

    def months_later():
        """One more label moves the clock on, which lets go of those that wait."""
        clock = F.lit("2024-08-01 00:00:00").cast("timestamp")
        t.upd.limit(1).select(*[F.lit("none").alias(c) if c == "inference_id" else F.col(c) for c in t.upd.columns], clock.alias("arrived")).write.mode("append").parquet(u)

    joined, side = _joined(t, monitor.label_stream_join(read(p), read(u), arrived="arrived"), months_later)
    return joined.select("inference_id", "u_ts", F.lit("joined").alias("status")).unionByName(side.select("inference_id", F.col("confirmation_timestamp").alias("u_ts"), "status"))


@check(
    "r4_incremental_runs",
    """WITH cur AS (SELECT endpoint_name, feature, bin, sum(b) AS b FROM fcur GROUP BY ALL),
            grid AS (SELECT g.endpoint_name, g.feature, x.bin, coalesce(a, 0) AS a, coalesce(b, 0) AS b
                     FROM (SELECT DISTINCT endpoint_name, feature FROM cur) g JOIN (SELECT feature, bin FROM fbase UNION SELECT feature, bin FROM cur) x USING (feature)
                     LEFT JOIN fbase ON fbase.feature = g.feature AND fbase.bin = x.bin
                     LEFT JOIN cur ON cur.endpoint_name = g.endpoint_name AND cur.feature = g.feature AND cur.bin = x.bin WHERE a IS NOT NULL OR b IS NOT NULL),
            shares AS (SELECT endpoint_name, feature, CASE WHEN a = 0 THEN 0.0001 ELSE a / sum(a) OVER w END AS p, CASE WHEN b = 0 THEN 0.0001 ELSE b / sum(b) OVER w END AS q,
                              sum(b) OVER w AS n FROM grid WINDOW w AS (PARTITION BY endpoint_name, feature)),
            psi AS (SELECT endpoint_name, feature, sum((q - p) * ln(q / p)) AS psi, max(n) AS n FROM shares GROUP BY ALL),
            data AS (SELECT endpoint_name, count(*) AS features_analyzed, count(*) FILTER (psi > 0.1) AS drifted, max(n) AS n FROM psi GROUP BY 1),
            scores AS (SELECT endpoint_name, probability_fraud AS s, sum(ground_truth) AS pos, sum(1 - ground_truth) AS neg FROM labelled GROUP BY ALL),
            auc AS (SELECT endpoint_name, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc, sum(pos + neg) AS n FROM
                    (SELECT *, coalesce(sum(neg) OVER (PARTITION BY endpoint_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM scores) GROUP BY 1)
       SELECT CAST(0 AS BIGINT) AS batch_id, endpoint_name, l.n AS logged_rows, window_start, window_end, CAST(features_analyzed AS BIGINT) AS features_analyzed,
              CAST(drifted AS BIGINT) AS drifted_columns_count, CAST(data.n AS BIGINT) AS data_sample_size, drifted / features_analyzed >= 0.5 AS data_drift_detected,
              auc AS current_roc_auc, CAST(auc.n AS BIGINT) AS model_sample_size, (0.9 - auc) / 0.9 * 100 AS roc_auc_degradation_pct, (0.9 - auc) / 0.9 * 100 >= 5 AS model_drift_detected
       FROM (SELECT endpoint_name, count(*) AS n, min(request_timestamp) AS window_start, max(request_timestamp) AS window_end FROM pred GROUP BY 1) l
       JOIN data USING (endpoint_name) JOIN auc USING (endpoint_name)""",
    "current_roc_auc roc_auc_degradation_pct",
)
def incremental_runs(t: Tables):
    """Both checks for every endpoint of a drained batch; a second start finds nothing new."""
    out, state = scratch_path(t.spark, "verdicts"), scratch_path(t.spark, "state")
    baselines = t.pred.select("endpoint_name").distinct().withColumn("baseline_roc_auc", F.lit(0.9))
    run = drift_check.incremental_check(t.training, t.known, TREND_FEATURES, baselines)
    for _ in range(2):
        ingest.wait([monitor.incremental_runs(StreamTables(t).pred, run, out, state)])
    return t.spark.read.parquet(f"{out}/*").select(
        "batch_id", "endpoint_name", "logged_rows", "window_start", "window_end", F.col("features_analyzed").cast("long"),
        F.col("drifted_columns_count").cast("long"), "data_sample_size", "data_drift_detected", "current_roc_auc",
        F.col("model_sample_size").cast("long"), "roc_auc_degradation_pct", "model_drift_detected",
    )


# Windows that a stream with this watermark has closed by the end of its input.
WINDOWS = """(SELECT *, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, request_timestamp) - INTERVAL 45 MINUTE,
                                              time_bucket(INTERVAL 15 MINUTE, request_timestamp), INTERVAL 15 MINUTE)) AS window_start FROM {source})"""
CLOSED = "window_start + INTERVAL 60 MINUTE <= (SELECT max(request_timestamp) FROM pred) - INTERVAL 10 MINUTE"
EDGES = [5.0, 10.0, 20.0, 40.0, 80.0]
SHARES = [0.1, 0.1, 0.15, 0.25, 0.25, 0.15]


@check(
    "r5_sliding_auc",
    f"""WITH bins AS (SELECT window_start, endpoint_name, least(floor(probability_fraud * 100), 99) AS bin, sum(g) AS pos, sum(1 - g) AS neg
                      FROM (SELECT *, CASE WHEN transaction_amount > 40 THEN 1 ELSE 0 END AS g FROM {WINDOWS.format(source='pred')}) WHERE {CLOSED} GROUP BY ALL)
        SELECT window_start, endpoint_name, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
               CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) END AS roc_auc
        FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY window_start, endpoint_name ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM bins)
        GROUP BY ALL""",
    "roc_auc",
)
def sliding_auc(t: Tables):
    """Score sketch per hour sliding by 15 minutes; the label here is known at once (amount above 40)."""
    rows = StreamTables(t).pred.withColumn("ground_truth", (F.col("transaction_amount") > 40).cast("int"))
    return monitor.auc_from_sketch(_drain(t, monitor.score_sketch(rows), "score-sketch"))


def psi_sql(source: str, where: str) -> str:
    place = " + ".join(f"CASE WHEN transaction_amount >= {e} THEN 1 ELSE 0 END" for e in EDGES)
    return f"""
    WITH counts AS (SELECT window_start, endpoint_name, {place} AS bin, count(*) AS n FROM {source} WHERE {where} GROUP BY ALL),
         totals AS (SELECT window_start, endpoint_name, sum(n) AS total FROM counts GROUP BY ALL),
         grid AS (SELECT t.*, b.bin, b.p, coalesce(n, 0) AS n FROM totals t CROSS JOIN (SELECT unnest([0,1,2,3,4,5]) AS bin, unnest({SHARES}) AS p) b
                  LEFT JOIN counts c ON c.window_start = t.window_start AND c.endpoint_name = t.endpoint_name AND c.bin = b.bin)
    SELECT window_start, endpoint_name, CAST(any_value(total) AS BIGINT) AS n, sum((q - p) * ln(q / p)) AS psi
    FROM (SELECT *, CASE WHEN n = 0 THEN 0.0001 ELSE n / total END AS q FROM grid) GROUP BY ALL"""


@check(
    "r5_sliding_psi_with_gaps",
    psi_sql("(SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'NaN'::DOUBLE ELSE transaction_amount END AS transaction_amount) FROM "
            + WINDOWS.format(source="pred") + ")", "transaction_amount IS NOT NULL AND NOT isnan(transaction_amount)"),
    "psi",
)
def sliding_psi_with_gaps(t: Tables):
    """NULL and NaN have no bin."""
    n = F.col("inference_id").cast("long") % 5
    holes = F.when(n == 0, F.lit(None)).when(n == 1, F.lit(float("nan"))).otherwise(F.col("transaction_amount"))
    sketch = monitor.value_sketch(t.pred.withColumn("transaction_amount", holes), "transaction_amount", EDGES)
    return monitor.psi_from_sketch(sketch, SHARES)


@check("r5_sliding_psi", psi_sql(WINDOWS.format(source="pred"), CLOSED), "psi")
def sliding_psi(t: Tables):
    sketch = monitor.value_sketch(StreamTables(t).pred, "transaction_amount", EDGES)
    return monitor.psi_from_sketch(_drain(t, sketch, "value-sketch"), SHARES)


@check("r5_sliding_psi_batch", psi_sql(WINDOWS.format(source="pred"), "true"), "psi")
def sliding_psi_batch(t: Tables):
    return monitor.psi_from_sketch(monitor.value_sketch(t.pred, "transaction_amount", EDGES), SHARES)


@check("r6_repeated_messages", "SELECT inference_id, request_timestamp, prediction FROM pred")
def repeated_messages(t: Tables):
    """Every message is delivered twice; each id is kept once."""
    s = StreamTables(t)
    columns = ["inference_id", "request_timestamp", "prediction"]
    twice = s.pred.select(*columns, F.to_date("request_timestamp").alias("day"), F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    out, state = scratch_path(t.spark, "deduplicated"), scratch_path(t.spark, "deduplicated-state")
    ingest.wait([ingest.start_once_sink(twice.drop("delivery"), out, state, "inference_id", ["day"], once=True)])
    return t.spark.read.parquet(out).select(*columns)


@check(
    "r7_daily_volume",
    """SELECT date_trunc('day', request_timestamp)::TIMESTAMP AS day, endpoint_name, count(*) AS prediction_count, avg(inference_latency_ms) AS avg_latency_ms,
              max(inference_latency_ms) AS max_latency_ms FROM pred
       WHERE date_trunc('day', request_timestamp) + INTERVAL 1 DAY <= (SELECT max(request_timestamp) FROM pred) - INTERVAL 1 HOUR GROUP BY ALL""",
    "avg_latency_ms max_latency_ms",
)
def daily_volume(t: Tables):
    return _drain(t, monitor.volume_by_day(StreamTables(t).pred), "volume")


@check(
    "r7_daily_volume_batch",
    """SELECT date_trunc('day', request_timestamp)::TIMESTAMP AS day, endpoint_name, count(*) AS prediction_count, avg(inference_latency_ms) AS avg_latency_ms,
              max(inference_latency_ms) AS max_latency_ms FROM pred GROUP BY ALL""",
    "avg_latency_ms max_latency_ms",
)
def daily_volume_batch(t: Tables):
    return monitor.volume_by_day(t.pred)


# -- models ---------------------------------------------------------------------------------------


def _model(t: Tables):
    rows = sampling.with_split(t.line_rows, "row_id").withColumn("y", F.col("is_returned").cast("int"))
    train = rows.where("split = 'train'")
    held = sampling.stratified_split(train, "row_id", "y", 0.1)
    fitted = scoring.train_model(
        held.where("split = 'train'"), "y", NUMERIC, validation=held.where("split = 'test'"), max_depth=3, iterations=3, step=0.3
    )
    return fitted, rows.where("split = 'eval'")


@check("v1_trained_model_importance")
def trained_importance(t: Tables):
    fitted, _ = _model(t)
    return scoring.importance(fitted, NUMERIC, t.spark)


@check("v2_scored_table")
def scored_table(t: Tables):
    fitted, held_out = _model(t)
    scored = scoring.score(held_out, fitted, NUMERIC)
    rows = writers.batch_log_rows(scored, NUMERIC, "ep-line", "v1", "run-v1", "2024-01-31 00:00:00", key="row_id")
    return rows.groupBy(F.to_date("request_timestamp").alias("day"), "prediction", "prediction_bucket").agg(F.count("*").alias("n"))


@check("v3_hold_out_evaluation")
def hold_out_evaluation(t: Tables):
    fitted, held_out = _model(t)
    scored = scoring.score(held_out, fitted, NUMERIC)
    return quality.performance_metrics(scored, truth="y")
