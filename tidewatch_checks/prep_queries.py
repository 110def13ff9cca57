"""Feature preparation (B), data quality (D4-D8, D27), sampling and splitting (L, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import columns as c
from tidewatch.config import FeatureSchema
from tidewatch.operators import features, ops, prep, sampling, validate, windows
from tidewatch.plans.scoring import with_scores
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, LINE_SCHEMA, NUMERIC, PAYLOAD_SCHEMA, TREND_FEATURES, Tables


def _staged(t: Tables):
    """Line rows as an all-text table in canonical order."""
    return t.line_rows.select(*[F.col(n).cast("string").alias(n) for n in LINE_SCHEMA.column_order()])


@check("b1_typed_table", "SELECT * FROM line_rows", " ".join(NUMERIC))
def typed_table(t: Tables):
    return prep.typed_table(_staged(t), LINE_SCHEMA)


@check(
    "b1_typed_table_lenient",
    """SELECT row_id, TRY_CAST(l_linestatus AS DOUBLE) AS l_quantity, lower(CASE WHEN is_returned THEN 'TRUE' ELSE 'no idea' END) = 'true' OR NULL AS is_returned FROM line_rows""",
    "l_quantity",
)
def typed_lenient(t: Tables):
    bad = _staged(t).withColumn("l_quantity", F.col("l_linestatus")).withColumn(
        "is_returned", F.when(F.col("is_returned") == "true", "TRUE").otherwise("no idea")
    )
    return prep.typed_table(bad, LINE_SCHEMA, strict=False).select("row_id", "l_quantity", "is_returned")


@check(
    "b2_b3_input_validation",
    """SELECT 'header' AS check_name, 'expected 8 columns, found 9' AS detail, CAST(NULL AS BIGINT) AS bad_count
       UNION ALL SELECT 'header', 'unexpected columns: note', NULL
       UNION ALL SELECT 'type', 'l_tax double ' || min(l_linestatus), count(*) FROM line_rows""",
)
def input_validation(t: Tables):
    rows = _staged(t).withColumn("l_tax", F.col("l_linestatus")).withColumn("note", F.lit("x"))
    header = validate.header_violations(rows, LINE_SCHEMA).select(
        F.lit("header").alias("check_name"), F.col("problem").alias("detail"), F.lit(None).cast("bigint").alias("bad_count")
    )
    types = validate.type_violations(rows, LINE_SCHEMA).select(
        F.lit("type").alias("check_name"), F.concat_ws(" ", "column", "expected", "example").alias("detail"), "bad_count"
    )
    return header.unionByName(types)


@check(
    "b4_boolean_encoding",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS large FROM orders""",
)
def boolean_encoding(t: Tables):
    rows = t.raw("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("no").alias("finished"),
        (F.col("o_totalprice") > 200000).alias("large"),
    )
    return prep.fit_encoders(rows).transform(rows)


@check(
    "b5_category_encoding",
    """SELECT c_custkey, c_name, CAST(list_position((SELECT list_sort(list(DISTINCT lower(c_mktsegment))) FROM customer), lower(c_mktsegment)) - 1 AS INTEGER) AS c_mktsegment
       FROM customer""",
)
def category_encoding(t: Tables):
    rows = t.raw("customer").select("c_custkey", "c_name", "c_mktsegment")
    return prep.fit_encoders(rows).transform(rows)


@check(
    "b5_category_profile",
    """SELECT 'l_returnflag' AS "column", count(DISTINCT lower(l_returnflag)) AS n_categories, string_agg(DISTINCT lower(l_returnflag), ',' ORDER BY lower(l_returnflag)) AS categories, 'category' AS kind FROM lineitem
       UNION ALL SELECT 'l_linestatus', count(DISTINCT lower(l_linestatus)), string_agg(DISTINCT lower(l_linestatus), ',' ORDER BY lower(l_linestatus)), 'category' FROM lineitem""",
)
def category_profile(t: Tables):
    profile = prep.category_profile(t.lineitem, ["l_returnflag", "l_linestatus"])
    return profile.withColumn("categories", F.array_join("categories", ","))


@check(
    "b6_encoded_baseline",
    """SELECT transaction_amount, transaction_hour, k, CAST(list_position(['click','error','purchase','signup','view'], channel) - 1 AS DOUBLE) AS channel FROM training""",
    "transaction_amount transaction_hour k channel",
)
def encoded_baseline(t: Tables):
    return prep.encode_baseline(t.training, PAYLOAD_SCHEMA, prep.fit_encoders(t.training, ["channel"]))


@check(
    "b6_wide_text_feature",
    """SELECT transaction_amount, CAST(NULL AS DOUBLE) AS transaction_id, CAST(list_position(['click','error','purchase','signup','view'], channel) - 1 AS DOUBLE) AS channel FROM training""",
    "transaction_amount transaction_id channel",
)
def wide_text_feature(t: Tables):
    """A text feature of too many values has no code: it is NULL, and listed as skipped."""
    schema = FeatureSchema(identifier="transaction_id", target="is_fraud", features=(("transaction_amount", "double"), ("transaction_id", "string"), ("channel", "string")))
    encoders = prep.fit_encoders(t.training, ["transaction_id", "channel"])
    if encoders.skipped != ("transaction_id",):
        raise ValueError(f"skipped {encoders.skipped}")
    return prep.encode_baseline(t.training, schema, encoders)


@check(
    "b7_payload_features",
    "SELECT CAST(event_id AS VARCHAR) AS inference_id, transaction_amount, transaction_hour, k, channel, CAST(NULL AS DOUBLE) AS absent FROM ef",
    "transaction_amount transaction_hour k channel absent",
)
def payload_features(t: Tables):
    return prep.payload_features(t.pred, "input_features", [*PAYLOAD_SCHEMA.feature_names, "absent"], ["inference_id"])


@check(
    "b8_training_projection",
    "SELECT CAST(is_returned AS INTEGER) AS is_returned, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber FROM line_rows",
    " ".join(NUMERIC),
)
def training_projection(t: Tables):
    return prep.training_projection(t.line_rows, "is_returned")


@check("b9_model_input", "SELECT l_tax, CAST(0.0 AS DOUBLE) AS absent, l_quantity FROM lineitem", "l_tax absent l_quantity")
def model_input(t: Tables):
    return prep.model_input(t.lineitem, ["l_tax", "absent", "l_quantity"])


@check(
    "b10_payload_numbers",
    """SELECT CAST(event_id AS VARCHAR) AS inference_id, k, CAST(list_position(['click','error','purchase','signup','view'], event_type) - 1 AS DOUBLE) AS note FROM ef""",
    "k note",
)
def payload_numbers(t: Tables):
    encoders = prep.fit_encoders(t.events.select(F.col("event_type").alias("note")))
    return prep.payload_numbers(t.pred, "input_features", ["k", "note"], encoders, ["inference_id"])


@check(
    "b11_score_derivations",
    """SELECT inference_id, prediction, probability_non_fraud, confidence_score, is_high_confidence, is_low_confidence, prediction_bucket FROM pred""",
    "probability_non_fraud confidence_score",
)
def score_derivations(t: Tables):
    return with_scores(t.pred.select("inference_id", "probability_fraud")).drop("probability_fraud")


@check("b12_renamed_columns", "SELECT o_orderkey AS transaction_id, o_totalprice AS transaction_amount FROM orders", "transaction_amount")
def renamed_columns(t: Tables):
    names = {"o_orderkey": "transaction_id", "o_totalprice": "transaction_amount"}
    return prep.rename_source(t.raw("orders").select(*names), names)


TS = "request_timestamp"


@check(
    "b20_time_filters",
    f"""SELECT 'lookback' AS name, count(*) AS n FROM pred WHERE {TS} > TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR AND {TS} <= TIMESTAMP '{AS_OF}'
        UNION ALL SELECT 'half_open', count(*) FROM pred WHERE {TS} >= TIMESTAMP '2024-01-10' AND {TS} < TIMESTAMP '2024-01-12'
        UNION ALL SELECT 'closed', count(*) FROM pred WHERE {TS} BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'
        UNION ALL SELECT 'since_last_run', count(*) FROM pred WHERE endpoint_name = 'ep-a' AND {TS} <= TIMESTAMP '2024-01-20 12:00:00'
          AND {TS} > (SELECT max(monitoring_timestamp) FROM runs WHERE endpoint_name = 'ep-a' AND monitoring_timestamp < TIMESTAMP '2024-01-20 12:00:00')
        UNION ALL SELECT 'cold_start', count(*) FROM pred WHERE endpoint_name = 'ep-a' AND {TS} <= TIMESTAMP '2024-01-01 20:00:00'
          AND {TS} > TIMESTAMP '2024-01-01 20:00:00' - INTERVAL 12 HOUR""",
)
def time_filters(t: Tables):
    """Every window over the log by day and endpoint."""
    parts = {
        "lookback": windows.last(t.log, TS, AS_OF, hours=36),
        "half_open": windows.half_open(t.log, TS, "2024-01-10 00:00:00", "2024-01-12 00:00:00"),
        "closed": windows.closed(t.log, TS, "2024-01-10 00:00:00", "2024-01-12 00:00:00"),
        "since_last_run": sampling.since_last_run(t.log, TS, t.runs, "ep-a", "2024-01-20 12:00:00"),
        "cold_start": sampling.since_last_run(t.log, TS, t.runs, "ep-a", "2024-01-01 20:00:00", 12),
    }
    out = None
    for name, df in parts.items():
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@check(
    "b21_packed_features",
    """SELECT l_orderkey, CAST(json_object('l_linenumber', l_linenumber, 'l_returnflag', l_returnflag) AS VARCHAR) AS input_features FROM lineitem""",
)
def packed_features(t: Tables):
    return prep.pack_features(t.lineitem, ["l_linenumber", "l_returnflag"]).select("l_orderkey", "input_features")


@check(
    "b22_non_null_counts",
    """SELECT unnest([{'column': 'ground_truth', 'n': count(ground_truth)}, {'column': 'prediction', 'n': count(prediction)},
                      {'column': 'ground_truth_source', 'n': count(ground_truth_source)}], recursive := true) FROM lpred""",
)
def non_null_counts(t: Tables):
    return prep.non_null_counts(t.lpred, ["ground_truth", "prediction", "ground_truth_source"])


@check("b22_drop_empty", "SELECT inference_id, probability_fraud FROM pred", "probability_fraud")
def drop_empty(t: Tables):
    rows = t.pred.select("inference_id", "ground_truth", "probability_fraud")
    return prep.drop_empty(rows, ["ground_truth", "probability_fraud"])


@check(
    "b23_perturbed_means",
    """SELECT feature, before AS original_mean, after AS drifted_mean, (after - before) / before * 100 AS pct_change
       FROM (SELECT unnest([{'feature': 'l_quantity', 'before': avg(l_quantity), 'after': avg(l_quantity * 1.1)},
                            {'feature': 'l_discount', 'before': avg(l_discount), 'after': avg(greatest(l_discount - 0.02, 0))},
                            {'feature': 'l_tax', 'before': avg(l_tax), 'after': avg(round_even(l_tax + 0.3, 0))}], recursive := true) FROM lineitem)""",
    "original_mean drifted_mean pct_change",
)
def perturbed(t: Tables):
    changes = {"l_quantity": {"factor": 1.1}, "l_discount": {"shift": -0.02}, "l_tax": {"shift": 0.3}, "absent": {"shift": 1}}
    after = prep.perturb(t.lineitem, changes, non_negative=["l_discount"], rounded=["l_tax"])
    return prep.mean_shift(t.lineitem, after, ["l_quantity", "l_discount", "l_tax"])


@check(
    "b23_perturbed_with_noise",
    """SELECT event_id, value * (1.5 + (('0x' || substr(md5('42-' || event_id), 1, 8))::BIGINT % 1048576 / 524288.0::DOUBLE - 1) * 0.3) AS value FROM events""",
    "value",
)
def perturbed_with_noise(t: Tables):
    """Noise is a hash of the key: the same in every engine."""
    rows = t.events.select("event_id", "value")
    return prep.perturb(rows, {"value": {"factor": 1.5, "noise": 0.2}}, key="event_id")


HISTORY = {"num_transactions_24h": ("count(*)", "1 DAY"), "num_transactions_7days": ("count(*)", "7 DAY"),
           "avg_transaction_amount_30days": ("avg(value)", "30 DAY"), "max_transaction_amount_30days": ("max(value)", "30 DAY")}
HISTORY_SQL = (
    "SELECT event_id, "
    + ", ".join(
        f"{agg} OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) RANGE BETWEEN INTERVAL {w} PRECEDING AND CURRENT ROW) AS {n}"
        for n, (agg, w) in HISTORY.items()
    )
    + " FROM events"
)


@check(
    "b24_b25_b28_entity_history",
    f"SELECT *, num_transactions_24h / (num_transactions_7days / 7.0::DOUBLE) AS velocity_score FROM ({HISTORY_SQL})",
    "avg_transaction_amount_30days max_transaction_amount_30days velocity_score",
    digits=9,
)
def entity_history(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return features.entity_history(rows, "user_id", "ts", "value").drop("user_id", "ts", "value")


NOBODY = "(SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id) FROM events)"


@check(
    "b24_b25_b28_history_without_entity",
    f"""SELECT event_id, CASE WHEN user_id IS NOT NULL THEN num_transactions_24h END AS num_transactions_24h,
               CASE WHEN user_id IS NOT NULL THEN num_transactions_7days END AS num_transactions_7days,
               CASE WHEN user_id IS NOT NULL THEN avg_transaction_amount_30days END AS avg_transaction_amount_30days,
               CASE WHEN user_id IS NOT NULL THEN max_transaction_amount_30days END AS max_transaction_amount_30days,
               CASE WHEN user_id IS NOT NULL THEN num_transactions_24h / (num_transactions_7days / 7.0::DOUBLE) END AS velocity_score
        FROM ({HISTORY_SQL.replace("SELECT event_id, ", "SELECT event_id, user_id, ").replace("FROM events", f"FROM {NOBODY}")})""",
    "avg_transaction_amount_30days max_transaction_amount_30days velocity_score",
    digits=9,
)
def history_without_entity(t: Tables):
    """Rows without an entity stay, without a history."""
    entity = F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id")
    rows = t.events.select("event_id", entity, "ts", "value")
    return features.entity_history(rows, "user_id", "ts", "value").drop("user_id", "ts", "value")


@check(
    "b26_previous_without_entity",
    f"""SELECT event_id, CASE WHEN user_id IS NOT NULL THEN (epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))) / 60
               END AS time_since_last_transaction_min FROM {NOBODY}""",
    "time_since_last_transaction_min",
)
def previous_without_entity(t: Tables):
    entity = F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id")
    rows = t.events.select("event_id", entity, "ts")
    return features.minutes_since_previous(rows, "user_id", "ts", "event_id").select("event_id", "time_since_last_transaction_min")


@check(
    "b26_minutes_since_previous",
    """SELECT event_id, (epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))) / 60 AS time_since_last_transaction_min
       FROM events""",
    "time_since_last_transaction_min",
)
def minutes_since_previous(t: Tables):
    return features.minutes_since_previous(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id").select(
        "event_id", "time_since_last_transaction_min"
    )


@check(
    "b27_calendar_features",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS transaction_hour, CAST(isodow(ts) AS INTEGER) AS transaction_day_of_week,
              CAST(date_diff('day', CAST(first AS DATE), CAST(ts AS DATE)) AS INTEGER) AS account_age_days,
              CAST(date_diff('day', CAST(first AS DATE), CAST(ts AS DATE)) // 30 AS INTEGER) AS customer_tenure_months
       FROM events JOIN (SELECT user_id, min(ts) AS first FROM events GROUP BY 1) USING (user_id)""",
)
def calendar_features(t: Tables):
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("first"))
    rows = t.events.select("event_id", "user_id", "ts").join(first, "user_id")
    return features.calendar_features(rows, "ts", "first").drop("user_id", "ts", "first")


@check(
    "b29_filled_missing",
    """SELECT inference_id, coalesce(ground_truth, 0) AS ground_truth, coalesce(days_to_ground_truth, 0) AS days_to_ground_truth FROM lpred""",
    "days_to_ground_truth",
)
def filled_missing(t: Tables):
    rows = t.lpred.select("inference_id", "ground_truth", "days_to_ground_truth")
    return prep.fill_missing(rows, ["ground_truth", "days_to_ground_truth"])


@check(
    "b29_filled_with_mean",
    """SELECT inference_id, coalesce(days_to_ground_truth, (SELECT avg(days_to_ground_truth) FROM lpred)) AS days_to_ground_truth FROM lpred""",
    "days_to_ground_truth",
)
def filled_mean(t: Tables):
    return prep.fill_missing(t.lpred.select("inference_id", "days_to_ground_truth"), ["days_to_ground_truth"], "mean")


def _km(lat1, lon1, lat2, lon2):
    return (
        f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


@check(
    "b30_travel_features",
    f"""SELECT event_id, {_km('lat', 'lon', 'home_lat', 'home_lon')} AS distance_from_home_km, {_km('lat', 'lon', 'prev_lat', 'prev_lon')} AS distance_from_last_transaction_km
        FROM (SELECT *, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
              FROM (SELECT *, 40 + (value / 100) AS lat, -70 - (value / 50) AS lon, 40 + (user_id % 9) / 10 AS home_lat, -70 - (user_id % 7) / 10 AS home_lon FROM events)
              WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "distance_from_home_km distance_from_last_transaction_km",
)
def travel_features(t: Tables):
    rows = t.events.select(
        "event_id", "user_id", "ts", (F.lit(40.0) + F.col("value") / 100).alias("lat"), (F.lit(-70.0) - F.col("value") / 50).alias("lon"),
        (40 + F.col("user_id") % 9 / 10).alias("home_lat"), (-70 - F.col("user_id") % 7 / 10).alias("home_lon"),
    )
    return features.travel_features(rows, "user_id", "ts", "event_id", "lat", "lon", "home_lat", "home_lon").select(
        "event_id", "distance_from_home_km", "distance_from_last_transaction_km"
    )


# -- data quality ---------------------------------------------------------------------------------


@check("d4_class_distribution", "SELECT l_returnflag AS class, count(*) AS n FROM lineitem GROUP BY 1")
def class_distribution(t: Tables):
    return validate.class_distribution(t.lineitem, "l_returnflag")


@check(
    "d4_class_imbalance",
    """SELECT count(*) AS n_classes, max(n) / min(n) AS imbalance_ratio, max(n) / min(n) > 100 AS severe FROM (SELECT is_returned, count(*) AS n FROM line_rows GROUP BY 1)""",
    "imbalance_ratio",
)
def class_imbalance(t: Tables):
    return validate.class_imbalance(t.line_rows, "is_returned")


@check(
    "d5_missing_values",
    """WITH filled AS (SELECT count(*) AS n, count(ground_truth) AS labelled FROM lpred)
       SELECT "column", n - labelled AS n_missing FROM (SELECT unnest(['ground_truth', 'ground_truth_timestamp', 'ground_truth_source', 'days_to_ground_truth']) AS "column")
       CROSS JOIN filled WHERE n > labelled
       UNION ALL
       SELECT "column", n FROM (SELECT unnest(['model_load_time_ms', 'preprocessing_time_ms', 'request_id', 'response_time', 'error_message', 'monitoring_run_id']) AS "column")
       CROSS JOIN filled WHERE n > 0""",
)
def missing_values(t: Tables):
    """Every column of the labelled log: labels are missing where none has arrived, and what the event table does not tell is missing throughout."""
    return validate.missing_values(t.lpred)


@check("d6_duplicate_rows", "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows")
def duplicate_rows(t: Tables):
    return validate.duplicate_rows(t.lineitem)


@check(
    "d7_quality_report",
    """SELECT CAST(sum(n) AS BIGINT) AS total_rows, 8 AS total_columns, 0 AS missing_values, 2 AS n_classes, any_value(r) AS imbalance_ratio,
              CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, '' AS errors, '' AS warnings, true AS passed
       FROM (SELECT COLUMNS(*), count(*) AS n FROM line_rows GROUP BY ALL)
       CROSS JOIN (SELECT max(k) / min(k) AS r FROM (SELECT is_returned, count(*) AS k FROM line_rows GROUP BY 1))""",
    "imbalance_ratio",
)
def quality_report(t: Tables):
    report = validate.quality_report(t.line_rows, "is_returned")
    return report.withColumn("errors", F.array_join("errors", ";")).withColumn("warnings", F.array_join("warnings", ";"))


HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT % {}"
SPLIT = f"CASE WHEN {HASH.format('row_id', 10)} < 8 THEN 'train' ELSE 'eval' END"


@check(
    "d8_two_class_check",
    f"""SELECT CASE split WHEN 'train' THEN 'training_data' ELSE 'evaluation_data' END AS "table", count(*) FILTER (is_returned) AS positives,
               count(*) FILTER (NOT is_returned) AS negatives, count(*) FILTER (is_returned) > 0 AND count(*) FILTER (NOT is_returned) > 0 AS ok
        FROM (SELECT *, {SPLIT} AS split FROM line_rows) GROUP BY split""",
)
def two_class_check(t: Tables):
    split = sampling.with_split(t.line_rows, "row_id")
    tables = {"training_data": split.where("split = 'train'"), "evaluation_data": split.where("split = 'eval'")}
    return validate.two_class_check(tables, "is_returned")


@check(
    "d27_split_statistics",
    f"SELECT {SPLIT} AS split, CAST(is_returned AS VARCHAR) AS class, count(*) AS n FROM line_rows GROUP BY ALL",
)
def split_statistics(t: Tables):
    return sampling.split_statistics(sampling.with_split(t.line_rows, "row_id"), "is_returned")


# -- sampling, splitting, unions ------------------------------------------------------------------


@check(
    "l1_newest_predictions",
    "SELECT inference_id, request_timestamp FROM pred ORDER BY request_timestamp DESC, inference_id LIMIT 100",
)
def newest(t: Tables):
    return sampling.newest(t.pred, "request_timestamp", 100, "inference_id").select("inference_id", "request_timestamp")


@check(
    "l2_random_sample",
    "SELECT inference_id, prediction FROM pred ORDER BY md5('0-' || inference_id), inference_id LIMIT 500",
)
def random_sample(t: Tables):
    return sampling.hash_sample(t.pred, "inference_id", 500).select("inference_id", "prediction")


@check(
    "l3_capped_window",
    f"""SELECT inference_id FROM pred WHERE {TS} > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND {TS} <= TIMESTAMP '{AS_OF}'
        ORDER BY md5('0-' || inference_id), inference_id LIMIT 1000""",
)
def capped_window(t: Tables):
    return sampling.hash_sample(t.pred.where(c.within_last(TS, AS_OF, days=7)), "inference_id", 1000).select("inference_id")


@check("l4_hash_split", f"SELECT row_id, l_quantity, {SPLIT} AS split FROM line_rows", "l_quantity")
def hash_split(t: Tables):
    return sampling.with_split(t.line_rows, "row_id").select("row_id", "l_quantity", "split")


@check(
    "l5_stratified_split",
    f"""SELECT split, class, count(*) AS n FROM (SELECT CAST(is_returned AS VARCHAR) AS class,
               CASE WHEN {HASH.format("is_returned::VARCHAR || '-' || row_id", 1000)} < 200 THEN 'test' ELSE 'train' END AS split FROM line_rows) GROUP BY ALL""",
)
def stratified_split(t: Tables):
    return sampling.split_statistics(sampling.stratified_split(t.line_rows, "row_id", "is_returned"), "is_returned")


@check(
    "l6_u1_stratified_pull",
    """(SELECT inference_id, ground_truth FROM lpred WHERE ground_truth = 1 ORDER BY md5('0-' || inference_id), inference_id LIMIT 200)
       UNION ALL (SELECT inference_id, ground_truth FROM lpred WHERE ground_truth = 0 ORDER BY md5('0-' || inference_id), inference_id LIMIT 200)""",
)
def stratified_pull(t: Tables):
    return sampling.stratified_pull(t.lpred, "inference_id", "ground_truth", 400).select("inference_id", "ground_truth")


@check(
    "l7_stratified_background_sample",
    f"""SELECT inference_id, ground_truth FROM lpred WHERE ground_truth IS NOT NULL
        AND {HASH.format("'42-' || inference_id", 10000)} < CASE ground_truth WHEN 0 THEN 2000 WHEN 1 THEN 5000 END""",
)
def background_sample(t: Tables):
    return sampling.stratified_fraction(t.labelled, "inference_id", "ground_truth", {0: 0.2, 1: 0.5}).select("inference_id", "ground_truth")


@check(
    "l7_background_of_n_rows",
    """WITH classes AS (SELECT model_version AS c, count(*) AS size FROM pred GROUP BY 1), total AS (SELECT sum(size) AS t, least(sum(size), 501) AS n FROM classes),
            quotas AS (SELECT c, size * n // t AS whole, (size * n) % t AS rest, n FROM classes CROSS JOIN total),
            final AS (SELECT c, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= n - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM quotas)
       SELECT inference_id, model_version FROM (SELECT inference_id, model_version, row_number() OVER (PARTITION BY model_version ORDER BY md5('42-' || inference_id), inference_id) AS place FROM pred)
       JOIN final ON c = model_version WHERE place <= quota""",
)
def background_of_n_rows(t: Tables):
    """501 rows, split over the versions as the log is."""
    return sampling.stratified_sample(t.pred, "inference_id", "model_version", 501).select("inference_id", "model_version")


@check(
    "l8_seeded_sample",
    "SELECT inference_id FROM pred ORDER BY md5('42-' || inference_id), inference_id LIMIT 300",
)
def seeded_sample(t: Tables):
    return sampling.hash_sample(t.pred, "inference_id", 300, seed=42).select("inference_id")


@check(
    "l9_top_k",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
    "c_acctbal",
)
def top_k(t: Tables):
    return sampling.top_k(t.raw("customer").select("c_custkey", "c_acctbal"), "c_acctbal", 20, "c_custkey")


@check(
    "u2_union_of_class_splits",
    f"""SELECT CASE WHEN {HASH.format("is_returned::VARCHAR || '-' || row_id", 1000)} < 200 THEN 'test' ELSE 'train' END AS split, count(*) AS n, sum(l_quantity) AS quantity FROM line_rows GROUP BY 1""",
    "quantity",
)
def union_of_splits(t: Tables):
    parts = [sampling.stratified_split(t.line_rows.where(f), "row_id", "is_returned") for f in ("is_returned", "not is_returned")]
    return parts[0].union(parts[1]).groupBy("split").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
