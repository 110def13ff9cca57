"""Derived tables the queries run on, as Spark DataFrames and as SQL.

The prediction log, the label feed and the feature tables are projections of the given tables; the
runs table is computed from them by the operators and stored once per session, as a monitoring job
would have left it.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.operators import drift, labels, lineage, quality, verdict
from tidewatch.functions import columns as c
from tidewatch.plans.drift_check import monitoring_runs
from tidewatch.plans.scoring import with_scores
from tidewatch.session import cut_lineage, scratch_path
from tidewatch.sources.writers import conform_log, write_table

AS_OF = "2024-01-31 00:00:00"
SWITCH = "2024-01-16 00:00:00"
BASE_END = "2024-01-08 00:00:00"
# Rows of a group from which the stored runs judge: days of the smallest tables hold some ten.
RUN_MINIMUM = 5
TREND_FEATURES = ["transaction_amount", "transaction_hour", "k"]
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]
SIDE_CUT = "1998-01-01 00:00:00"

# What the served model was trained on: the payload carries these features.
PAYLOAD_SCHEMA = FeatureSchema(
    identifier="transaction_id",
    target="is_fraud",
    features=(("transaction_amount", "double"), ("transaction_hour", "double"), ("k", "double"), ("channel", "string")),
)
LINE_SCHEMA = FeatureSchema(
    identifier="row_id",
    target="is_returned",
    features=tuple((n, "double") for n in NUMERIC) + (("l_linestatus", "string"),),
    auxiliary=(("l_linenumber", "int"),),
)

_STORED: dict[tuple[str, str, str], DataFrame] = {}
_FOLDERS: dict[tuple[str, str, str], str] = {}


def stored(name: str, sf_dir: str, build) -> DataFrame:
    """A derived table, written once per application and input folder."""
    spark = SparkSession.getActiveSession()
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = cut_lineage(build(), name)
    return _STORED[key]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.raw("lineitem")

    @cached_property
    def event_features(self) -> DataFrame:
        """Events with the model features spelled out."""
        codes = ["click", "error", "purchase", "signup", "view"]
        code = F.array_position(F.array(*map(F.lit, codes)), F.col("event_type")) - 1
        return self.events.select(
            "*",
            F.col("value").alias("transaction_amount"),
            F.hour("ts").cast("double").alias("transaction_hour"),
            F.get_json_object("props", "$.k").cast("double").alias("k"),
            code.cast("double").alias("channel_code"),
        )

    @cached_property
    def pred(self) -> DataFrame:
        """Prediction log without labels."""
        version = F.when((F.col("ts") < c.as_of_literal(SWITCH)) | (F.col("user_id") % 10 == 0), "v1").otherwise("v2")
        payload = F.to_json(
            F.struct(
                "transaction_amount", "transaction_hour", "k", F.col("channel_code").alias("channel"),
                F.col("event_type").alias("note"),
            )
        )
        base = self.event_features.select(
            F.col("event_id").cast("string").alias("inference_id"),
            F.col("ts").alias("request_timestamp"),
            F.when(F.col("event_type").isin("click", "view"), "ep-a").otherwise("ep-b").alias("endpoint_name"),
            version.alias("model_version"),
            F.concat(F.lit("run-"), version).alias("mlflow_run_id"),
            payload.alias("input_features"),
            ((F.col("event_id") * 7919) % 1000 / 1000.0).alias("probability_fraud"),
            F.col("value").alias("inference_latency_ms"),
            F.concat(F.lit("t-"), F.col("event_id")).alias("transaction_id"),
            F.col("value").alias("transaction_amount"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.lit("realtime").alias("inference_mode"),
        )
        return conform_log(with_scores(base))

    def by_day(self, rows: DataFrame, name: str) -> str:
        """Folder with ``rows`` (a log) by day and endpoint, written once per application and input folder."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _FOLDERS:
            path = scratch_path(self.spark, name)
            write_table(rows.withColumn("request_date", F.to_date("request_timestamp")), path, "append", ["request_date", "endpoint_name"])
            _FOLDERS[key] = path
        return _FOLDERS[key]

    @cached_property
    def log(self) -> DataFrame:
        """The prediction log as ingest stores it: by day and endpoint."""
        return self.spark.read.parquet(self.by_day(self.pred, "log"))

    @cached_property
    def labelled_log(self) -> DataFrame:
        """The same with the labels known by the reference time."""
        return self.spark.read.parquet(self.by_day(self.lpred, "labelled-log"))

    @cached_property
    def upd(self) -> DataFrame:
        """Label feed; purchases get a second, opposite confirmation a day later."""
        truth = ((F.col("event_id") * 7919) % 1000 + (F.col("event_id") * 104729) % 701) > 850
        lag = (1 + F.col("event_id") % 30).cast("int")
        first = self.events.select(
            F.col("event_id").cast("string").alias("inference_id"),
            truth.alias("actual_fraud"),
            (F.col("ts") + F.make_dt_interval(lag)).alias("confirmation_timestamp"),
            F.when(F.col("event_type") == "error", "chargeback").otherwise("analyst").alias("confirmation_source"),
            lag.cast("double").alias("days_since_prediction"),
            F.lit("b1").alias("batch_id"),
            "event_type",
        )
        second = first.where(F.col("event_type") == "purchase").select(
            "inference_id",
            (~F.col("actual_fraud")).alias("actual_fraud"),
            (F.col("confirmation_timestamp") + F.make_dt_interval(F.lit(1))).alias("confirmation_timestamp"),
            F.lit("review").alias("confirmation_source"),
            (F.col("days_since_prediction") + 1).alias("days_since_prediction"),
            F.lit("b2").alias("batch_id"),
            "event_type",
        )
        return first.unionByName(second).drop("event_type")

    @cached_property
    def known(self) -> DataFrame:
        """Confirmations that have arrived by the reference time."""
        return labels.recent_updates(self.upd, AS_OF)

    @cached_property
    def lpred(self) -> DataFrame:
        """Prediction log after the label merge."""
        return labels.merge_labels(self.pred, self.known)

    @cached_property
    def labelled(self) -> DataFrame:
        return self.lpred.where("ground_truth is not null")

    @cached_property
    def base_side(self) -> DataFrame:
        return self.lineitem.where(F.col("l_shipdate") < c.as_of_literal(SIDE_CUT))

    @cached_property
    def current_side(self) -> DataFrame:
        """Later shipments, with quantity drifted by ten percent."""
        rows = self.lineitem.where(F.col("l_shipdate") >= c.as_of_literal(SIDE_CUT))
        return rows.withColumn("l_quantity", F.col("l_quantity") * 1.1)

    @cached_property
    def line_sides(self) -> DataFrame:
        return drift.melt_numeric(drift.stack_sides(self.base_side, self.current_side, NUMERIC), NUMERIC, ["is_current"])

    @cached_property
    def line_baseline(self) -> DataFrame:
        """The baseline side of ``line_sides`` by itself."""
        return drift.melt_numeric(self.base_side, NUMERIC)

    @cached_property
    def text_sides(self) -> DataFrame:
        stacked = drift.stack_sides(self.base_side, self.current_side, CATEGORICAL)
        return drift.melt_text(stacked, CATEGORICAL, ["is_current"])

    @cached_property
    def line_rows(self) -> DataFrame:
        """Labelled feature table of line items."""
        return self.lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"),
            *NUMERIC,
            "l_linestatus",
            "l_linenumber",
            (F.col("l_returnflag") == "R").alias("is_returned"),
        )

    @cached_property
    def training(self) -> DataFrame:
        """Training rows of the served model: the first week of events."""
        truth = ((F.col("event_id") * 7919) % 1000 + (F.col("event_id") * 104729) % 701) > 850
        return self.event_features.where(F.col("ts") < c.as_of_literal(BASE_END)).select(
            F.concat(F.lit("t-"), F.col("event_id")).alias("transaction_id"),
            "transaction_amount", "transaction_hour", "k",
            F.col("event_type").alias("channel"),
            truth.alias("is_fraud"),
        )

    def _runs(self) -> DataFrame:
        day = F.to_date("ts").alias("day")
        endpoint = F.when(F.col("event_type").isin("click", "view"), "ep-a").otherwise("ep-b").alias("endpoint_name")
        keys = ["day", "endpoint_name"]
        served = self.event_features.select(day, endpoint, *TREND_FEATURES)
        base = self.event_features.where(F.col("ts") < c.as_of_literal(BASE_END))
        by_version = quality.ranking_metrics(self.labelled, "ground_truth", "probability_fraud", ["model_version"]).select(
            "model_version", F.col("roc_auc").alias("baseline_roc_auc")
        )
        version = F.when(F.col("day") < F.lit(SWITCH).cast("timestamp_ntz").cast("date"), "v1").otherwise("v2").alias("model_version")
        baselines = served.select(*keys).distinct().select(*keys, version).join(by_version, "model_version", "left")
        labelled = self.labelled.select("*", F.to_date("request_timestamp").alias("day"))
        joined = monitoring_runs(base, served, labelled, TREND_FEATURES, keys, baselines, min_samples=RUN_MINIMUM).select("*", version)
        stamp = F.date_add("day", 1).cast("timestamp_ntz")
        rows = joined.select(
            "*",
            F.concat_ws("-", F.lit("drift"), F.date_format("day", "yyyyMMdd"), "endpoint_name").alias("monitoring_run_id"),
            stamp.alias("monitoring_timestamp"),
            stamp.alias("created_at"),
            F.concat(F.lit("package/"), "model_version").alias("model_package_arn"),
            F.concat(F.lit("eval-"), "model_version").alias("evaluation_snapshot_id"),
            F.concat(F.lit("train-"), "model_version").alias("training_snapshot_id"),
            F.when(F.dayofmonth("day") % 2 == 1, F.col("__scalars")).otherwise(F.col("per_feature_drift_scores")).alias("__scores"),
            F.when(F.col("endpoint_name") == "ep-a", F.concat(F.lit("track-"), F.date_format("day", "yyyyMMdd"))).alias("mlflow_run_id"),
            F.lit(verdict.DETECTION_ENGINE).alias("detection_engine"),
        )
        # Half of the days store plain numbers: both forms of the score map are read back.
        return verdict.conform_verdicts(rows.drop("per_feature_drift_scores").withColumnRenamed("__scores", "per_feature_drift_scores"))

    @cached_property
    def runs(self) -> DataFrame:
        """One verdict per day and endpoint."""
        return stored("runs", self.sf_dir, self._runs)

    @cached_property
    def feat(self) -> DataFrame:
        return lineage.feature_drift_detail(self.runs)

    @cached_property
    def tagged(self) -> DataFrame:
        return lineage.tag_runs(self.lpred, lineage.run_windows(self.runs))

    @cached_property
    def joined(self) -> DataFrame:
        return lineage.runs_with_predictions(self.runs, self.tagged)

    @cached_property
    def acc(self) -> DataFrame:
        return lineage.accuracy_rows(self.pred, self.known, AS_OF)

    @cached_property
    def attributions(self) -> DataFrame:
        """A linear attribution table over line items, with predictions rounded to four digits."""
        phi = {
            "phi_quantity": (F.col("l_quantity") - 25.5) * 0.03,
            "phi_discount": (F.col("l_discount") - 0.05) * 8.0,
            "phi_tax": (F.col("l_tax") - 0.04) * -5.0,
        }
        total = F.lit(-0.3) + sum(phi.values(), F.lit(0.0))
        return self.lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"),
            "l_partkey", "l_quantity", "l_discount", "l_tax",
            *[v.alias(n) for n, v in phi.items()],
            F.lit(-0.3).alias("base_value"),
            F.round(1 / (1 + F.exp(-total)), 3).alias("prediction"),
        )


# -- the same tables in SQL -----------------------------------------------------------------------

SQL_TABLES = {
    "ef": """
        SELECT *, value AS transaction_amount, CAST(hour(ts) AS DOUBLE) AS transaction_hour,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
               CAST(list_position(['click','error','purchase','signup','view'], event_type) - 1 AS DOUBLE) AS channel
        FROM events""",
    "pred0": f"""
        SELECT CAST(event_id AS VARCHAR) AS inference_id, ts AS request_timestamp,
               CASE WHEN event_type IN ('click','view') THEN 'ep-a' ELSE 'ep-b' END AS endpoint_name,
               CASE WHEN ts < TIMESTAMP '{SWITCH}' OR user_id % 10 = 0 THEN 'v1' ELSE 'v2' END AS model_version,
               CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000 AS probability_fraud,
               CASE WHEN (event_id * 7919) % 1000 >= 500 THEN 1 ELSE 0 END AS prediction,
               value AS inference_latency_ms, 't-' || event_id AS transaction_id, value AS transaction_amount,
               CAST(user_id AS VARCHAR) AS customer_id, user_id, event_type, event_id
        FROM events""",
    "pred": """
        SELECT *, 'run-' || model_version AS mlflow_run_id, 1 - probability_fraud AS probability_non_fraud,
               greatest(probability_fraud, 1 - probability_fraud) AS confidence_score,
               greatest(probability_fraud, 1 - probability_fraud) > 0.9 AS is_high_confidence,
               greatest(probability_fraud, 1 - probability_fraud) BETWEEN 0.4 AND 0.6 AS is_low_confidence,
               CASE WHEN probability_fraud < 0.2 THEN 'very_low' WHEN probability_fraud < 0.4 THEN 'low'
                    WHEN probability_fraud < 0.6 THEN 'medium' WHEN probability_fraud < 0.8 THEN 'high'
                    ELSE 'very_high' END AS prediction_bucket
        FROM pred0""",
    "upd1": """
        SELECT CAST(event_id AS VARCHAR) AS inference_id,
               ((event_id * 7919) % 1000 + (event_id * 104729) % 701) > 850 AS actual_fraud,
               ts + to_days(CAST(1 + event_id % 30 AS INTEGER)) AS confirmation_timestamp,
               CASE WHEN event_type = 'error' THEN 'chargeback' ELSE 'analyst' END AS confirmation_source,
               CAST(1 + event_id % 30 AS DOUBLE) AS days_since_prediction, 'b1' AS batch_id, event_type
        FROM events""",
    "upd": """
        SELECT inference_id, actual_fraud, confirmation_timestamp, confirmation_source, days_since_prediction, batch_id
        FROM upd1
        UNION ALL
        SELECT inference_id, NOT actual_fraud, confirmation_timestamp + to_days(1), 'review',
               days_since_prediction + 1, 'b2'
        FROM upd1 WHERE event_type = 'purchase'""",
    "known": f"SELECT * FROM upd WHERE confirmation_timestamp <= TIMESTAMP '{AS_OF}'",
    "lab": """
        SELECT inference_id, CAST(actual_fraud AS INTEGER) AS ground_truth,
               confirmation_timestamp AS ground_truth_timestamp, confirmation_source AS ground_truth_source,
               days_since_prediction AS days_to_ground_truth
        FROM (SELECT *, row_number() OVER (PARTITION BY inference_id
                                           ORDER BY confirmation_timestamp DESC, batch_id DESC) AS rn FROM known)
        WHERE rn = 1""",
    "lpred": "SELECT * FROM pred LEFT JOIN lab USING (inference_id)",
    "labelled": "SELECT * FROM lpred WHERE ground_truth IS NOT NULL",
    "base_side": f"SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SIDE_CUT}'",
    "current_side": f"""
        SELECT * REPLACE (l_quantity * 1.1 AS l_quantity) FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SIDE_CUT}'""",
    "both_sides": """
        SELECT *, 0 AS is_current FROM base_side UNION ALL SELECT *, 1 AS is_current FROM current_side""",
    "line_sides": "\n        UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS value, is_current FROM both_sides" for f in NUMERIC
    ),
    "text_sides": "\n        UNION ALL ".join(
        f"SELECT '{f}' AS feature, lower({f}) AS category, is_current FROM both_sides" for f in CATEGORICAL
    ),
    "side_values": """
        SELECT feature, value, sum(1 - is_current) AS a, sum(is_current) AS b FROM line_sides GROUP BY ALL""",
    "side_prefix": """
        SELECT *, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa,
               sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb,
               lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
        FROM side_values WINDOW w AS (PARTITION BY feature ORDER BY value)""",
    "side_edges": """
        SELECT feature, quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges
        FROM line_sides WHERE is_current = 0 GROUP BY feature""",
    "side_bins": """
        SELECT feature, len(list_filter(edges, lambda e: value >= e)) AS bin, sum(a) AS a, sum(b) AS b
        FROM side_values JOIN side_edges USING (feature) GROUP BY ALL""",
    "side_shares": """
        SELECT feature, bin, CASE WHEN a = 0 THEN 0.0001 ELSE a / sum(a) OVER (PARTITION BY feature) END AS p,
               CASE WHEN b = 0 THEN 0.0001 ELSE b / sum(b) OVER (PARTITION BY feature) END AS q
        FROM side_bins""",
    "cat_counts": """
        SELECT feature, category, sum(1 - is_current) AS a, sum(is_current) AS b FROM text_sides
        WHERE category IS NOT NULL GROUP BY ALL""",
    "cat_shares": """
        SELECT *, sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb FROM cat_counts""",
    "line_rows": """
        SELECT l_orderkey || '-' || l_linenumber AS row_id, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
               l_linenumber, l_returnflag = 'R' AS is_returned
        FROM lineitem""",
    "training": f"""
        SELECT 't-' || event_id AS transaction_id, transaction_amount, transaction_hour, k, event_type AS channel,
               ((event_id * 7919) % 1000 + (event_id * 104729) % 701) > 850 AS is_fraud
        FROM ef WHERE ts < TIMESTAMP '{BASE_END}'""",
    # kernel of the ranking metrics over all labelled predictions
    "score_counts": """
        SELECT probability_fraud AS s, sum(ground_truth) AS pos, sum(1 - ground_truth) AS neg FROM labelled GROUP BY 1""",
    "score_prefix": """
        SELECT s, pos, neg, sum(pos) OVER () AS pt, sum(neg) OVER () AS nt,
               sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
               coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM score_counts""",
    # runs
    "flong": """
        SELECT CAST(ts AS DATE) AS day, CASE WHEN event_type IN ('click','view') THEN 'ep-a' ELSE 'ep-b' END AS endpoint_name,
               unnest([{'feature': 'transaction_amount', 'value': transaction_amount},
                       {'feature': 'transaction_hour', 'value': transaction_hour},
                       {'feature': 'k', 'value': k}], recursive := true), ts
        FROM ef""",
    "fedges": f"""
        SELECT feature, quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges
        FROM flong WHERE ts < TIMESTAMP '{BASE_END}' GROUP BY feature""",
    "fbase": f"""
        SELECT feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS a
        FROM flong JOIN fedges USING (feature) WHERE ts < TIMESTAMP '{BASE_END}' GROUP BY ALL""",
    "fcur": """
        SELECT day, endpoint_name, feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS b
        FROM flong JOIN fedges USING (feature) GROUP BY ALL""",
    "fgrid": """
        SELECT g.day, g.endpoint_name, g.feature, x.bin, coalesce(a, 0) AS a, coalesce(b, 0) AS b
        FROM (SELECT DISTINCT day, endpoint_name, feature FROM fcur) g
        JOIN (SELECT feature, bin FROM fbase UNION SELECT feature, bin FROM fcur) x USING (feature)
        LEFT JOIN fbase ON fbase.feature = g.feature AND fbase.bin = x.bin
        LEFT JOIN fcur ON fcur.day = g.day AND fcur.endpoint_name = g.endpoint_name AND fcur.feature = g.feature
                      AND fcur.bin = x.bin
        WHERE a IS NOT NULL OR b IS NOT NULL""",
    "fshares": """
        SELECT day, endpoint_name, feature,
               CASE WHEN a = 0 THEN 0.0001 ELSE a / sum(a) OVER w END AS p,
               CASE WHEN b = 0 THEN 0.0001 ELSE b / sum(b) OVER w END AS q, sum(b) OVER w AS n
        FROM fgrid WINDOW w AS (PARTITION BY day, endpoint_name, feature)""",
    "fpsi": """
        SELECT day, endpoint_name, feature, sum((q - p) * ln(q / p)) AS psi, max(n) AS n FROM fshares GROUP BY ALL""",
    "rdata": """
        SELECT day, endpoint_name, count(*) AS features_analyzed, sum(CASE WHEN psi > 0.1 THEN 1 ELSE 0 END) AS drifted,
               max(n) AS data_sample_size FROM fpsi GROUP BY ALL""",
    "rscore": """
        SELECT CAST(request_timestamp AS DATE) AS day, endpoint_name, probability_fraud AS s, sum(ground_truth) AS pos,
               sum(1 - ground_truth) AS neg FROM labelled GROUP BY ALL""",
    "rauc": """
        SELECT day, endpoint_name, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
               THEN sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) END AS auc
        FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY day, endpoint_name ORDER BY s
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM rscore)
        GROUP BY ALL""",
    "vscore": """
        SELECT model_version, probability_fraud AS s, sum(ground_truth) AS pos, sum(1 - ground_truth) AS neg
        FROM labelled GROUP BY ALL""",
    "vauc": """
        SELECT model_version, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
               THEN sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) END AS baseline_auc
        FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_version ORDER BY s
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM vscore)
        GROUP BY ALL""",
    "rconf": """
        SELECT CAST(request_timestamp AS DATE) AS day, endpoint_name, count(*) AS n,
               sum(CASE WHEN prediction = 1 AND ground_truth = 1 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN prediction = 0 AND ground_truth = 0 THEN 1 ELSE 0 END) AS tn,
               sum(CASE WHEN prediction = 1 AND ground_truth = 0 THEN 1 ELSE 0 END) AS fp,
               sum(CASE WHEN prediction = 0 AND ground_truth = 1 THEN 1 ELSE 0 END) AS fn
        FROM labelled GROUP BY ALL""",
    "runs0": f"""
        SELECT rdata.day, rdata.endpoint_name,
               'drift-' || strftime(rdata.day, '%Y%m%d') || '-' || rdata.endpoint_name AS monitoring_run_id,
               CAST(rdata.day + INTERVAL 1 DAY AS TIMESTAMP) AS monitoring_timestamp,
               CASE WHEN rdata.day < DATE '{SWITCH[:10]}' THEN 'v1' ELSE 'v2' END AS model_version,
               CAST(features_analyzed AS INTEGER) AS features_analyzed, CAST(drifted AS INTEGER) AS drifted_columns_count,
               CAST(drifted AS DOUBLE) / features_analyzed AS drifted_columns_share,
               CAST(data_sample_size AS INTEGER) AS data_sample_size, auc AS current_roc_auc,
               CAST(coalesce(n, 0) AS INTEGER) AS model_sample_size,
               CAST(tp + tn AS DOUBLE) / n AS accuracy,
               CASE WHEN n > 0 THEN coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) END AS "precision",
               CASE WHEN n > 0 THEN coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) END AS recall,
               CASE WHEN n > 0 THEN coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) END AS f1_score
        FROM rdata LEFT JOIN rconf USING (day, endpoint_name) LEFT JOIN rauc USING (day, endpoint_name)""",
    "runs": f"""
        SELECT runs0.*, 'package/' || model_version AS model_package_arn, 'eval-' || model_version AS evaluation_snapshot_id,
               'train-' || model_version AS training_snapshot_id, drifted_columns_share >= 0.5 AND data_sample_size >= {RUN_MINIMUM} AS data_drift_detected,
               baseline_auc AS baseline_roc_auc, baseline_auc - current_roc_auc AS roc_auc_degradation,
               (baseline_auc - current_roc_auc) / baseline_auc * 100 AS roc_auc_degradation_pct,
               coalesce((baseline_auc - current_roc_auc) / baseline_auc * 100 >= 5, false) AND model_sample_size >= {RUN_MINIMUM} AS model_drift_detected,
               (drifted_columns_share >= 0.5 AND data_sample_size >= {RUN_MINIMUM})
                 OR (coalesce((baseline_auc - current_roc_auc) / baseline_auc * 100 >= 5, false) AND model_sample_size >= {RUN_MINIMUM}) AS alert_sent,
               CASE WHEN endpoint_name = 'ep-a' THEN 'track-' || strftime(day, '%Y%m%d') END AS mlflow_run_id,
               CASE WHEN drifted_columns_share > 0.3 THEN 'HIGH' WHEN drifted_columns_share > 0.15 THEN 'MEDIUM'
                    ELSE 'LOW' END AS drift_severity,
               CASE WHEN current_roc_auc >= 0.95 THEN 'GOOD' WHEN current_roc_auc >= 0.90 THEN 'WARNING'
                    ELSE 'CRITICAL' END AS performance_status
        FROM runs0 LEFT JOIN vauc USING (model_version)""",
    "feat": """
        SELECT r.*, feature AS feature_name, psi AS drift_score,
               CASE WHEN day(p.day) % 2 = 1 THEN psi ELSE psi / 0.1 END AS drift_magnitude,
               CASE WHEN day(p.day) % 2 = 1 THEN NULL ELSE 'PSI' END AS drift_method,
               CASE WHEN day(p.day) % 2 = 1 THEN NULL ELSE 0.1 END AS drift_threshold,
               CASE WHEN CASE WHEN day(p.day) % 2 = 1 THEN psi ELSE psi / 0.1 END > 2.5 THEN 'Significant'
                    WHEN CASE WHEN day(p.day) % 2 = 1 THEN psi ELSE psi / 0.1 END > 1.0 THEN 'Moderate'
                    ELSE 'Low' END AS feature_severity,
               CASE WHEN day(p.day) % 2 = 1 THEN psi ELSE psi / 0.1 END > 1.0 AS drift_detected
        FROM fpsi p JOIN runs r USING (day, endpoint_name)""",
    "tagged": """
        SELECT lpred.*, r.monitoring_run_id FROM lpred
        LEFT JOIN (SELECT endpoint_name AS ep, monitoring_run_id, monitoring_timestamp AS hi,
                          lag(monitoring_timestamp) OVER (PARTITION BY endpoint_name ORDER BY monitoring_timestamp) AS lo
                   FROM runs) r
          ON r.ep = lpred.endpoint_name AND request_timestamp <= r.hi AND (r.lo IS NULL OR request_timestamp > r.lo)""",
    "per_run": """
        SELECT monitoring_run_id, count(DISTINCT inference_id) AS inference_count, avg(probability_fraud) AS avg_fraud_prob,
               count(ground_truth) AS gt_count, min(request_timestamp) AS window_start, max(request_timestamp) AS window_end
        FROM tagged WHERE monitoring_run_id IS NOT NULL GROUP BY 1""",
    "joined": """
        SELECT runs.*, coalesce(inference_count, 0) AS inference_count, avg_fraud_prob, coalesce(gt_count, 0) AS gt_count,
               window_start, window_end
        FROM runs LEFT JOIN per_run USING (monitoring_run_id)""",
    "acc": f"""
        SELECT CAST(request_timestamp AS DATE) AS inference_date, pred.inference_id, endpoint_name, model_version,
               prediction AS predicted_fraud, CAST(actual_fraud AS INTEGER) AS actual_fraud,
               CASE WHEN prediction = CAST(actual_fraud AS INTEGER) THEN 1 ELSE 0 END AS prediction_match,
               CASE WHEN prediction = 1 AND actual_fraud THEN 'True Positive'
                    WHEN prediction = 0 AND NOT actual_fraud THEN 'True Negative'
                    WHEN prediction = 1 AND NOT actual_fraud THEN 'False Positive'
                    WHEN prediction = 0 AND actual_fraud THEN 'False Negative' ELSE 'Unknown' END AS prediction_category,
               request_timestamp AS prediction_time, confirmation_timestamp AS ground_truth_time, days_since_prediction,
               CASE WHEN prediction = CAST(actual_fraud AS INTEGER) THEN 'Correct' ELSE 'Incorrect' END AS is_correct
        FROM pred JOIN known ON pred.inference_id = known.inference_id
        WHERE request_timestamp >= CAST(DATE '{AS_OF[:10]}' - INTERVAL 30 DAY AS TIMESTAMP)""",
    "attributions": """
        SELECT *, round(1 / (1 + exp(-(-0.3 + phi_quantity + phi_discount + phi_tax))), 3) AS prediction
        FROM (SELECT l_orderkey * 10 + l_linenumber AS row_key, l_partkey, l_quantity, l_discount, l_tax,
                     (l_quantity - 25.5) * 0.03 AS phi_quantity, (l_discount - 0.05) * 8.0 AS phi_discount,
                     (l_tax - 0.04) * -5.0 AS phi_tax, CAST(-0.3 AS DOUBLE) AS base_value
              FROM lineitem)""",
}


def with_tables(body: str) -> str:
    """Prefix ``body`` with the derived tables it mentions, in order."""
    needed: list[str] = []

    def need_table(name: str) -> None:
        if name in needed:
            return
        text = SQL_TABLES[name]
        for other in SQL_TABLES:
            if other != name and re.search(rf"(?:FROM|JOIN|from|join)\s+\(?{other}\b", text):
                need_table(other)
        if name not in needed:
            needed.append(name)

    for name in SQL_TABLES:
        if re.search(rf"(?:FROM|JOIN|from|join)\s+\(?{name}\b", body):
            need_table(name)
    if not needed:
        return body
    order = [n for n in SQL_TABLES if n in needed]
    ctes = ",\n".join(f"{n} AS ({SQL_TABLES[n].strip()})" for n in order)
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
