"""Drift statistics (P1-P9, P14, V4) and the end-to-end drift check."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import drift, grouped_drift, kernel, prep, verdict
from tidewatch.plans import drift_check
from tidewatch_checks.quality_queries import ranking_sql
from tidewatch_checks.registry import check
from tidewatch_checks.tables import AS_OF, CATEGORICAL, NUMERIC, PAYLOAD_SCHEMA, SIDE_CUT, SWITCH, Tables

DISTANCES_SQL = """
    SELECT feature, CAST(sum(a) AS BIGINT) AS n_baseline, CAST(sum(b) AS BIGINT) AS n_current,
           max(abs(fa - fb)) AS ks_statistic,
           sum(abs(fa - fb) * (next_value - value)) / any_value(sd) AS wasserstein
    FROM side_prefix JOIN (SELECT feature, stddev_samp(value) AS sd FROM line_sides WHERE is_current = 0 GROUP BY 1)
         USING (feature)
    GROUP BY feature"""

# Kolmogorov tail as in the operator: theta series below 1, alternating series from 1 on.
KS_P_SQL = """
    CASE WHEN lam <= 0 THEN 1
         WHEN lam < 1 THEN least(1, greatest(0, 1 - sqrt(2 * pi()) / lam *
              (exp(-1 * pi() * pi() / 8 / (lam * lam)) + exp(-9 * pi() * pi() / 8 / (lam * lam))
               + exp(-25 * pi() * pi() / 8 / (lam * lam)) + exp(-49 * pi() * pi() / 8 / (lam * lam)))))
         ELSE least(1, greatest(0, 2 * (exp(-2 * lam * lam) - exp(-8 * lam * lam) + exp(-18 * lam * lam)
              - exp(-32 * lam * lam)))) END"""


@check("p1_psi", "SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM side_shares GROUP BY feature", "psi")
def psi(t: Tables):
    return drift.psi(t.line_sides, baseline=t.line_baseline)


@check(
    "p1_psi_bands",
    """SELECT feature, psi, CASE WHEN psi > 0.25 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'none' END AS band
       FROM (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM side_shares GROUP BY feature)""",
    "psi",
)
def psi_bands(t: Tables):
    from tidewatch.functions.columns import psi_band

    return drift.psi(t.line_sides, baseline=t.line_baseline).withColumn("band", psi_band("psi"))


@check(
    "p1_decile_edges",
    """SELECT feature, unnest(edges) AS edge, generate_subscripts(edges, 1) AS position FROM side_edges""",
    "edge",
)
def decile_edges(t: Tables):
    edges = drift.decile_edges(t.line_baseline)
    return edges.select("feature", F.posexplode("edges").alias("p", "edge")).select(
        "feature", "edge", (F.col("p") + 1).cast("bigint").alias("position")
    )


@check(
    "p2_kolmogorov_smirnov",
    f"""SELECT feature, n_baseline, n_current, ks_statistic, {KS_P_SQL} AS ks_p_value
        FROM (SELECT *, sqrt(n_baseline::DOUBLE * n_current / (n_baseline + n_current)) * ks_statistic AS lam
              FROM ({DISTANCES_SQL}))""",
    "ks_statistic ks_p_value",
)
def kolmogorov_smirnov(t: Tables):
    return drift.numeric_distances(t.line_sides).drop("wasserstein")


@check("p3_wasserstein_normed", f"SELECT feature, wasserstein FROM ({DISTANCES_SQL})", "wasserstein")
def wasserstein(t: Tables):
    return drift.numeric_distances(t.line_sides).select("feature", "wasserstein")


@check(
    "p2_with_infinity",
    """WITH s AS (SELECT CASE WHEN l_linenumber = 7 THEN 'Infinity'::DOUBLE WHEN l_linenumber = 6 THEN '-Infinity'::DOUBLE ELSE l_quantity END AS v,
                         CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS c FROM lineitem),
            n AS (SELECT count(*) FILTER (c = 0) AS na, count(*) FILTER (c = 1) AS nb FROM s),
            steps AS (SELECT sum(count(*) FILTER (c = 0)) OVER (ORDER BY v) AS a, sum(count(*) FILTER (c = 1)) OVER (ORDER BY v) AS b FROM s GROUP BY v)
       SELECT 'v' AS feature, any_value(na) AS n_baseline, any_value(nb) AS n_current, max(abs(a / na - b / nb)) AS ks_statistic, true AS no_distance FROM steps, n""",
    "ks_statistic",
)
def with_infinity(t: Tables):
    """Infinite values rank at the ends and leave no finite distance."""
    inf = F.lit(float("inf"))
    value = F.when(F.col("l_linenumber") == 7, inf).when(F.col("l_linenumber") == 6, -inf).otherwise(F.col("l_quantity"))
    side = F.when(F.col("l_shipdate") < F.lit(SIDE_CUT).cast("timestamp_ntz"), 0).otherwise(1)
    rows = t.lineitem.select(F.lit("v").alias("feature"), value.alias("value"), side.alias("is_current"))
    found = drift.numeric_distances(rows)
    return found.select("feature", "n_baseline", "n_current", "ks_statistic", F.col("wasserstein").isNull().alias("no_distance"))


CHI_SQL = """
    SELECT feature, sum(pow(a - (a + b) * na / (na + nb), 2) / ((a + b) * na / (na + nb))
                      + pow(b - (a + b) * nb / (na + nb), 2) / ((a + b) * nb / (na + nb))) AS chi_square,
           count(*) - 1 AS dof
    FROM (SELECT feature, a::DOUBLE AS a, b::DOUBLE AS b, na::DOUBLE AS na, nb::DOUBLE AS nb FROM cat_shares) GROUP BY feature"""


@check("p4_chi_square", CHI_SQL, "chi_square")
def chi_square(t: Tables):
    return drift.categorical_distances(t.text_sides).select("feature", "chi_square", "dof")


@check(
    "p4_chi_square_p_value",
    f"""SELECT feature, 1 - list_sum(list_transform(range(0, 300),
               lambda i: exp((dof / 2.0::DOUBLE + i) * ln(chi_square / 2) - chi_square / 2 - lgamma(dof / 2.0::DOUBLE + i + 1)))) AS chi_square_p_value
        FROM ({CHI_SQL})""",
    "chi_square_p_value",
)
def chi_square_p(t: Tables):
    return drift.categorical_distances(t.text_sides).select("feature", "chi_square_p_value")


JS_SQL = """
    SELECT feature, sqrt(greatest(0, sum(CASE WHEN a > 0 THEN p * ln(p / ((p + q) / 2)) / 2 ELSE 0 END
                                       + CASE WHEN b > 0 THEN q * ln(q / ((p + q) / 2)) / 2 ELSE 0 END))) AS jensen_shannon
    FROM (SELECT feature, a, b, a / na AS p, b / nb AS q FROM cat_shares) GROUP BY feature"""


@check("p5_jensen_shannon", JS_SQL, "jensen_shannon")
def jensen_shannon(t: Tables):
    return drift.categorical_distances(t.text_sides).select("feature", "jensen_shannon")


VERDICTS_SQL = f"""
    SELECT *, score > threshold AS drifted, score / threshold AS drift_magnitude
    FROM (SELECT feature, wasserstein AS score, 'Wasserstein distance (normed)' AS "method", 0.1 AS threshold FROM ({DISTANCES_SQL})
          UNION ALL
          SELECT feature, jensen_shannon, 'Jensen-Shannon distance', 0.1 FROM ({JS_SQL}))"""


def _line_verdicts(t: Tables):
    return drift.feature_drift(t.base_side, t.current_side, NUMERIC, CATEGORICAL)


@check(
    "p6_test_selection",
    f"""SELECT feature, CASE WHEN n >= 1000 THEN "method" WHEN "method" LIKE 'Wass%' THEN 'K-S p_value' ELSE 'chi-square p_value' END AS "method",
               CASE WHEN n >= 1000 THEN 0.1 ELSE 0.05 END AS threshold
        FROM ({VERDICTS_SQL}) CROSS JOIN (SELECT count(*) AS n FROM base_side)""",
    "threshold",
)
def test_selection(t: Tables):
    return _line_verdicts(t).select("feature", "method", "threshold")


@check(
    "p7_column_verdicts",
    f"""SELECT feature, score AS drift_score, "method", threshold, drifted, drift_magnitude, false AS magnitude_capped FROM ({VERDICTS_SQL})""",
    "drift_score threshold drift_magnitude",
)
def column_verdicts(t: Tables):
    return _line_verdicts(t)


@check(
    "p8_dataset_verdict",
    f"""SELECT features_analyzed, drifted_columns_count, drifted_columns_count / features_analyzed AS drifted_columns_share,
               drifted_columns_count / features_analyzed >= 0.5 AS data_drift_detected
        FROM (SELECT count(*) AS features_analyzed, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS drifted_columns_count
              FROM ({VERDICTS_SQL}))""",
    "drifted_columns_share",
)
def dataset_verdict(t: Tables):
    return drift.dataset_verdict(_line_verdicts(t))


@check(
    "p9_top_drifted",
    f"""SELECT feature, drift_magnitude FROM ({VERDICTS_SQL}) ORDER BY drift_magnitude DESC, feature LIMIT 5""",
    "drift_magnitude",
)
def top_drifted(t: Tables):
    return drift.top_drifted(_line_verdicts(t), 5, only_drifted=False).select("feature", "drift_magnitude")


@check(
    "p14_binned_divergences",
    """SELECT feature, sum((q - p) * ln(q / p)) AS psi, sum(q * ln(q / p)) AS kl_div,
              sqrt(greatest(0, sum(p * ln(p / ((p + q) / 2)) / 2 + q * ln(q / ((p + q) / 2)) / 2))) AS jensen_shannon
       FROM side_shares GROUP BY feature""",
    "psi kl_div jensen_shannon",
)
def binned_divergences(t: Tables):
    return drift.binned_divergences(t.line_sides)


@check(
    "p14_explicit_kl_test",
    """SELECT feature, kl AS drift_score, 'Kullback-Leibler divergence' AS "method", CAST(0.01 AS DOUBLE) AS threshold,
              kl > 0.01 AS drifted, kl / 0.01 AS drift_magnitude, false AS magnitude_capped
       FROM (SELECT feature, sum(q * ln(q / p)) AS kl FROM side_shares GROUP BY feature)""",
    "drift_score threshold drift_magnitude",
)
def explicit_kl(t: Tables):
    return drift.explicit_test(t.base_side, t.current_side, NUMERIC, "kl_div", 0.01)


@check(
    "v4_custom_drift_test",
    """SELECT feature, s AS drift_score, 'mean shift (normed)' AS "method", CAST(0.1 AS DOUBLE) AS threshold, s > 0.1 AS drifted,
              s / 0.1 AS drift_magnitude, false AS magnitude_capped
       FROM (SELECT feature, abs(avg(value) FILTER (is_current = 1) - avg(value) FILTER (is_current = 0))
                    / stddev_samp(value) FILTER (is_current = 0) AS s FROM line_sides GROUP BY feature)""",
    "drift_score threshold drift_magnitude",
)
def custom_test(t: Tables):
    def mean_shift(sides):
        side = lambda s: F.when(F.col("is_current") == s, F.col("value"))
        return sides.groupBy("feature").agg(
            (F.abs(F.avg(side(1)) - F.avg(side(0))) / F.stddev(side(0))).alias("drift_score")
        )

    drift.register_test("mean_shift", drift.DriftTest("mean shift (normed)", "numeric", mean_shift, 0.1))
    return drift.explicit_test(t.base_side, t.current_side, NUMERIC, "mean_shift")


@check(
    "w2_ordered_prefix",
    """SELECT feature, value, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b,
              CAST(coalesce(sum(a) OVER p, 0) AS BIGINT) AS a_below, CAST(coalesce(sum(b) OVER p, 0) AS BIGINT) AS b_below,
              CAST(sum(a) OVER (PARTITION BY feature) AS BIGINT) AS a_total, CAST(sum(b) OVER (PARTITION BY feature) AS BIGINT) AS b_total,
              lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
       FROM side_values
       WINDOW p AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "value next_value",
)
def ordered_prefix(t: Tables):
    weights = {"a": 1 - F.col("is_current"), "b": F.col("is_current")}
    collapsed = kernel.collapse(t.line_sides, ["feature"], "value", weights)
    return kernel.ordered_prefix(collapsed, ["feature"], ["a", "b"]).drop("min_value")


PERIOD_SQL = """SELECT day, endpoint_name, feature, psi, CAST(n AS BIGINT) AS n_current FROM fpsi"""


@check("p1_psi_by_period", PERIOD_SQL, "psi")
def period_psi(t: Tables):
    from tidewatch_checks.tables import BASE_END, TREND_FEATURES

    day = F.to_date("ts").alias("day")
    endpoint = F.when(F.col("event_type").isin("click", "view"), "ep-a").otherwise("ep-b").alias("endpoint_name")
    base = t.event_features.where(F.col("ts") < F.lit(BASE_END).cast("timestamp_ntz"))
    served = t.event_features.select(day, endpoint, *TREND_FEATURES)
    return drift.period_psi(base, served, TREND_FEATURES, ["day", "endpoint_name"])


# -- end to end -----------------------------------------------------------------------------------

CHECK_SIDES = f"""
    SELECT f.feature, f.value, is_current FROM (
        SELECT unnest([{{'feature': 'transaction_amount', 'value': transaction_amount}},
                       {{'feature': 'transaction_hour', 'value': transaction_hour}},
                       {{'feature': 'k', 'value': k}}, {{'feature': 'channel', 'value': channel}}]) AS f, is_current
        FROM (SELECT transaction_amount, transaction_hour, k, channel, 0 AS is_current FROM ef WHERE ts < TIMESTAMP '2024-01-08'
              UNION ALL
              SELECT transaction_amount, transaction_hour, k, channel, 1 FROM ef
              WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{AS_OF}' AND event_type IN ('click','view')))"""

CHECK_SQL = f"""
    SELECT feature, max(na) AS n_baseline, max(abs(fa - fb)) AS d, sum(abs(fa - fb) * (next_value - value)) / max(sd) AS w,
           sqrt(max(na) * max(nb) / (max(na) + max(nb))) * max(abs(fa - fb)) AS lam
    FROM (SELECT *, sum(a) OVER w / na AS fa, sum(b) OVER w / nb AS fb, lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
          FROM (SELECT *, sum(a) OVER (PARTITION BY feature)::DOUBLE AS na, sum(b) OVER (PARTITION BY feature)::DOUBLE AS nb
                FROM (SELECT feature, value, sum(1 - is_current) AS a, sum(is_current) AS b FROM sides GROUP BY ALL))
          WINDOW w AS (PARTITION BY feature ORDER BY value))
    JOIN (SELECT feature, stddev_samp(value) AS sd FROM sides WHERE is_current = 0 GROUP BY 1) USING (feature)
    GROUP BY feature"""

CHECK_VERDICTS = f"""
    SELECT feature, CASE WHEN n_baseline < 1000 THEN p ELSE w END AS drift_score,
           CASE WHEN n_baseline < 1000 THEN 'K-S p_value' ELSE 'Wasserstein distance (normed)' END AS "method",
           CASE WHEN n_baseline < 1000 THEN 0.05 ELSE 0.1 END AS threshold,
           CASE WHEN n_baseline < 1000 THEN p < 0.05 ELSE w > 0.1 END AS drifted,
           CASE WHEN n_baseline < 1000 THEN least(1e9, coalesce(0.05 / nullif(p, 0), 1e9)) ELSE w / 0.1 END AS drift_magnitude
    FROM (SELECT *, {KS_P_SQL} AS p FROM ({CHECK_SQL}))"""


RUN_ROWS = f"""(SELECT * FROM labelled WHERE request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND request_timestamp <= TIMESTAMP '{AS_OF}'
                  AND endpoint_name = 'ep-a')"""


def _encoders(t: Tables) -> prep.Encoders:
    return prep.fit_encoders(t.training, ["channel"])


@check(
    "p10_feature_check",
    f"""SELECT * FROM (WITH sides AS ({CHECK_SIDES}) {CHECK_VERDICTS})""",
    "drift_score threshold drift_magnitude",
)
def feature_check(t: Tables):
    return drift_check.feature_verdicts(
        t.pred, t.training, PAYLOAD_SCHEMA, _encoders(t), AS_OF, 7, "ep-a"
    ).drop("magnitude_capped")


@check(
    "p10_data_drift_check",
    f"""SELECT count(*) AS features_analyzed, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS drifted_columns_count,
               sum(CASE WHEN drifted THEN 1 ELSE 0 END) / count(*) AS drifted_columns_share,
               sum(CASE WHEN drifted THEN 1 ELSE 0 END) / count(*) >= 0.5 AND any_value(n) >= 100 AS data_drift_detected,
               any_value(n) AS logged_rows, any_value(n) AS data_sample_size,
               CASE WHEN any_value(n) >= 100 THEN 'ok' ELSE 'insufficient_samples' END AS data_status
        FROM (WITH sides AS ({CHECK_SIDES}) {CHECK_VERDICTS})
        CROSS JOIN (SELECT count(*) AS n FROM pred WHERE endpoint_name = 'ep-a' AND request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
                    AND request_timestamp <= TIMESTAMP '{AS_OF}')""",
    "drifted_columns_share",
)
def data_drift(t: Tables):
    summary, _ = drift_check.data_drift_check(t.pred, t.training, PAYLOAD_SCHEMA, _encoders(t), AS_OF, 7, "ep-a")
    return summary


def shown_scores(scores: str = "per_feature_drift_scores"):
    """The score map as text, feature by feature in name order, with rounded numbers: JSON texts of two engines differ in digits."""
    plain = F.from_json(scores, "map<string,double>")
    full = F.from_json(scores, "map<string,struct<score:double,magnitude:double,method:string,threshold:double>>")
    shown = F.expr(
        """array_join(transform(array_sort(map_keys(full)), k -> concat(k, '=', format_string('%.5f', full[k].score), '/', format_string('%.4f', full[k].magnitude), '/',
           full[k].method, '/', format_string('%.2f', full[k].threshold))), ',')"""
    )
    bare = F.expr("array_join(transform(array_sort(map_keys(plain)), k -> concat(k, '=', format_string('%.5f', plain[k]))), ',')")
    return plain.alias("plain"), full.alias("full"), F.when(F.col(scores).contains("{\"score\""), shown).otherwise(bare).alias(scores)


def with_shown_scores(runs):
    plain, full, shown = shown_scores()
    columns = [c if c != "per_feature_drift_scores" else shown for c in runs.columns]
    wide = runs.select("*", F.when(F.col("per_feature_drift_scores").contains("{\"score\""), None).otherwise(plain).alias("plain"), full)
    return wide.select(*columns)


RUN_DOUBLES = "drifted_columns_share baseline_roc_auc current_roc_auc roc_auc_degradation roc_auc_degradation_pct accuracy precision recall f1_score"


@check(
    "p11_monitoring_record",
    """SELECT monitoring_run_id, monitoring_timestamp, endpoint_name, model_version, model_package_arn, evaluation_snapshot_id,
              training_snapshot_id, data_drift_detected, drifted_columns_count, drifted_columns_share, features_analyzed,
              data_sample_size, model_drift_detected, baseline_roc_auc, current_roc_auc, roc_auc_degradation,
              roc_auc_degradation_pct, accuracy, "precision", recall, f1_score, model_sample_size, scores AS per_feature_drift_scores,
              CAST(NULL AS VARCHAR) AS evidently_report_s3_path, mlflow_run_id, alert_sent, 'spark' AS detection_engine,
              monitoring_timestamp AS created_at
       FROM runs JOIN (SELECT day, endpoint_name, string_agg(CASE WHEN day(day) % 2 = 1 THEN printf('%s=%.5f', feature, psi)
                              ELSE printf('%s=%.5f/%.4f/PSI/0.10', feature, psi, psi / 0.1) END, ',' ORDER BY feature) AS scores FROM fpsi GROUP BY ALL) USING (day, endpoint_name)""",
    RUN_DOUBLES,
)
def monitoring_record(t: Tables):
    """All columns of the stored runs; the score maps are shown as text, in both of their forms."""
    return with_shown_scores(t.runs)


CHECK_AUC = """(0.92 - m.roc_auc) / 0.92 * 100"""


@check(
    "p11_monitoring_run",
    f"""SELECT 'drift-20240131-000000-ep-a' AS monitoring_run_id, TIMESTAMP '{AS_OF}' AS monitoring_timestamp, 'ep-a' AS endpoint_name, 'v2' AS model_version,
               CAST(NULL AS VARCHAR) AS model_package_arn, CAST(NULL AS VARCHAR) AS evaluation_snapshot_id, 'train-v2' AS training_snapshot_id,
               d.drifted / d.features >= 0.5 AND d.n >= 100 AS data_drift_detected, d.drifted::INTEGER AS drifted_columns_count,
               d.drifted / d.features AS drifted_columns_share, d.features::INTEGER AS features_analyzed, d.n::INTEGER AS data_sample_size,
               {CHECK_AUC} >= 5 AND m.samples >= 100 AS model_drift_detected, CAST(0.92 AS DOUBLE) AS baseline_roc_auc, m.roc_auc AS current_roc_auc,
               0.92 - m.roc_auc AS roc_auc_degradation, {CHECK_AUC} AS roc_auc_degradation_pct, (tp + tn) / c.n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
               coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score, m.samples::INTEGER AS model_sample_size,
               d.scores AS per_feature_drift_scores, CAST(NULL AS VARCHAR) AS evidently_report_s3_path, CAST(NULL AS VARCHAR) AS mlflow_run_id,
               (d.drifted / d.features >= 0.5 AND d.n >= 100) OR ({CHECK_AUC} >= 5 AND m.samples >= 100) AS alert_sent, 'spark' AS detection_engine, TIMESTAMP '{AS_OF}' AS created_at
        FROM (SELECT count(*) AS features, sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS drifted, any_value(n) AS n,
                     string_agg(printf('%s=%.5f/%.4f/%s/%.2f', feature, drift_score, drift_magnitude, method, threshold), ',' ORDER BY feature) AS scores
              FROM (WITH sides AS ({CHECK_SIDES}) {CHECK_VERDICTS})
              CROSS JOIN (SELECT count(*) AS n FROM pred WHERE endpoint_name = 'ep-a' AND request_timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
                          AND request_timestamp <= TIMESTAMP '{AS_OF}')) d
        CROSS JOIN (SELECT roc_auc, positive_samples + negative_samples AS samples FROM ({ranking_sql(RUN_ROWS)})) m
        CROSS JOIN (SELECT count(*) AS n, count(*) FILTER (prediction = 1 AND ground_truth = 1) AS tp, count(*) FILTER (prediction = 0 AND ground_truth = 0) AS tn,
                           count(*) FILTER (prediction = 1 AND ground_truth = 0) AS fp, count(*) FILTER (prediction = 0 AND ground_truth = 1) AS fn FROM {RUN_ROWS}) c""",
    RUN_DOUBLES,
)
def monitoring_run(t: Tables):
    run = drift_check.monitoring_run(
        t.log, t.labelled_log.where("ground_truth is not null"), t.training, PAYLOAD_SCHEMA, _encoders(t), AS_OF, "ep-a", "v2",
        {"training_snapshot_id": "train-v2"}, baseline_auc=0.92,
    )
    return with_shown_scores(run)


# Every endpoint and day against the first week, with all tests; ``channel`` is compared as text.
GROUP_SIDES = """
    gbase AS (SELECT f.feature, f.value FROM (SELECT unnest([{'feature': 'transaction_amount', 'value': transaction_amount}, {'feature': 'transaction_hour', 'value': transaction_hour},
                                                             {'feature': 'k', 'value': k}]) AS f FROM ef WHERE ts < TIMESTAMP '2024-01-08')),
    gcur AS (SELECT day, endpoint_name, feature, value FROM flong),
    gboth AS (SELECT g.day, g.endpoint_name, g.feature, value, 1 AS a, 0 AS b FROM (SELECT DISTINCT day, endpoint_name, feature FROM gcur) g JOIN gbase USING (feature)
              UNION ALL SELECT *, 0, 1 FROM gcur),
    gnum AS (SELECT day, endpoint_name, feature, max(na) AS n_baseline, max(nb) AS n_current, max(abs(fa - fb)) AS d, sum(abs(fa - fb) * (next_value - value)) AS w
             FROM (SELECT *, sum(a) OVER w / na AS fa, sum(b) OVER w / nb AS fb, lead(value) OVER (PARTITION BY day, endpoint_name, feature ORDER BY value) AS next_value
                   FROM (SELECT *, sum(a) OVER p::DOUBLE AS na, sum(b) OVER p::DOUBLE AS nb FROM (SELECT day, endpoint_name, feature, value, sum(a) AS a, sum(b) AS b FROM gboth GROUP BY ALL)
                         WINDOW p AS (PARTITION BY day, endpoint_name, feature))
                   WINDOW w AS (PARTITION BY day, endpoint_name, feature ORDER BY value)) GROUP BY ALL),
    gnumeric AS (SELECT day, endpoint_name, feature, n_baseline::BIGINT AS n_baseline, n_current::BIGINT AS n_current, d AS ks_statistic, sqrt(n_baseline * n_current / (n_baseline + n_current)) * d AS lam,
                        w / sd AS wasserstein FROM gnum JOIN (SELECT feature, stddev_samp(value) AS sd FROM gbase GROUP BY 1) USING (feature)),
    tbase AS (SELECT channel AS category, count(*) AS a FROM (SELECT event_type AS channel FROM ef WHERE ts < TIMESTAMP '2024-01-08') GROUP BY 1),
    tcur AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_type IN ('click','view') THEN 'ep-a' ELSE 'ep-b' END AS endpoint_name, event_type AS category, count(*) AS b FROM ef GROUP BY ALL),
    tgrid AS (SELECT g.day, g.endpoint_name, c.category, coalesce(a, 0)::DOUBLE AS a, coalesce(b, 0)::DOUBLE AS b FROM (SELECT DISTINCT day, endpoint_name FROM tcur) g
              CROSS JOIN (SELECT category FROM tbase) c LEFT JOIN tbase USING (category) LEFT JOIN tcur ON tcur.day = g.day AND tcur.endpoint_name = g.endpoint_name AND tcur.category = c.category),
    tsum AS (SELECT *, sum(a) OVER p AS na, sum(b) OVER p AS nb FROM tgrid WINDOW p AS (PARTITION BY day, endpoint_name)),
    tdist AS (SELECT day, endpoint_name, 'channel' AS feature, any_value(na)::BIGINT AS n_baseline, any_value(nb)::BIGINT AS n_current,
                     sum((a - (a + b) * na / (na + nb)) ** 2 / ((a + b) * na / (na + nb)) + (b - (a + b) * nb / (na + nb)) ** 2 / ((a + b) * nb / (na + nb))) AS chi_square, (count(*) - 1)::BIGINT AS dof,
                     sqrt(greatest(0, sum(CASE WHEN a > 0 THEN a / na * ln(a / na / ((a / na + b / nb) / 2)) / 2 ELSE 0 END + CASE WHEN b > 0 THEN b / nb * ln(b / nb / ((a / na + b / nb) / 2)) / 2 ELSE 0 END))) AS jensen_shannon
              FROM tsum GROUP BY ALL)"""


def grouped_sides(t: Tables):
    """(baseline, served) with the features of the served model and the channel as text, by day and endpoint."""
    endpoint = F.when(F.col("event_type").isin("click", "view"), "ep-a").otherwise("ep-b").alias("endpoint_name")
    features = ["transaction_amount", "transaction_hour", "k", F.col("event_type").alias("channel")]
    rows = t.event_features
    return rows.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")).select(*features), rows.select(F.to_date("ts").alias("day"), endpoint, *features)


@check(
    "p10_grouped_numeric",
    f"""SELECT * FROM (WITH {GROUP_SIDES.lstrip()} SELECT day, endpoint_name, feature, n_baseline, n_current, ks_statistic, {KS_P_SQL} AS ks_p_value, wasserstein
        FROM (SELECT *, ks_statistic AS d FROM gnumeric))""",
    "ks_statistic ks_p_value wasserstein",
)
def grouped_numeric(t: Tables):
    """KS and Wasserstein of every day, endpoint and feature; the baseline is read once."""
    base, served = grouped_sides(t)
    keys = ["day", "endpoint_name"]
    numeric = ["transaction_amount", "transaction_hour", "k"]
    return grouped_drift.grouped_distances(drift.melt_numeric(base, numeric), drift.melt_numeric(served, numeric, keys), keys)


@check(
    "p10_grouped_categories",
    f"""SELECT * FROM (WITH {GROUP_SIDES.lstrip()} SELECT day, endpoint_name, feature, n_baseline, n_current, chi_square, dof, jensen_shannon FROM tdist)""",
    "chi_square jensen_shannon",
)
def grouped_categories(t: Tables):
    """Chi-square and Jensen-Shannon of every day and endpoint; what an endpoint never serves counts, too."""
    base, served = grouped_sides(t)
    keys = ["day", "endpoint_name"]
    found = grouped_drift.grouped_categories(drift.melt_text(base, ["channel"]), drift.melt_text(served, ["channel"], keys), keys)
    return found.drop("chi_square_p_value").withColumn("dof", F.col("dof").cast("long"))


@check(
    "p11_grouped_runs",
    f"""SELECT * FROM (WITH {GROUP_SIDES.lstrip()},
        scored AS (SELECT day, endpoint_name, feature, wasserstein AS score, 'Wasserstein distance (normed)' AS "method", 0.1 AS threshold, wasserstein > 0.1 AS drifted, least(1e9, wasserstein / 0.1) AS magnitude FROM gnumeric
                   UNION ALL SELECT day, endpoint_name, feature, jensen_shannon, 'Jensen-Shannon distance', 0.1, jensen_shannon > 0.1, jensen_shannon / 0.1 FROM tdist),
        data AS (SELECT day, endpoint_name, count(*) AS features, count(*) FILTER (drifted) AS drifted,
                        string_agg(printf('%s=%.5f/%.4f/%s/%.2f', feature, score, magnitude, method, threshold), ',' ORDER BY feature) AS scores FROM scored GROUP BY ALL),
        served AS (SELECT CAST(request_timestamp AS DATE) AS day, endpoint_name, count(*) AS n FROM pred GROUP BY ALL),
        checked AS (SELECT s.day, s.endpoint_name, s.n, features, drifted, scores, drifted / features >= 0.5 AND s.n >= 30 AS data_drift, auc, baseline_auc, (baseline_auc - auc) / baseline_auc * 100 AS pct, coalesce(c.n, 0) AS labelled,
                           CASE WHEN s.day < DATE '{SWITCH[:10]}' THEN 'v1' ELSE 'v2' END AS model_version, tp, tn, fp, fn
                    FROM served s JOIN data USING (day, endpoint_name) LEFT JOIN rconf c USING (day, endpoint_name) LEFT JOIN rauc USING (day, endpoint_name) CROSS JOIN (SELECT 0.55 AS baseline_auc))
        SELECT 'drift-' || strftime(day + INTERVAL 1 DAY, '%Y%m%d-%H%M%S') || '-' || endpoint_name AS monitoring_run_id, CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS monitoring_timestamp, endpoint_name, model_version,
               'package/' || model_version AS model_package_arn, CAST(NULL AS VARCHAR) AS evaluation_snapshot_id, CAST(NULL AS VARCHAR) AS training_snapshot_id, data_drift AS data_drift_detected,
               drifted::INTEGER AS drifted_columns_count, drifted / features AS drifted_columns_share, features::INTEGER AS features_analyzed, n::INTEGER AS data_sample_size,
               coalesce(pct >= 5, false) AND labelled >= 30 AS model_drift_detected, CAST(baseline_auc AS DOUBLE) AS baseline_roc_auc, auc AS current_roc_auc, baseline_auc - auc AS roc_auc_degradation, pct AS roc_auc_degradation_pct,
               (tp + tn) / labelled AS accuracy, CASE WHEN labelled > 0 THEN coalesce(tp / nullif(tp + fp, 0), 0) END AS "precision", CASE WHEN labelled > 0 THEN coalesce(tp / nullif(tp + fn, 0), 0) END AS recall,
               CASE WHEN labelled > 0 THEN coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) END AS f1_score, labelled::INTEGER AS model_sample_size, scores AS per_feature_drift_scores,
               CAST(NULL AS VARCHAR) AS evidently_report_s3_path, CAST(NULL AS VARCHAR) AS mlflow_run_id, data_drift OR (coalesce(pct >= 5, false) AND labelled >= 30) AS alert_sent, 'spark' AS detection_engine,
               CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS created_at FROM checked)""",
    RUN_DOUBLES,
)
def grouped_runs(t: Tables):
    """A verdict row, all columns, for every day and endpoint: numeric and text features, tests by type and size, small groups not judged."""
    base, served = grouped_sides(t)
    keys = ["day", "endpoint_name"]
    labelled = t.labelled.select("*", F.to_date("request_timestamp").alias("day"))
    known = served.select(*keys).distinct().withColumn("baseline_roc_auc", F.lit(0.55))
    checked = drift_check.monitoring_runs(
        base, served, labelled, ["transaction_amount", "transaction_hour", "k"], keys, known, min_samples=30, categorical=["channel"], test="auto",
        small_sample=0,  # the distances at any size of the given tables; the p-value tests are compared above
    )
    version = F.when(F.col("day") < F.lit(SWITCH[:10]).cast("date"), "v1").otherwise("v2")
    return with_shown_scores(drift_check.run_records(checked, F.date_add("day", 1), version, {"model_package_arn": F.concat(F.lit("package/"), version)}))


@check(
    "p12_alerts",
    """WITH top AS (SELECT monitoring_run_id, list(feature_name ORDER BY drift_magnitude DESC, feature_name)[:5] AS names,
                           list(drift_score ORDER BY drift_magnitude DESC, feature_name)[:5] AS scores FROM feat WHERE drift_detected GROUP BY 1),
            raised AS (SELECT monitoring_run_id, monitoring_timestamp AS check_timestamp, endpoint_name, 'DATA_DRIFT_DETECTED' AS alert_type,
                  drift_severity AS severity, drifted_columns_share AS drift_share,
                  printf('Data drift: %d of %d features drifted (share %.3f)', drifted_columns_count, features_analyzed, drifted_columns_share) AS message,
                  'Investigate data pipeline or consider model retraining' AS recommended_action, names, scores
           FROM runs LEFT JOIN top USING (monitoring_run_id) WHERE data_drift_detected
           UNION ALL
           SELECT monitoring_run_id, monitoring_timestamp, endpoint_name, 'MODEL_DRIFT_DETECTED', 'HIGH', drifted_columns_share,
                  printf('Model drift: ROC-AUC %.4f against baseline %.4f (degradation %.1f%%)', current_roc_auc, baseline_roc_auc, roc_auc_degradation_pct),
                  'Compare with the registered baseline and consider retraining', names, scores
           FROM runs LEFT JOIN top USING (monitoring_run_id) WHERE model_drift_detected)
       SELECT monitoring_run_id, check_timestamp, endpoint_name, alert_type, severity, drift_share, message, recommended_action,
              CASE WHEN alert_type = 'DATA_DRIFT_DETECTED' THEN array_to_string(names, ',') END AS drifted_features,
              concat_ws('|', alert_type, severity, endpoint_name, strftime(check_timestamp, '%Y-%m-%dT%H:%M:%S'), printf('%.4f', drift_share),
                        nullif(array_to_string(list_transform(list_zip(names, scores), lambda z: printf('%s=%.5f', z[1], z[2])), ','), ''), message, recommended_action) AS payload
       FROM raised""",
    "drift_share",
)
def alerts(t: Tables):
    """Alerts with their whole payload; its parts are shown joined, with rounded numbers."""
    rows = verdict.alerts(t.runs, t.feat)
    kind = "alert_type string, severity string, endpoint_name string, check_timestamp string, drift_share double, drifted_features array<struct<feature:string,score:double>>, message string, recommended_action string"
    p = rows.withColumn("p", F.from_json("payload", kind))
    top = F.array_join(F.transform("p.drifted_features", lambda s: F.concat(s["feature"], F.lit("="), F.format_string("%.5f", s["score"]))), ",")
    shown = F.concat_ws(
        "|", "p.alert_type", "p.severity", "p.endpoint_name", F.substring("p.check_timestamp", 1, 19), F.format_string("%.4f", "p.drift_share"), top, "p.message", "p.recommended_action"
    )
    return p.withColumn("payload", shown).withColumn("drifted_features", F.array_join("drifted_features", ",")).drop("p")


@check(
    "p13_run_metrics",
    """SELECT monitoring_run_id, metric, value FROM (
         SELECT monitoring_run_id, unnest([
           {'metric': 'data_drift_detected', 'value': data_drift_detected::INT::DOUBLE}, {'metric': 'features_analyzed', 'value': features_analyzed::DOUBLE},
           {'metric': 'drifted_columns_count', 'value': drifted_columns_count::DOUBLE}, {'metric': 'drifted_columns_share', 'value': drifted_columns_share},
           {'metric': 'data_sample_size', 'value': data_sample_size::DOUBLE}, {'metric': 'model_drift_detected', 'value': model_drift_detected::INT::DOUBLE},
           {'metric': 'baseline_roc_auc', 'value': baseline_roc_auc}, {'metric': 'current_roc_auc', 'value': current_roc_auc},
           {'metric': 'roc_auc_degradation', 'value': roc_auc_degradation}, {'metric': 'roc_auc_degradation_pct', 'value': roc_auc_degradation_pct},
           {'metric': 'accuracy', 'value': accuracy}, {'metric': 'precision', 'value': "precision"}, {'metric': 'recall', 'value': recall},
           {'metric': 'f1_score', 'value': f1_score}, {'metric': 'model_sample_size', 'value': model_sample_size::DOUBLE}], recursive := true)
         FROM runs
         UNION ALL SELECT monitoring_run_id, 'drift_score_' || feature_name, drift_score FROM feat)
       WHERE value IS NOT NULL""",
    "value",
)
def run_metrics(t: Tables):
    return verdict.run_metrics(t.runs, t.feat)
