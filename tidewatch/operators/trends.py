"""Trend queries: each is one group-by over runs, runs with predictions, features or accuracy rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import (
    bucket_start,
    performance_status,
    run_severity,
    score_bucket,
)
from tidewatch.functions.stats import safe_ratio
from tidewatch.operators.kernel import exact_quantiles, join_on
from tidewatch.operators.ops import histogram

DAY = "day"


def day_of(ts: str) -> Column:
    return bucket_start("day", ts).alias(DAY)


def labelled_runs(runs: DataFrame) -> DataFrame:
    """Runs with their severity and performance status."""
    return runs.select(
        "*",
        run_severity("drifted_columns_share").alias("drift_severity"),
        performance_status("current_roc_auc").alias("performance_status"),
    )


def _run_trend(runs: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    return runs.groupBy(day_of("monitoring_timestamp"), *keys).agg(*measures)


def _rate(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int"))


# -- model quality over time ----------------------------------------------------------------------


def auc_baseline_vs_current(runs: DataFrame) -> DataFrame:
    return _run_trend(
        runs, [], F.avg("baseline_roc_auc").alias("avg_baseline_roc_auc"), F.avg("current_roc_auc").alias("avg_current_roc_auc")
    )


def quality_over_time(runs: DataFrame) -> DataFrame:
    return _run_trend(runs, [], *[F.avg(c).alias(f"avg_{c}") for c in ("accuracy", "precision", "recall", "f1_score")])


def auc_by_version(runs: DataFrame) -> DataFrame:
    return _run_trend(runs, ["model_version"], F.avg("current_roc_auc").alias("avg_current_roc_auc"))


def verdict_rate(runs: DataFrame, by: str) -> DataFrame:
    return runs.groupBy(by).agg(_rate("model_drift_detected").alias("model_drift_rate"))


def by_training_snapshot(runs: DataFrame) -> DataFrame:
    return runs.groupBy("training_snapshot_id").agg(
        F.avg("current_roc_auc").alias("avg_roc_auc"),
        F.avg("accuracy").alias("avg_accuracy"),
        _rate("model_drift_detected").alias("model_drift_rate"),
        F.count("monitoring_run_id").alias("runs"),
    )


def lineage_audit(runs: DataFrame) -> DataFrame:
    return runs.groupBy(
        bucket_start("minute", "monitoring_timestamp").alias("minute"),
        "monitoring_run_id", "endpoint_name", "model_version", "model_package_arn", "training_snapshot_id",
        "evaluation_snapshot_id", "data_drift_detected", "model_drift_detected",
    ).agg(F.avg("current_roc_auc").alias("avg_roc_auc"))


def latest_kpi(runs: DataFrame, measure: str, agg=F.avg) -> DataFrame:
    """One row: value of the latest day, of the day before it in the data, and the change."""
    daily = _run_trend(runs, [], agg(measure).alias("value")).where("value is not null")
    # Two newest days only: a top-n, not a sort of the history.
    two = daily.orderBy(F.desc(DAY)).limit(2)
    pair = two.agg(
        F.max(DAY).alias("latest_day"),
        F.max_by("value", DAY).alias("latest"),
        F.when(F.count("*") > 1, F.min_by("value", DAY)).alias("previous"),
    )
    return pair.withColumn("change", F.col("latest") - F.col("previous"))


def confusion_over_time(rows: DataFrame) -> DataFrame:
    """day x category counts, one column per category."""
    names = {
        "True Positive": "true_positive", "True Negative": "true_negative",
        "False Positive": "false_positive", "False Negative": "false_negative",
    }
    wide = rows.groupBy(F.col("inference_date").alias(DAY)).pivot("prediction_category", list(names)).agg(F.count(F.lit(1)))
    return wide.withColumnsRenamed(names).fillna(0, list(names.values()))


def degradation_over_time(runs: DataFrame) -> DataFrame:
    return _run_trend(runs, ["model_version"], F.avg("roc_auc_degradation_pct").alias("avg_degradation_pct"))


def coverage_over_time(joined: DataFrame) -> DataFrame:
    totals = _run_trend(joined, [], F.sum("gt_count").alias("gt_count"), F.sum("inference_count").alias("inference_count"))
    return totals.withColumn("coverage", safe_ratio(F.col("gt_count"), F.col("inference_count")))


def latency_over_time(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy(day_of("request_timestamp")).agg(
        F.avg("inference_latency_ms").alias("avg_latency_ms"), F.max("inference_latency_ms").alias("max_latency_ms")
    )


# -- data drift over time -------------------------------------------------------------------------


def share_over_time(runs: DataFrame) -> DataFrame:
    return _run_trend(runs, [], F.avg("drifted_columns_share").alias("avg_share"))


def count_over_time(runs: DataFrame) -> DataFrame:
    return _run_trend(runs, [], F.avg("drifted_columns_count").alias("avg_count"))


def alerts_by_severity(runs: DataFrame) -> DataFrame:
    return _run_trend(labelled_runs(runs), ["drift_severity"], F.sum(F.col("alert_sent").cast("int")).alias("alerts"))


def share_by(runs: DataFrame, key: str) -> DataFrame:
    return _run_trend(runs, [key], F.avg("drifted_columns_share").alias("avg_share"))


def volume_vs_share(joined: DataFrame) -> DataFrame:
    return _run_trend(
        joined, [], F.sum("inference_count").alias("inference_count"), F.avg("drifted_columns_share").alias("avg_share")
    )


def verdict_rows(runs: DataFrame) -> DataFrame:
    return labelled_runs(runs).groupBy(
        bucket_start("minute", "monitoring_timestamp").alias("minute"),
        "monitoring_run_id", "endpoint_name", "model_version", "drift_severity", "data_drift_detected",
    ).agg(
        F.avg("drifted_columns_share").alias("avg_share"),
        F.avg("drifted_columns_count").alias("avg_count"),
        F.avg("features_analyzed").alias("avg_features_analyzed"),
        F.avg("data_sample_size").alias("avg_sample_size"),
    )


def score_box_plot(details: DataFrame) -> DataFrame:
    """day -> minimum, quartiles and maximum of the per-feature scores."""
    rows = details.select(day_of("monitoring_timestamp"), "drift_score").where("drift_score is not null")
    q = exact_quantiles(rows, [DAY], "drift_score", [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ("min_score", "q1_score", "median_score", "q3_score", "max_score")
    return q.select(DAY, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])


def sample_reliability(runs: DataFrame, minimum: int = 1000) -> DataFrame:
    out = _run_trend(runs, ["model_version"], F.avg("data_sample_size").alias("avg_sample_size"))
    return out.withColumn("below_minimum", F.col("avg_sample_size") < minimum)


# -- features -------------------------------------------------------------------------------------


def _feature_trend(details: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    return details.groupBy(day_of("monitoring_timestamp"), *keys).agg(*measures)


def feature_timeline(details: DataFrame) -> DataFrame:
    return _feature_trend(
        details, ["feature_name"],
        F.avg("drift_score").alias("avg_score"), F.avg("drift_magnitude").alias("avg_magnitude"),
    )


def top_features(details: DataFrame, k: int = 15) -> DataFrame:
    means = details.groupBy("feature_name").agg(F.avg("drift_score").alias("avg_score"))
    return means.orderBy(F.desc("avg_score"), "feature_name").limit(k)


def severity_mix(details: DataFrame) -> DataFrame:
    return details.groupBy("feature_name", "drift_severity").agg(F.count("*").alias("n"))


def feature_by_day(details: DataFrame) -> DataFrame:
    """Long heatmap (feature, day) -> avg; :func:`wide` turns it into a table for a fixed day list."""
    return _feature_trend(details, ["feature_name"], F.avg("drift_score").alias("avg_score"))


def wide(long: DataFrame, rows: str, columns: str, value: str, names: list) -> DataFrame:
    return long.groupBy(rows).pivot(columns, names).agg(F.max(value))


def feature_detail_rows(details: DataFrame) -> DataFrame:
    return details.groupBy(
        bucket_start("minute", "monitoring_timestamp").alias("minute"), "feature_name", "drift_severity", "model_version"
    ).agg(F.avg("drift_score").alias("avg_score"))


def highest_score(details: DataFrame) -> DataFrame:
    return _feature_trend(details, [], F.max("drift_score").alias("max_score"))


def feature_by_version(details: DataFrame, versions: list[str]) -> DataFrame:
    return details.groupBy("feature_name").pivot("model_version", versions).agg(F.avg("drift_score"))


def worst_per_run(details: DataFrame) -> DataFrame:
    return _feature_trend(details, ["model_version"], F.max("drift_score").alias("max_score"))


def repeat_offenders(details: DataFrame) -> DataFrame:
    return details.groupBy("feature_name").agg(F.sum(F.col("drift_detected").cast("int")).alias("times_flagged"))


def raw_scores(details: DataFrame, p_values: bool) -> DataFrame:
    """Mean raw score per day and feature of the p-value tests, or of the distances, with its line."""
    is_p = F.col("drift_method").contains("p_value")
    rows = details.where(is_p if p_values else F.col("drift_method").isNotNull() & ~is_p)
    out = _feature_trend(rows, ["feature_name"], F.avg("drift_score").alias("avg_score"))
    return out.withColumn("reference_line", F.lit(0.05 if p_values else 0.1))


# -- ad-hoc analyses ------------------------------------------------------------------------------


def drift_stability(details: DataFrame) -> DataFrame:
    """Mean and population variance of magnitude: high mean with low variance is systematic drift."""
    stats = details.groupBy("feature_name").agg(
        F.avg("drift_magnitude").alias("avg_magnitude"), F.var_pop("drift_magnitude").alias("var_magnitude")
    )
    mean, var = F.col("avg_magnitude"), F.col("var_magnitude")
    kind = F.when(mean <= 1.0, F.when(var > mean, "sporadic").otherwise("stable")).when(
        var > mean * mean, "sporadic"
    ).otherwise("systematic")
    return stats.withColumn("pattern", kind)


def top_features_by_day(details: DataFrame, joined: DataFrame, k: int = 5, line: float = 1.0, many: int = 3) -> DataFrame:
    """Daily mean magnitude of the k most drifted features, with the day's volume and a busy-day flag."""
    best = details.groupBy("feature_name").agg(F.avg("drift_magnitude").alias("m")).orderBy(F.desc("m"), "feature_name").limit(k)
    daily = _feature_trend(details, ["feature_name"], F.avg("drift_magnitude").alias("avg_magnitude"))
    over = daily.groupBy(DAY).agg(F.count_if(F.col("avg_magnitude") > line).alias("features_over"))
    volume = _run_trend(joined, [], F.sum("inference_count").alias("inference_count"))
    picked = daily.join(F.broadcast(best.select("feature_name")), "feature_name", "left_semi")
    return picked.join(over, DAY).join(volume, DAY).withColumn("busy_day", F.col("features_over") > many)


def recent(df: DataFrame, ts: str, as_of: datetime | str, days: int) -> DataFrame:
    start = F.date_sub(F.lit(str(as_of)).cast("date"), days).cast("timestamp_ntz")
    return df.where(F.col(ts) >= start)


def version_slopes(runs: DataFrame) -> DataFrame:
    """Linear trend of the drifted share per version (share per day)."""
    day_number = F.unix_date(F.to_date("monitoring_timestamp")).cast("double")
    return runs.groupBy("model_version").agg(
        F.avg("drifted_columns_share").alias("avg_share"),
        F.regr_slope(F.col("drifted_columns_share"), day_number).alias("slope_per_day"),
        F.count("*").alias("runs"),
    )


def worst_auc_days(runs: DataFrame, k: int = 5) -> DataFrame:
    daily = auc_baseline_vs_current(runs).where("avg_current_roc_auc is not null")
    return (
        daily.orderBy("avg_current_roc_auc", DAY)
        .limit(k)
        .withColumn("above_baseline", F.col("avg_current_roc_auc") >= F.col("avg_baseline_roc_auc"))
    )


def bucket_shift(predictions: DataFrame, sides: Column, limit_points: float = 10.0) -> DataFrame:
    """Score-bucket shares of 'baseline' and 'current' rows and the change in percentage points."""
    rows = predictions.select(score_bucket("probability_fraud").alias("bucket"), sides.alias("side")).where("side is not null")
    counts = rows.groupBy("bucket").agg(
        F.count_if(F.col("side") == "baseline").alias("a"), F.count_if(F.col("side") == "current").alias("b")
    )
    totals = counts.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    shares = counts.crossJoin(F.broadcast(totals)).select(
        "bucket",
        (safe_ratio(F.col("a"), F.col("na")) * 100).alias("baseline_pct"),
        (safe_ratio(F.col("b"), F.col("nb")) * 100).alias("current_pct"),
    )
    change = F.col("current_pct") - F.col("baseline_pct")
    return shares.select("*", change.alias("change_points"), (F.abs(change) > limit_points).alias("flagged"))


def daily_coverage(labelled: DataFrame, low: float = 0.2) -> DataFrame:
    """Label coverage and accuracy per prediction day, with a low-coverage flag."""
    has = F.col("ground_truth").isNotNull()
    out = labelled.groupBy(day_of("request_timestamp")).agg(
        F.count("*").alias("predictions"),
        F.count_if(has).alias("labelled"),
        F.avg(F.when(has, (F.col("prediction") == F.col("ground_truth")).cast("int"))).alias("accuracy"),
    )
    coverage = safe_ratio(F.col("labelled"), F.col("predictions"))
    return out.select("*", (coverage * 100).alias("coverage_pct"), (coverage < low).alias("low_coverage"))


def distribution_comparison(sides: DataFrame, value: str, lower: float, upper: float, bins: int = 20) -> DataFrame:
    """Histogram shares of both sides over shared edges; bins more than twice as frequent are flagged."""
    counts = histogram(sides, value, lower, upper, bins, ["is_current"])
    per_bin = counts.groupBy("bin", "bin_start").agg(
        F.sum(F.when(F.col("is_current") == 0, F.col("n")).otherwise(0)).alias("baseline_n"),
        F.sum(F.when(F.col("is_current") == 1, F.col("n")).otherwise(0)).alias("current_n"),
    )
    totals = per_bin.agg(F.sum("baseline_n").alias("na"), F.sum("current_n").alias("nb"))
    shares = per_bin.crossJoin(F.broadcast(totals)).select(
        "bin", "bin_start", "baseline_n", "current_n",
        safe_ratio(F.col("baseline_n"), F.col("na")).alias("baseline_share"),
        safe_ratio(F.col("current_n"), F.col("nb")).alias("current_share"),
    )
    return shares.withColumn("over_represented", F.col("current_share") > 2 * F.col("baseline_share"))


def side_summary(sides: DataFrame, value: str) -> DataFrame:
    """(is_current, n, mean, median, stddev)."""
    stats = sides.groupBy("is_current").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev(value).alias("stddev")
    )
    median = exact_quantiles(sides, ["is_current"], value, [0.5]).select(
        "is_current", F.col("quantiles")[0].alias("median")
    )
    return join_on(stats, median, ["is_current"])


def offender_bands(details: DataFrame) -> DataFrame:
    n = F.col("times_flagged")
    return repeat_offenders(details).withColumn(
        "band", F.when(n >= 6, "6+").when(n >= 3, "3-5").otherwise("0-2")
    )


def volume_drift_outliers(joined: DataFrame, z: float = 2.0) -> DataFrame:
    """Daily volume against drifted share: fitted line, residual and outlier flag."""
    daily = volume_vs_share(joined)
    x, y = F.col("inference_count").cast("double"), F.col("avg_share")
    fit = daily.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        # NULL, not an error, where volume or share does not vary.
        (F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))).alias("correlation"),
        F.avg(x).alias("mean_volume"),
        F.stddev(y).alias("std_share"),
    )
    residual = y - (F.col("slope") * x + F.col("intercept"))
    out = daily.crossJoin(F.broadcast(fit)).withColumn("residual", residual)
    kind = F.when(F.abs(F.col("residual")) > z * F.col("std_share"), F.when(x < F.col("mean_volume"), "low_volume_drift").otherwise("high_volume_drift"))
    return out.select(DAY, "inference_count", "avg_share", "slope", "intercept", "correlation", "residual", kind.alias("outlier"))


def drift_by_version(details: DataFrame, joined: DataFrame) -> DataFrame:
    """Mean score per version and severity, with the version's volume."""
    scores = details.groupBy("model_version", "drift_severity").agg(
        F.avg("drift_score").alias("avg_score"), F.count("*").alias("n")
    )
    volume = joined.groupBy("model_version").agg(F.sum("inference_count").alias("inference_count"))
    return join_on(scores, volume, ["model_version"])


def drift_timeline(runs: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    return recent(runs, "monitoring_timestamp", as_of, days).select(
        day_of("monitoring_timestamp"), "endpoint_name", "drifted_columns_count", "drifted_columns_share"
    ).orderBy(DAY, "endpoint_name")


def daily_accuracy(labelled: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    rows = recent(labelled.where(F.col("ground_truth").isNotNull()), "request_timestamp", as_of, days)
    return rows.groupBy(day_of("request_timestamp")).agg(
        F.count("*").alias("predictions"),
        F.avg((F.col("prediction") == F.col("ground_truth")).cast("int")).alias("accuracy"),
    )
