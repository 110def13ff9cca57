"""The two scheduled checks and the verdict they end in, as lazily composed DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.operators import drift, grouped_drift, labels, prep, quality, sampling, verdict, windows
from tidewatch.operators.kernel import join_on

MIN_SAMPLES = 100
DEFAULT_BASELINE_AUC = 0.92


def current_window(
    predictions: DataFrame, as_of: datetime | str, lookback_days: int, endpoint: str | None = None
) -> DataFrame:
    return windows.last(predictions, "request_timestamp", as_of, endpoint, days=lookback_days)


def feature_verdicts(
    predictions: DataFrame,
    baseline: DataFrame,
    schema: FeatureSchema,
    encoders: prep.Encoders,
    as_of: datetime | str,
    lookback_days: int = 7,
    endpoint: str | None = None,
    baseline_cap: int | None = None,
    current_cap: int | None = None,
    small_sample: int = 1000,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Per-feature verdicts of the logged payloads against the labelled training rows.

    All rows by default; caps take a deterministic hash sample of the baseline (keyed by the
    identifier) and of the current window (keyed by inference_id).
    """
    window = current_window(predictions, as_of, lookback_days, endpoint)
    if current_cap:
        window = sampling.hash_sample(window, "inference_id", current_cap)
    base = baseline.where(F.col(schema.target).isNotNull())
    if baseline_cap:
        base = sampling.hash_sample(base, schema.identifier, baseline_cap)
    current = prep.payload_features(window, "input_features", schema.feature_names)
    encoded = prep.encode_baseline(base, schema, encoders)
    shared = drift.common_features(encoded, current, schema.feature_names)
    return drift.feature_drift(encoded, current, shared, (), small_sample, thresholds)


def data_drift_check(
    predictions: DataFrame,
    baseline: DataFrame,
    schema: FeatureSchema,
    encoders: prep.Encoders,
    as_of: datetime | str,
    lookback_days: int = 7,
    endpoint: str | None = None,
    min_samples: int = MIN_SAMPLES,
    drift_share: float = 0.5,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(one-row summary, per-feature verdicts).

    The summary's ``status`` is ``insufficient_samples`` when the window, or what parses of it, is
    below ``min_samples``; nothing counts as drifted then.
    """
    window = current_window(predictions, as_of, lookback_days, endpoint)
    per_feature = feature_verdicts(predictions, baseline, schema, encoders, as_of, lookback_days, endpoint, **options)
    flagged = prep.payload_features(window, "input_features", schema.feature_names, flag="__valid")
    counted = flagged.agg(F.count("*").alias("logged_rows"), F.count_if("__valid").alias("data_sample_size"))
    enough = (F.col("logged_rows") >= min_samples) & (F.col("data_sample_size") >= min_samples)
    summary = (
        drift.dataset_verdict(per_feature, drift_share)
        .crossJoin(F.broadcast(counted))
        .withColumn("data_drift_detected", F.col("data_drift_detected") & enough)
        .withColumn("data_status", F.when(enough, "ok").otherwise("insufficient_samples"))
    )
    return summary, per_feature


def model_drift_check(
    labelled: DataFrame,
    as_of: datetime | str,
    lookback_days: int = 30,
    endpoint: str | None = None,
    baseline_auc: float | None = None,
    min_samples: int = MIN_SAMPLES,
    limit_pct: float = 5.0,
    baselines: DataFrame | None = None,
) -> DataFrame:
    """One row: current metrics, baseline AUC, degradation, detected.

    ``baselines`` (endpoint_name, roc_auc, from the registry) wins over ``baseline_auc``; without both
    the default applies and ``baseline_source`` says so.
    """
    rows = current_window(labelled, as_of, lookback_days, endpoint).where(F.col("ground_truth").isNotNull())
    metrics = quality.performance_metrics(rows)
    if baselines is not None:
        known = baselines if endpoint is None else baselines.where(F.col("endpoint_name") == endpoint)
        one = known.agg(F.max("roc_auc").alias("__auc"))
        metrics = metrics.crossJoin(F.broadcast(one))
        given = F.col("__auc")
    else:
        given = F.lit(baseline_auc).cast("double")
    fallback = F.lit(DEFAULT_BASELINE_AUC if baseline_auc is None else float(baseline_auc))
    base = F.coalesce(given, fallback)
    enough = F.col("sample_count") >= min_samples
    degraded = verdict.degradation(F.col("baseline_roc_auc"), F.col("current_roc_auc"), limit_pct)
    out = metrics.select(
        base.alias("baseline_roc_auc"),
        F.when(given.isNotNull(), "registered").otherwise("default").alias("baseline_source"),
        F.col("roc_auc").alias("current_roc_auc"),
        "accuracy",
        "precision",
        "recall",
        "f1_score",
        F.col("sample_count").alias("model_sample_size"),
    ).select("*", *degraded)
    enough = F.col("model_sample_size") >= min_samples
    return out.withColumn("model_drift_detected", F.col("model_drift_detected") & enough).withColumn(
        "model_status", F.when(enough, "ok").otherwise("insufficient_samples")
    )


def classification_comparison(baseline: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(degenerate columns, side-by-side class report): the report means nothing while the first has rows.

    ``baseline`` is the evaluation slice; there is no fallback to comparing the window with itself.
    """
    columns = ["ground_truth", "prediction"]
    both = baseline.select(*columns, F.lit("baseline").alias("side")).unionByName(
        current.where("ground_truth is not null").select(*columns, F.lit("current").alias("side"))
    )
    return quality.degenerate_columns(both, columns), quality.compare_sides(both, *columns)


def group_verdicts(
    baseline: DataFrame,
    served: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    groups: Sequence[str],
    test: str = "auto",
    threshold: float = 0.1,
    small_sample: int = 1000,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Per-feature verdicts of every group.

    ``auto`` picks the test by column type and baseline size, as the single check does; ``psi`` compares numeric
    features by PSI with ``threshold``.  A feature without a value in a group has no row there.
    """
    keys = list(groups)
    if test == "auto":
        return grouped_drift.grouped_feature_drift(baseline, served, numeric, categorical, keys, small_sample, thresholds)
    if test != "psi" or categorical:
        raise ValueError("test is auto, or psi for numeric features only")
    psi = drift.period_psi(baseline, served, list(numeric), keys)
    return drift.with_verdict(
        psi.select(
            *keys, "feature", "n_current", F.col("psi").alias("drift_score"), F.lit(drift.PSI).alias("method"),
            F.lit(float(threshold)).alias("threshold"),
        )
    )


def served_counts(served: DataFrame, features: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """(groups, logged_rows, data_sample_size): rows of a group, and those with a value in any feature; NaN is no value."""
    numeric = {f.name for f in served.schema.fields if f.dataType.typeName() in ("double", "float")}
    held = [F.col(f).isNotNull() & (~F.isnan(f) if f in numeric else F.lit(True)) for f in features]
    any_held = reduce(lambda a, b: a | b, held, F.lit(False))
    return served.groupBy(*groups).agg(F.count("*").alias("logged_rows"), F.count_if(any_held).alias("data_sample_size"))


def monitoring_runs(
    baseline: DataFrame,
    served: DataFrame,
    labelled: DataFrame,
    features: Sequence[str],
    groups: Sequence[str],
    baselines: DataFrame,
    threshold: float = 0.1,
    drift_share: float = 0.5,
    limit_pct: float = 5.0,
    min_samples: int = MIN_SAMPLES,
    categorical: Sequence[str] = (),
    test: str = "psi",
    small_sample: int = 1000,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Both checks for every group (day and endpoint, say) in one pass: one row per group that served anything.

    ``served`` holds the groups and the feature values (``features`` numeric, ``categorical`` text), ``labelled`` the groups, truth, prediction
    and score; features are compared with ``baseline`` (see :func:`group_verdicts`).  ``baselines`` (groups,
    ``baseline_roc_auc``) may leave groups out: their degradation is NULL.

    A group below ``min_samples`` rows, or rows with a value, has ``data_status`` ``insufficient_samples`` and no data drift; below
    ``min_samples`` labelled rows ``model_status`` says the same and there is no model drift.  A group without any valid value is a row with
    no feature analysed.  Columns are those of a verdict that the checks fill, ``logged_rows``, both statuses,
    ``per_feature_drift_scores`` as objects and ``__scalars`` as plain numbers.
    """
    keys = list(groups)
    per_feature = group_verdicts(baseline, served, features, categorical, keys, test, threshold, small_sample, thresholds)
    # One entry per feature: bounded by the schema.
    scalars = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "drift_score")))))
    checked = per_feature.groupBy(*keys).agg(
        F.count("*").alias("features_analyzed"),
        F.sum(F.col("drifted").cast("int")).alias("drifted_columns_count"),
        scalars.alias("__scalars"),
    )
    model = quality.performance_metrics(
        labelled.select(*keys, "ground_truth", "prediction", "probability_fraud"), groups=keys
    ).withColumnsRenamed({"roc_auc": "current_roc_auc", "sample_count": "model_sample_size"})
    rows = served_counts(served, [*features, *categorical], keys)
    for part in (checked, verdict.scores_json(per_feature, keys), model, baselines.select(*keys, "baseline_roc_auc")):
        rows = join_on(rows, part, keys, "left")
    none = F.lit(0).cast("long")
    rows = rows.withColumns(
        {c: F.coalesce(c, none) for c in ("features_analyzed", "drifted_columns_count", "model_sample_size")}
    )
    share = F.coalesce(F.col("drifted_columns_count") / F.nullif(F.col("features_analyzed"), none), F.lit(0.0))
    data_enough = (F.col("logged_rows") >= min_samples) & (F.col("data_sample_size") >= min_samples)
    model_enough = F.col("model_sample_size") >= min_samples
    judged = rows.select(
        "*",
        share.alias("drifted_columns_share"),
        ((F.col("features_analyzed") > 0) & (share >= drift_share) & data_enough).alias("data_drift_detected"),
        F.when(data_enough, "ok").otherwise("insufficient_samples").alias("data_status"),
        F.when(model_enough, "ok").otherwise("insufficient_samples").alias("model_status"),
        *verdict.degradation(F.col("baseline_roc_auc"), F.col("current_roc_auc"), limit_pct),
    ).withColumn("model_drift_detected", F.col("model_drift_detected") & model_enough)
    return judged.withColumn("alert_sent", F.col("data_drift_detected") | F.col("model_drift_detected"))


def run_records(
    checked: DataFrame, as_of: Column, model_version: Column, lineage: dict[str, Column] | None = None, engine: str = verdict.DETECTION_ENGINE
) -> DataFrame:
    """Verdict rows, all columns, of :func:`monitoring_runs`: a run per group, named by the time of the check and the endpoint."""
    stamp = as_of.cast("timestamp_ntz")
    return verdict.conform_verdicts(
        checked.select(
            "*",
            F.concat_ws("-", F.lit("drift"), F.date_format(stamp, "yyyyMMdd-HHmmss"), "endpoint_name").alias("monitoring_run_id"),
            stamp.alias("monitoring_timestamp"),
            stamp.alias("created_at"),
            model_version.alias("model_version"),
            F.lit(engine).alias("detection_engine"),
            *[c.alias(n) for n, c in (lineage or {}).items()],
        )
    )


def incremental_check(
    baseline: DataFrame, updates: DataFrame, features: Sequence[str], baselines: DataFrame, **options
) -> Callable[[DataFrame, int], DataFrame]:
    """Both checks over what one drained batch of the log brought, for ``monitor.incremental_runs``.

    The result has a row per endpoint of the batch: ``batch_id``, the span ``window_start`` to ``window_end`` of its
    predictions, and the columns of :func:`monitoring_runs`.  Labels known by then are taken from
    ``updates``.
    """

    def run(batch: DataFrame, batch_id: int) -> DataFrame:
        keys = ["endpoint_name"]
        served = prep.payload_features(batch, "input_features", list(features), keys, flag="__valid")
        # A row whose payload does not parse was served, but says nothing.
        served = served.select(*keys, *[F.when(F.col("__valid"), F.col(f)).alias(f) for f in features])
        labelled = labels.merge_labels(batch, updates).where("ground_truth is not null")
        span = batch.groupBy(*keys).agg(
            F.min("request_timestamp").alias("window_start"), F.max("request_timestamp").alias("window_end")
        )
        checked = monitoring_runs(baseline, served, labelled, features, keys, baselines, **options).drop("__scalars")
        return join_on(span, checked, keys, "left").select(F.lit(batch_id).cast("bigint").alias("batch_id"), "*")

    return run


def monitoring_run(
    predictions: DataFrame,
    labelled: DataFrame,
    baseline: DataFrame,
    schema: FeatureSchema,
    encoders: prep.Encoders,
    as_of: datetime | str,
    endpoint: str,
    model_version: str,
    lineage: dict[str, str | None] | None = None,
    baseline_auc: float | None = None,
    data_lookback_days: int = 7,
    model_lookback_days: int = 30,
    **options,
) -> DataFrame:
    """The complete run: both checks over one endpoint window, one verdict row."""
    summary, per_feature = data_drift_check(
        predictions, baseline, schema, encoders, as_of, data_lookback_days, endpoint, **options
    )
    model = model_drift_check(labelled, as_of, model_lookback_days, endpoint, baseline_auc)
    return verdict.verdict_row(
        summary, verdict.scores_json(per_feature), model, predictions.sparkSession, as_of, endpoint, model_version, lineage
    )
