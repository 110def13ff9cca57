"""Model quality: confusion counts, ranking metrics, curves, windows, alerts, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import bucket_start, predicted
from tidewatch.functions.stats import safe_ratio
from tidewatch.operators.kernel import collapse, join_on, ordered_prefix


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def confusion(df: DataFrame, truth: str, prediction: Column | str, groups: Sequence[str] = ()) -> DataFrame:
    """true/false positives/negatives with the classes fixed to {0, 1}; unlabelled rows drop."""
    t = F.col(truth)
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    labelled = df.where(t.isNotNull()).select(*groups, t.cast("int").alias("__t"), p.cast("int").alias("__p"))
    t, p = F.col("__t"), F.col("__p")
    return labelled.groupBy(*groups).agg(
        F.count("*").alias("sample_count"),
        _count((p == 1) & (t == 1)).alias("true_positives"),
        _count((p == 0) & (t == 0)).alias("true_negatives"),
        _count((p == 1) & (t == 0)).alias("false_positives"),
        _count((p == 0) & (t == 1)).alias("false_negatives"),
    )


def confusion_at_threshold(
    df: DataFrame, truth: str, score: str, threshold: float = 0.5, groups: Sequence[str] = (), min_rows: int = 10
) -> DataFrame:
    """Confusion and rates of ``score >= threshold``; ``status`` tells when there are too few rows."""
    counts = with_rates(confusion(df, truth, predicted(score, threshold), groups))
    enough = F.col("sample_count") >= min_rows
    return counts.withColumn("threshold", F.lit(float(threshold))).withColumn(
        "status", F.when(enough, "ok").otherwise("insufficient_samples")
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add the rates derived from confusion counts; a zero denominator gives 0."""
    tp, tn, fp, fn = (
        F.col(c) for c in ("true_positives", "true_negatives", "false_positives", "false_negatives")
    )
    total = tp + tn + fp + fn
    return counts.select(
        "*",
        safe_ratio(tp + tn, total).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tn, tn + fp).alias("specificity"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        safe_ratio(fp, fp + tn).alias("false_positive_rate"),
        safe_ratio(fn, fn + tp).alias("false_negative_rate"),
        safe_ratio(tp + fn, total).alias("positive_rate"),
        safe_ratio(tp + fp, total).alias("prediction_rate"),
    )


def score_prefix(df: DataFrame, truth: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives, negatives, and how many of each score lower."""
    labelled = df.where(F.col(truth).isNotNull())
    t = F.col(truth).cast("int")
    counted = collapse(labelled, groups, score, {"pos": (t == 1), "neg": (t == 0)})
    return ordered_prefix(counted, groups, ["pos", "neg"])


def _at_or_above() -> tuple[Column, Column]:
    return F.col("pos_total") - F.col("pos_below"), F.col("neg_total") - F.col("neg_below")


def ranking_metrics(df: DataFrame, truth: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """roc_auc (ties count half), pr_auc (trapezoid) and average_precision (step) per group.

    NULL where a class is missing.
    """
    return _ranking(score_prefix(df, truth, score, groups), groups)


def _ranking(pre: DataFrame, groups: Sequence[str]) -> DataFrame:
    pos = F.col("pos").cast("double")
    # Pairs ranked right, doubled so that ties count one: exact integers, whatever the summation order.
    wide = lambda c: c.cast("decimal(19,0)")
    doubled_wins = F.sum(wide(F.col("pos")) * wide(2 * F.col("neg_below") + F.col("neg"))).cast("double")
    positives, negatives = F.nullif(F.col("pos_total").cast("double"), F.lit(0.0)), F.nullif(
        F.col("neg_total").cast("double"), F.lit(0.0)
    )
    tp, fp = _at_or_above()
    tp_next, fp_next = tp - F.col("pos"), fp - F.col("neg")
    here = tp / (tp + fp)
    above = F.coalesce(tp_next / F.nullif(tp_next + fp_next, F.lit(0)), F.lit(1.0))
    both = positives.isNotNull() & negatives.isNotNull()
    pairs = F.max(positives) * F.max(negatives)
    return pre.groupBy(*groups).agg(
        F.max("pos_total").alias("positive_samples"),
        F.max("neg_total").alias("negative_samples"),
        (doubled_wins / (2.0 * pairs)).alias("roc_auc"),
        F.sum(F.when(both, pos / positives * (here + above) / 2)).alias("pr_auc"),
        F.sum(F.when(both, pos / positives * here)).alias("average_precision"),
    )


def roc_curve(df: DataFrame, truth: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """(threshold, tpr, fpr) for every distinct score; the origin is implied."""
    tp, fp = _at_or_above()
    return score_prefix(df, truth, score, groups).select(
        *groups,
        F.col("value").alias("threshold"),
        safe_ratio(tp, F.col("pos_total"), None).alias("tpr"),
        safe_ratio(fp, F.col("neg_total"), None).alias("fpr"),
    )


def pr_curve(df: DataFrame, truth: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) for every distinct score; the point (1, 0) is implied."""
    tp, fp = _at_or_above()
    return score_prefix(df, truth, score, groups).select(
        *groups,
        F.col("value").alias("threshold"),
        safe_ratio(tp, tp + fp, None).alias("precision"),
        safe_ratio(tp, F.col("pos_total"), None).alias("recall"),
    )


_COUNTS = ("true_positives", "true_negatives", "false_positives", "false_negatives")


def performance_metrics(
    df: DataFrame,
    truth: str = "ground_truth",
    prediction: str = "prediction",
    score: str = "probability_fraud",
    groups: Sequence[str] = (),
    min_samples: int = 0,
    ts: str | None = None,
) -> DataFrame:
    """Confusion, rates and ranking metrics per group; groups below ``min_samples`` are left out.

    Labelled rows are read and shuffled once, as counts per (group, score); confusion and ranking are
    both derived from those counts.  With ``ts`` the first and last event time of the group are added.
    """
    groups = list(groups)
    t, p, v = F.col(truth).cast("int"), F.col(prediction).cast("int"), F.col(score).cast("double")
    rows = df.where(F.col(truth).isNotNull()).select(
        *groups, t.alias("__t"), p.alias("__p"), F.when(~F.isnan(v), v).alias("value"),
        *([F.col(ts).alias("__ts")] if ts else []),
    )
    t, p = F.col("__t"), F.col("__p")
    weights = {
        # Rows without a score count in the confusion only; the prefix leaves out values without weight.
        "pos": (t == 1) & F.col("value").isNotNull(), "neg": (t == 0) & F.col("value").isNotNull(), "true_positives": (p == 1) & (t == 1), "true_negatives": (p == 0) & (t == 0),
        "false_positives": (p == 1) & (t == 0), "false_negatives": (p == 0) & (t == 1),
    }
    counted = rows.groupBy(*groups, "value").agg(
        F.count("*").alias("sample_count"),
        *[_count(w).alias(n) for n, w in weights.items()],
        *([F.min("__ts").alias("period_start"), F.max("__ts").alias("period_end")] if ts else []),
    )
    # Always true; reading every column in both branches lets them share one shuffle.
    used = sum((F.col(n) for n in weights), F.col("sample_count")) >= 0
    if ts:
        used = used & (F.col("period_start") <= F.col("period_end"))
    counted = counted.where(used)
    totals = counted.groupBy(*groups).agg(
        F.sum("sample_count").alias("sample_count"),
        *[_total(n).alias(n) for n in _COUNTS],
        *([F.min("period_start").alias("period_start"), F.max("period_end").alias("period_end")] if ts else []),
    )
    if not groups:
        totals = totals.withColumn("sample_count", F.coalesce("sample_count", F.lit(0)))
    order = [*groups, "sample_count", *_COUNTS, *(["period_start", "period_end"] if ts else [])]
    measured = with_rates(totals.select(*order)).where(F.col("sample_count") >= min_samples)
    ranks = _ranking(ordered_prefix(counted, groups, ["pos", "neg"]), groups).select(
        *groups, "roc_auc", "pr_auc", "average_precision"
    )
    if not groups:
        return measured.join(ranks, how="left")
    return join_on(measured, ranks, groups, "left")


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def windowed_metrics(
    df: DataFrame,
    ts: str,
    unit: str = "day",
    truth: str = "ground_truth",
    prediction: str = "prediction",
    score: str = "probability_fraud",
    min_samples: int = 100,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Metrics per day or week with the first and last event time of each period."""
    rows = df.where(F.col(truth).isNotNull() & F.col(ts).isNotNull()).withColumn("period", bucket_start(unit, ts))
    return performance_metrics(rows, truth, prediction, score, [*groups, "period"], min_samples, ts)


def degradation_alerts(
    windows: DataFrame, alert_threshold: float = 0.85, critical_margin: float = 0.05, baseline_auc: float | None = None
) -> DataFrame:
    """Periods whose AUC is below the threshold, with severity and distance from the baseline.

    Without a given baseline the mean over the periods is used.
    """
    if baseline_auc is None:
        windows = windows.crossJoin(F.broadcast(windows.agg(F.avg("roc_auc").alias("baseline"))))
    else:
        windows = windows.withColumn("baseline", F.lit(float(baseline_auc)))
    auc, base = F.col("roc_auc"), F.col("baseline")
    return windows.where(auc < alert_threshold).select(
        "period",
        F.lit("roc_auc").alias("metric"),
        auc.alias("value"),
        "baseline",
        F.lit(float(alert_threshold)).alias("threshold"),
        (base - auc).alias("degradation"),
        (safe_ratio(base - auc, base) * 100).alias("degradation_pct"),
        F.when(auc < alert_threshold - critical_margin, "critical").otherwise("warning").alias("severity"),
        "sample_count",
    )


def class_report(df: DataFrame, truth: str, prediction: str, groups: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages."""
    counts = confusion(df, truth, prediction, groups)
    tp, tn, fp, fn = (
        F.col(c) for c in ("true_positives", "true_negatives", "false_positives", "false_negatives")
    )

    def entry(label: str, hit: Column, false_hit: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(label).alias("class"), hit.alias("hit"), false_hit.alias("false_hit"), missed.alias("missed")
        )

    per_class = counts.select(
        *groups,
        safe_ratio(tp + tn, F.col("sample_count")).alias("accuracy"),
        F.explode(F.array(entry("0", tn, fn, fp), entry("1", tp, fp, fn))).alias("c"),
    ).select(
        *groups,
        F.col("c.class").alias("class"),
        safe_ratio(F.col("c.hit"), F.col("c.hit") + F.col("c.false_hit")).alias("precision"),
        safe_ratio(F.col("c.hit"), F.col("c.hit") + F.col("c.missed")).alias("recall"),
        safe_ratio(2 * F.col("c.hit"), 2 * F.col("c.hit") + F.col("c.false_hit") + F.col("c.missed")).alias("f1_score"),
        (F.col("c.hit") + F.col("c.missed")).alias("support"),
        "accuracy",
    )
    weighted = lambda c: safe_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    rates = ("precision", "recall", "f1_score")
    macro = per_class.groupBy(*groups).agg(
        *[F.avg(c).alias(c) for c in rates], F.sum("support").alias("support"), F.max("accuracy").alias("accuracy")
    )
    weight = per_class.groupBy(*groups).agg(
        *[weighted(c).alias(c) for c in rates], F.sum("support").alias("support"), F.max("accuracy").alias("accuracy")
    )
    order = [*groups, "class", *rates, "support", "accuracy"]
    return (
        per_class.select(*order)
        .unionByName(macro.withColumn("class", F.lit("macro avg")).select(*order))
        .unionByName(weight.withColumn("class", F.lit("weighted avg")).select(*order))
    )


def degenerate_columns(df: DataFrame, columns: Sequence[str], side: str = "side") -> DataFrame:
    """(side, column, n_classes) of every column with fewer than two classes on a side."""
    per_side = df.groupBy(side).agg(
        *[
            (F.max(F.col(c).cast("int")).isNotNull().cast("int")
             + (F.max(F.col(c).cast("int")) > F.min(F.col(c).cast("int"))).cast("int")).alias(c)
            for c in columns
        ]
    )
    counts = per_side.unpivot([side], list(columns), "column", "n_classes")
    return counts.select(side, "column", F.coalesce("n_classes", F.lit(0)).alias("n_classes")).where(
        F.col("n_classes") < 2
    )


def compare_sides(df: DataFrame, truth: str, prediction: str, side: str = "side") -> DataFrame:
    """Class report of 'baseline' and 'current' rows side by side, with deltas."""
    report = class_report(df, truth, prediction, [side])
    rates = ("precision", "recall", "f1_score", "support", "accuracy")
    at = lambda c, s: F.max(F.when(F.col(side) == s, F.col(c)))
    wide = report.groupBy("class").agg(
        *[at(c, s).alias(f"{s}_{c}") for s in ("baseline", "current") for c in rates]
    )
    return wide.select(
        "*", *[(F.col(f"current_{c}") - F.col(f"baseline_{c}")).alias(f"delta_{c}") for c in rates if c != "support"]
    )


def class_counts(df: DataFrame, truth: str, threshold: float = 0.5) -> DataFrame:
    t = F.col(truth).cast("int")
    return df.where(t.isNotNull()).agg(
        F.count("*").alias("test_samples"),
        _count(t == 1).alias("positive_samples"),
        _count(t == 0).alias("negative_samples"),
        F.lit(float(threshold)).alias("threshold"),
    )


def quality_gates(metrics: DataFrame, minimums: dict[str, float]) -> DataFrame:
    """One row per gate: metric, value, threshold, passed, failure text (NULL when passed)."""
    gate = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    F.col(m).cast("double").alias("value"),
                    F.lit(float(t)).alias("threshold"),
                )
                for m, t in minimums.items()
            ]
        )
    )
    rows = metrics.select(gate.alias("g")).select("g.*")
    passed = F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False))
    failure = F.format_string("%s %.4f < %.4f", F.col("metric"), F.col("value"), F.col("threshold"))
    return rows.select("*", passed.alias("passed"), F.when(~passed, failure).alias("failure"))
