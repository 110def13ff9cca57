"""Drift of many groups (endpoints, days) against one baseline, with every test, in one pass.

A group meets the baseline through sums over it, never through a copy of it.  What the two-sample distances need of the baseline at
a group's value is how many baseline rows lie below, and their sum; what the area between the distribution functions needs besides is the
baseline's partial sum up to the ranks at which the group's own function steps.  Both are looked up once for all groups in ordered prefix sums
(:mod:`tidewatch.operators.kernel`), so the cost is that of sorting the distinct values of both sides, whatever the number of groups.

Each of the three passes reads what the one before it stored in the scratch folder (distinct values and counts, no rows), so the sources are
read once and no plan holds another.

Categories that a group lacks enter its chi-square and its divergence by their total, so they are not listed either.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi_square_sf, ks_p_value
from tidewatch.operators.drift import (
    CHI_SQUARE,
    JENSEN_SHANNON,
    KS,
    THRESHOLDS,
    WASSERSTEIN,
    melt_numeric,
    melt_text,
    with_verdict,
)
from tidewatch.operators.kernel import collapse, join_on, ordered_prefix
from tidewatch.session import cut_lineage


def _scales(base: DataFrame) -> DataFrame:
    """(feature, low, scale) of the collapsed baseline: least value and standard deviation (1 where there is none); a row per feature."""
    low = base.groupBy("feature").agg(F.min("value").alias("low"))
    x = F.col("value") - F.col("low")
    moments = base.join(F.broadcast(low), "feature").groupBy("feature", "low").agg(
        F.sum("a").alias("n"), F.sum(F.col("a") * x).alias("m1"), F.sum(F.col("a") * x * x).alias("m2")
    )
    variance = (F.col("m2") - F.col("m1") * F.col("m1") / F.col("n")) / F.nullif(F.col("n") - 1, F.lit(0))
    return moments.select("feature", "low", F.when(variance > 0, F.sqrt(variance)).otherwise(F.lit(1.0)).alias("scale"))


def _baseline_below(base: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, value, a, a_below, a_total, s, s_below) at every distinct value of either side; ``s`` sums what values exceed the least one by."""
    both = base.select("feature", "value", "a", (F.col("a") * (F.col("value") - F.col("low"))).alias("s"), F.lit(0).cast("long").alias("b")).unionByName(
        current.select("feature", "value", F.lit(0).cast("long").alias("a"), F.lit(0.0).alias("s"), "b")
    )
    merged = both.groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("s").alias("s"), F.sum("b").alias("b"))
    return ordered_prefix(merged, ["feature"], ["a", "b"], sums=["s"])


def _partial_sums(points: DataFrame, asked: DataFrame) -> DataFrame:
    """(feature, rank, partial): sum of what the ``rank`` smallest baseline rows exceed the least value by; fractions of a row count.

    ``points`` are baseline values with ``below`` (rows), ``sum_below`` and ``x``, all of which rise with the rank.
    """
    seen = points.select("feature", F.col("below").cast("double").alias("value"), "below", "sum_below", "x").unionByName(
        asked.select("feature", F.col("rank").alias("value")), allowMissingColumns=True
    )
    merged = seen.groupBy("feature", "value").agg(F.max("below").alias("below"), F.max("sum_below").alias("sum_below"), F.max("x").alias("x"), F.lit(1).cast("long").alias("n"))
    pre = ordered_prefix(merged, ["feature"], ["n"], latest=["below", "sum_below", "x"])
    partial = F.col("sum_below_latest") + (F.col("value") - F.col("below_latest")) * F.col("x_latest")
    return pre.select("feature", F.col("value").alias("rank"), partial.alias("partial"))


def grouped_distances(baseline: DataFrame, current: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Two-sample distances per (groups, feature): the columns of ``drift.numeric_distances``.

    ``baseline`` is long (feature, value), ``current`` (groups..., feature, value).  Groups may be NULL.  A feature without a value
    on either side has no row.
    """
    groups = list(groups)
    keys = [*groups, "feature"]
    plain = cut_lineage(collapse(baseline, ["feature"], "value", {"a": F.lit(1)}), "baseline-values")
    scales = F.broadcast(_scales(plain))
    base = plain.join(scales, "feature")
    mine = cut_lineage(collapse(current, keys, "value", {"b": F.lit(1)}), "group-values")
    below = cut_lineage(_baseline_below(base, mine), "baseline-below")
    met = mine.join(below.where("b > 0").drop("b", "next_value", "min_value", "b_below", "b_total"), ["feature", "value"]).where("a_total > 0")
    pre = ordered_prefix(met, keys, ["b"], keep=["a", "a_below", "a_total", "s", "s_below"]).join(scales, "feature")
    # Steps of the group (from c0 to c1) and of the baseline (u0 to u1) at the value.
    steps = cut_lineage(pre.selectExpr(
        *keys, "b_total", "a_total", "scale", "value - low AS x", "b_below", "b", "s_below / a_total AS s0", "(s_below + s) / a_total AS s1",
        "b_below / b_total AS c0", "(b_below + b) / b_total AS c1", "a_below / a_total AS u0", "(a_below + a) / a_total AS u1",
    ), "steps")
    known = """x * (least(greatest(u0, c0), c1) - c0) - x * (c1 - least(greatest(u1, c0), c1))
        - CASE WHEN u0 BETWEEN c0 AND c1 THEN s0 ELSE 0 END - CASE WHEN u1 BETWEEN c0 AND c1 THEN s1 ELSE 0 END"""
    measured = steps.groupBy(*keys).agg(
        F.max("a_total").alias("n_baseline"),
        F.max("b_total").alias("n_current"),
        F.max("scale").alias("__scale"),
        F.expr("max(greatest(abs(c1 - u1), abs(c0 - u0)))").alias("ks_statistic"),
        F.expr(f"sum({known})").alias("__known"),
    )
    # The rest of the area: partial sums of the baseline at the group's own steps, each with its sign.
    signed = """inline(array(
        struct(b_below * a_total / b_total AS rank, 1 - int(u0 < c0) - int(u1 < c0) AS sign),
        struct((b_below + b) * a_total / b_total AS rank, 1 - int(u0 > c1) - int(u1 > c1) AS sign)))"""
    asked = steps.selectExpr(*keys, "a_total", signed).where("sign != 0 AND rank > 0").groupBy(*keys, "a_total", "rank").agg(F.sum("sign").alias("sign")).where("sign != 0")
    points = below.where("a > 0").join(scales, "feature").selectExpr("feature", "a_below AS below", "s_below AS sum_below", "value - low AS x")
    partial = _partial_sums(points, asked)
    rest = asked.join(partial, ["feature", "rank"]).groupBy(*keys).agg(F.expr("sum(sign * partial / a_total)").alias("__rest"))
    joined = join_on(measured, rest, keys, "left")
    area = (F.col("__known") + F.coalesce("__rest", F.lit(0.0))) / F.col("__scale")
    finite = ~F.isnan(area) & (F.abs(area) != float("inf"))
    return joined.select(
        *keys,
        "n_baseline",
        "n_current",
        "ks_statistic",
        ks_p_value(F.col("ks_statistic"), F.col("n_baseline"), F.col("n_current")).alias("ks_p_value"),
        F.when(finite, F.greatest(area, F.lit(0.0))).alias("wasserstein"),
    )


def grouped_categories(baseline: DataFrame, current: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Chi-square test and Jensen-Shannon distance per (groups, feature): the columns of ``drift.categorical_distances``.

    ``baseline`` is long (feature, category), ``current`` (groups..., feature, category); NULL categories drop.
    """
    keys = [*groups, "feature"]
    base = baseline.where("category IS NOT NULL").groupBy("feature", "category").agg(F.count("*").alias("a"))
    whole = base.groupBy("feature").agg(F.sum("a").alias("na"), F.count("*").alias("__k"))  # a row per feature
    mine = current.where("category IS NOT NULL").groupBy(*keys, "category").agg(F.count("*").alias("b"))
    met = mine.join(base, ["feature", "category"], "left").withColumn("a", F.coalesce("a", F.lit(0))).join(F.broadcast(whole), "feature")
    totals = mine.groupBy(*keys).agg(F.sum("b").alias("nb"))
    rows = join_on(met, totals, keys).selectExpr("*", "a / na AS p", "b / nb AS q", "double(a + b) * na / (na + nb) AS ea", "double(a + b) * nb / (na + nb) AS eb")
    part = "CASE WHEN {s} > 0 THEN {s} * ln({s} / ((p + q) / 2)) / 2 ELSE 0 END"
    out = rows.groupBy(*keys).agg(
        F.max("na").alias("n_baseline"),
        F.max("nb").alias("n_current"),
        # A category that the group lacks adds a * nb / na to the statistic and p * ln 2 / 2 to the divergence.
        F.expr("sum(pow(a - ea, 2) / ea + pow(b - eb, 2) / eb) + max(nb) / max(na) * (max(na) - sum(a))").alias("chi_square"),
        F.expr("max(__k) + count_if(a = 0) - 1").alias("dof"),
        F.expr(f"sqrt(greatest(0.0D, sum({part.format(s='p')} + {part.format(s='q')}) + (1 - sum(p)) * {math.log(2) / 2!r}D))").alias("jensen_shannon"),
    )
    return out.withColumn("chi_square_p_value", chi_square_sf(F.col("chi_square"), F.col("dof")))


def grouped_feature_drift(
    baseline: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    groups: Sequence[str],
    small_sample: int = 1000,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Verdict of every (groups, feature) with the test picked by column type and baseline size, as ``drift.feature_drift`` picks it.

    A feature without a value in a group has no row there.
    """
    limit = {**THRESHOLDS, **(thresholds or {})}
    keys = [*groups, "feature"]

    def pick(frame: DataFrame, p_column: str, p_name: str, d_column: str, d_name: str) -> DataFrame:
        small = F.col("n_baseline") < small_sample
        return frame.select(
            *keys,
            "n_baseline",
            "n_current",
            F.when(small, F.col(p_column)).otherwise(F.col(d_column)).alias("drift_score"),
            F.when(small, p_name).otherwise(d_name).alias("method"),
            F.when(small, F.lit(limit[p_name])).otherwise(F.lit(limit[d_name])).alias("threshold"),
        )

    parts = []
    if numeric:
        found = grouped_distances(melt_numeric(baseline, numeric), melt_numeric(current, numeric, groups), groups)
        parts.append(pick(found, "ks_p_value", KS, "wasserstein", WASSERSTEIN))
    if categorical:
        found = grouped_categories(melt_text(baseline, categorical), melt_text(current, categorical, groups), groups)
        parts.append(pick(found, "chi_square_p_value", CHI_SQUARE, "jensen_shannon", JENSEN_SHANNON))
    if not parts:
        raise ValueError("no feature to compare")
    return with_verdict(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))
