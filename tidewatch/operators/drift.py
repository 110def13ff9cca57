"""Feature drift: distances between a baseline and a current sample, and the verdict on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi_square_sf, ks_p_value
from tidewatch.operators.kernel import collapse, exact_quantiles, join_on, ordered_prefix

# Method names as they appear in stored verdicts.
KS = "K-S p_value"
CHI_SQUARE = "chi-square p_value"
WASSERSTEIN = "Wasserstein distance (normed)"
JENSEN_SHANNON = "Jensen-Shannon distance"
PSI = "PSI"
KL = "Kullback-Leibler divergence"
# Default threshold per method.
THRESHOLDS = {KS: 0.05, CHI_SQUARE: 0.05, WASSERSTEIN: 0.1, JENSEN_SHANNON: 0.1, PSI: 0.1, KL: 0.1}
MAX_MAGNITUDE = 1e9


# -- long form ------------------------------------------------------------------------------------


def _fresh(keep: Sequence[str]) -> list[Column]:
    """Kept columns under new identities, so that two uses of one melt plan the same shuffle."""
    return [F.col(k).alias(k) for k in keep]


def melt_numeric(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value): all numeric features in one long frame, so one shuffle serves all."""
    cast = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return cast.unpivot(_fresh(keep), list(features), "feature", "value")


def melt_text(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, category), lower-cased."""
    cast = df.select(*keep, *[F.lower(F.col(f).cast("string")).alias(f) for f in features])
    return cast.unpivot(_fresh(keep), list(features), "feature", "category")


def stack_sides(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both samples with ``is_current`` 0/1, restricted to ``columns``."""
    return baseline.select(*columns, F.lit(0).alias("is_current")).unionByName(
        current.select(*columns, F.lit(1).alias("is_current"))
    )


def common_features(baseline: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> list[str]:
    """Columns present on both sides, in schema order (or sorted when no order is given)."""
    shared = set(baseline.columns) & set(current.columns)
    return [f for f in features if f in shared] if features is not None else sorted(shared)


# -- numeric distances ----------------------------------------------------------------------------


def _sides(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    base = 1 - F.col("is_current")
    return collapse(df, groups, "value", {"a": base, "b": F.col("is_current")})


def numeric_distances(sides: DataFrame, groups: Sequence[str] = ("feature",)) -> DataFrame:
    """Two-sample distances per group from long rows (groups..., value, is_current).

    Columns: n_baseline, n_current, ks_statistic, ks_p_value, wasserstein (divided by the baseline
    standard deviation).  A group empty on one side gets statistic 0 and p-value 1; where infinite
    values leave no finite distance, ``wasserstein`` is NULL.
    """
    groups = list(groups)
    pre = ordered_prefix(_sides(sides, groups), groups, ["a", "b"])
    cdf_gap = F.abs(
        (F.col("a_below") + F.col("a")) / F.col("a_total") - (F.col("b_below") + F.col("b")) / F.col("b_total")
    )
    gap = F.when((F.col("a_total") > 0) & (F.col("b_total") > 0), cdf_gap)
    # Moments about the group minimum keep the variance free of cancellation.
    shifted = F.col("value") - F.col("min_value")
    distances = pre.groupBy(*groups).agg(
        F.max("a_total").alias("n_baseline"),
        F.max("b_total").alias("n_current"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("ks_statistic"),
        F.sum(gap * (F.col("next_value") - F.col("value"))).alias("__w1"),
        F.sum(F.col("a") * shifted).alias("__m1"),
        F.sum(F.col("a") * shifted * shifted).alias("__m2"),
    )
    n = F.col("n_baseline")
    variance = (F.col("__m2") - F.col("__m1") * F.col("__m1") / F.nullif(n, F.lit(0))) / F.nullif(n - 1, F.lit(0))
    # A constant baseline has no scale: any shift at all is then reported unscaled.
    scale = F.when(variance > 0, F.sqrt(variance)).otherwise(F.lit(1.0))
    distance = F.coalesce(F.col("__w1") / scale, F.lit(0.0))
    finite = ~F.isnan(distance) & (F.abs(distance) != float("inf"))
    p = F.when(
        (n > 0) & (F.col("n_current") > 0), ks_p_value(F.col("ks_statistic"), n, F.col("n_current"))
    ).otherwise(F.lit(1.0))
    return distances.select(
        *groups,
        "n_baseline",
        "n_current",
        "ks_statistic",
        p.alias("ks_p_value"),
        F.when(finite, distance).alias("wasserstein"),
    )


def _inner_probabilities(bins: int) -> list[float]:
    return [i / bins for i in range(1, bins)]


def decile_edges(baseline_long: DataFrame, groups: Sequence[str] = ("feature",), bins: int = 10) -> DataFrame:
    """Inner bin edges per group: exact baseline quantiles at 1/bins .. (bins-1)/bins."""
    return exact_quantiles(baseline_long, groups, "value", _inner_probabilities(bins)).withColumnRenamed(
        "quantiles", "edges"
    )


def bin_index(value: Column, edges: Column, bins: int = 10) -> Column:
    """0-based bin of a left-closed histogram with open outer bins; ``edges`` holds bins - 1 values.

    Spelled out per edge, so it stays inside generated code.
    """
    return sum(((value >= edges[i]).cast("int") for i in range(bins - 1)), F.lit(0))


def bin_counts(sides: DataFrame, bins: int = 10, baseline: DataFrame | None = None) -> DataFrame:
    """(feature, bin, a, b): side counts per baseline quantile bin.

    Only the baseline is shuffled by value, for its exact quantiles.  The rows themselves meet the
    edges (one short array per feature, broadcast) where they are read and leave as bin counts.
    ``baseline`` (feature, value), the baseline side by itself, spares reading the other side for the edges: a
    filter on the stacked sides does not reach their scans.
    """
    edges = decile_edges(sides.where(F.col("is_current") == 0) if baseline is None else baseline, ["feature"], bins)
    v = F.col("value")
    rows = sides.where(v.isNotNull() & ~F.isnan(v)).join(F.broadcast(edges), "feature")
    return rows.groupBy("feature", bin_index(v, F.col("edges"), bins).alias("bin")).agg(
        F.sum((1 - F.col("is_current")).cast("long")).alias("a"), F.sum(F.col("is_current").cast("long")).alias("b")
    )


def floored_shares(counts: DataFrame, groups: Sequence[str], floor: float = 1e-4) -> DataFrame:
    """Add shares ``p`` (baseline) and ``q`` (current) per group; zero shares become ``floor``.

    ``counts`` has at most a few bins per group, so a window over the group is small.
    """
    group = Window.partitionBy(*groups)
    na, nb = F.sum("a").over(group), F.sum("b").over(group)
    totals = counts.withColumn("__na", na).withColumn("__nb", nb)
    share = lambda n, d: F.when(F.col(n) == 0, F.lit(floor)).otherwise(F.col(n) / F.col(d))
    return (
        totals.where((F.col("__na") > 0) & (F.col("__nb") > 0))
        .withColumn("p", share("a", "__na"))
        .withColumn("q", share("b", "__nb"))
    )


def divergences(shares: DataFrame, groups: Sequence[str]) -> DataFrame:
    """psi, kl_div (current against baseline) and jensen_shannon distance from floored shares."""
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    return shares.groupBy(*groups).agg(
        F.sum((q - p) * F.log(q / p)).alias("psi"),
        F.sum(q * F.log(q / p)).alias("kl_div"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum(p * F.log(p / m) / 2 + q * F.log(q / m) / 2))).alias("jensen_shannon"),
    )


def binned_divergences(sides: DataFrame, bins: int = 10, baseline: DataFrame | None = None) -> DataFrame:
    """PSI, KL and Jensen-Shannon per numeric feature over baseline quantile bins."""
    return divergences(floored_shares(bin_counts(sides, bins, baseline), ["feature"]), ["feature"])


def psi(sides: DataFrame, bins: int = 10, baseline: DataFrame | None = None) -> DataFrame:
    """Population stability index per feature."""
    return binned_divergences(sides, bins, baseline).select("feature", "psi")


# -- categorical distances ------------------------------------------------------------------------


def category_counts(sides: DataFrame, groups: Sequence[str] = ("feature",)) -> DataFrame:
    """(groups..., category, a, b): side counts per category; NULL categories drop."""
    return (
        sides.where(F.col("category").isNotNull())
        .groupBy(*groups, "category")
        .agg(F.sum(1 - F.col("is_current")).alias("a"), F.sum(F.col("is_current").cast("long")).alias("b"))
    )


def categorical_distances(sides: DataFrame, groups: Sequence[str] = ("feature",)) -> DataFrame:
    """Chi-square test of (side x category) and Jensen-Shannon distance per group."""
    groups = list(groups)
    counts = category_counts(sides, groups)
    totals = counts.groupBy(*groups).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count("*").alias("k"))
    joined = join_on(counts, totals, groups)
    n = F.col("na") + F.col("nb")
    row = (F.col("a") + F.col("b")).cast("double")
    expect_a, expect_b = row * F.col("na") / n, row * F.col("nb") / n
    p, q = F.col("a") / F.nullif(F.col("na"), F.lit(0)), F.col("b") / F.nullif(F.col("nb"), F.lit(0))
    m = (p + q) / 2
    part = lambda s: F.when(s > 0, s * F.log(s / m) / 2).otherwise(F.lit(0.0))
    term = F.pow(F.col("a") - expect_a, 2) / expect_a + F.pow(F.col("b") - expect_b, 2) / expect_b
    both = (F.col("na") > 0) & (F.col("nb") > 0)
    out = joined.groupBy(*groups).agg(
        F.max("na").alias("n_baseline"),
        F.max("nb").alias("n_current"),
        F.coalesce(F.sum(F.when(both, term)), F.lit(0.0)).alias("chi_square"),
        (F.max("k") - 1).alias("dof"),
        F.sqrt(F.greatest(F.lit(0.0), F.coalesce(F.sum(F.when(both, part(p) + part(q))), F.lit(0.0)))).alias(
            "jensen_shannon"
        ),
    )
    return out.withColumn("chi_square_p_value", chi_square_sf(F.col("chi_square"), F.col("dof")))


# -- test registry --------------------------------------------------------------------------------


@dataclass(frozen=True)
class DriftTest:
    """A named drift test: how to score all features at once, and how to read the score."""

    name: str
    kind: str  # "numeric" or "categorical"
    score: Callable[[DataFrame], DataFrame]  # long rows of both sides -> (feature, drift_score)
    threshold: float


_TESTS: dict[str, DriftTest] = {}


def register_test(key: str, test: DriftTest) -> None:
    """Make a test available to :func:`explicit_test` under ``key``."""
    _TESTS[key] = test


def drift_test(key: str) -> DriftTest:
    if key not in _TESTS:
        raise ValueError(f"unknown drift test {key!r}; known: {sorted(_TESTS)}")
    return _TESTS[key]


def _from(frame: Callable[[DataFrame], DataFrame], column: str) -> Callable[[DataFrame], DataFrame]:
    return lambda sides: frame(sides).select("feature", F.col(column).alias("drift_score"))


register_test("ks", DriftTest(KS, "numeric", _from(numeric_distances, "ks_p_value"), 0.05))
register_test("wasserstein", DriftTest(WASSERSTEIN, "numeric", _from(numeric_distances, "wasserstein"), 0.1))
register_test("psi", DriftTest(PSI, "numeric", _from(binned_divergences, "psi"), 0.1))
register_test("kl_div", DriftTest(KL, "numeric", _from(binned_divergences, "kl_div"), 0.1))
register_test("jensen_shannon", DriftTest(JENSEN_SHANNON, "numeric", _from(binned_divergences, "jensen_shannon"), 0.1))
register_test("chisquare", DriftTest(CHI_SQUARE, "categorical", _from(categorical_distances, "chi_square_p_value"), 0.05))
register_test(
    "jensen_shannon_categorical",
    DriftTest(JENSEN_SHANNON, "categorical", _from(categorical_distances, "jensen_shannon"), 0.1),
)


# -- per-column and dataset verdicts --------------------------------------------------------------


def with_verdict(scores: DataFrame) -> DataFrame:
    """(feature, drift_score, method, threshold) -> adds drifted, drift_magnitude, magnitude_capped.

    Magnitude 1.0 means "at the threshold" for every method.  A zero p-value has no finite magnitude;
    it is stored as a cap with a flag.
    """
    is_p = F.col("method").contains("p_value") | F.col("method").contains("p-value")
    s, t = F.col("drift_score"), F.col("threshold")
    raw = F.when(is_p, t / F.nullif(s, F.lit(0.0))).otherwise(s / F.nullif(t, F.lit(0.0)))
    return scores.select(
        "*",
        F.when(is_p, s < t).otherwise(s > t).alias("drifted"),
        F.least(F.coalesce(raw, F.lit(MAX_MAGNITUDE)), F.lit(MAX_MAGNITUDE)).alias("drift_magnitude"),
        (raw.isNull() | (raw > MAX_MAGNITUDE)).alias("magnitude_capped"),
    )


def explicit_test(
    baseline: DataFrame, current: DataFrame, features: Sequence[str], test: str, threshold: float | None = None
) -> DataFrame:
    """One chosen test on all given features."""
    chosen = drift_test(test)
    sides = stack_sides(baseline, current, features)
    melt = melt_numeric if chosen.kind == "numeric" else melt_text
    scores = chosen.score(melt(sides, features, ["is_current"])).select(
        "feature",
        "drift_score",
        F.lit(chosen.name).alias("method"),
        F.lit(float(chosen.threshold if threshold is None else threshold)).alias("threshold"),
    )
    return with_verdict(scores)


def feature_drift(
    baseline: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    small_sample: int = 1000,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Drift of every feature with the test picked by column type and baseline size.

    Below ``small_sample`` baseline rows the p-value tests decide (KS, chi-square), from there on the
    distances (normed Wasserstein, Jensen-Shannon).  Both come out of the same pass, so choosing is
    a column expression, not a second job.  Features empty on one side are dropped.
    """
    limit = {**THRESHOLDS, **(thresholds or {})}
    parts = []

    def pick(frame: DataFrame, p_column: str, p_name: str, d_column: str, d_name: str) -> DataFrame:
        small = F.col("n_baseline") < small_sample
        return frame.where((F.col("n_baseline") > 0) & (F.col("n_current") > 0)).select(
            "feature",
            F.when(small, F.col(p_column)).otherwise(F.col(d_column)).alias("drift_score"),
            F.when(small, p_name).otherwise(d_name).alias("method"),
            F.when(small, F.lit(limit[p_name])).otherwise(F.lit(limit[d_name])).alias("threshold"),
        )

    if numeric:
        sides = melt_numeric(stack_sides(baseline, current, numeric), numeric, ["is_current"])
        parts.append(pick(numeric_distances(sides), "ks_p_value", KS, "wasserstein", WASSERSTEIN))
    if categorical:
        sides = melt_text(stack_sides(baseline, current, categorical), categorical, ["is_current"])
        parts.append(
            pick(categorical_distances(sides), "chi_square_p_value", CHI_SQUARE, "jensen_shannon", JENSEN_SHANNON)
        )
    if not parts:
        raise ValueError("no feature to compare")
    scores = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return with_verdict(scores)


def dataset_verdict(verdicts: DataFrame, drift_share: float = 0.5) -> DataFrame:
    """One row: features_analyzed, drifted_columns_count, drifted_columns_share, data_drift_detected."""
    counted = verdicts.agg(
        F.count("*").alias("features_analyzed"),
        F.coalesce(F.sum(F.col("drifted").cast("long")), F.lit(0)).alias("drifted_columns_count"),
    )
    share = F.coalesce(F.col("drifted_columns_count") / F.nullif(F.col("features_analyzed"), F.lit(0)), F.lit(0.0))
    return counted.select(
        "*",
        share.alias("drifted_columns_share"),
        ((F.col("features_analyzed") > 0) & (share >= drift_share)).alias("data_drift_detected"),
    )


def top_drifted(verdicts: DataFrame, k: int = 5, only_drifted: bool = True) -> DataFrame:
    """The k features furthest past their threshold."""
    rows = verdicts.where("drifted") if only_drifted else verdicts
    return rows.orderBy(F.desc("drift_magnitude"), "feature").limit(k)


def period_psi(
    baseline: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    period_columns: Sequence[str],
    bins: int = 10,
) -> DataFrame:
    """PSI of every (period, feature) of ``current`` against one baseline.

    The baseline is binned once; the current side is reduced to bin counts, so the cost does not
    depend on the number of periods times the baseline size.
    """
    base_long = melt_numeric(baseline, features)
    edges = F.broadcast(decile_edges(base_long, ["feature"], bins))
    v = F.col("value")
    valid = v.isNotNull() & ~F.isnan(v)

    def bin_map(long: DataFrame, keys: list[str], counts: str, total: str) -> DataFrame:
        """One row per key: bin -> count (a map of at most ``bins`` entries) and the total."""
        binned = (
            long.where(valid)
            .join(edges, "feature")
            .groupBy(*keys, bin_index(v, F.col("edges"), bins).alias("bin"))
            .agg(F.count("*").alias("n"))
        )
        return binned.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias(counts), F.sum("n").alias(total)
        )

    periods = list(period_columns)
    base = bin_map(base_long, ["feature"], "__base", "n_baseline")
    current = bin_map(melt_numeric(current, features, periods), [*periods, "feature"], "__cur", "n_current")
    joined = current.join(F.broadcast(base), "feature")

    def share(counts: str, total: str, i: int) -> Column:
        n = F.coalesce(F.element_at(counts, F.lit(i)), F.lit(0))
        return F.when(n == 0, F.lit(1e-4)).otherwise(n / F.col(total))

    index = F.lit(0.0)
    for i in range(bins):
        p, q = share("__base", "n_baseline", i), share("__cur", "n_current", i)
        index = index + (q - p) * F.log(q / p)
    return joined.select(*periods, "feature", index.alias("psi"), "n_current")
