"""Analyses over tables of per-row feature attributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_attribution(df: DataFrame, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """(feature, importance): mean absolute attribution, largest first."""
    means = df.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in columns]).unpivot([], list(columns), "feature", "importance")
    ranked = means.orderBy(F.desc("importance"), "feature")
    return ranked if k is None else ranked.limit(k)


def _checked(df: DataFrame, columns: Sequence[str], base: str, prediction: str, log_odds: bool) -> DataFrame:
    total = F.col(base) + sum((F.col(c) for c in columns), F.lit(0.0))
    rebuilt = 1 / (1 + F.exp(-total)) if log_odds else total
    return df.select("*", total.alias("attribution_sum"), rebuilt.alias("rebuilt_prediction")).withColumn(
        "error", F.abs(F.col("rebuilt_prediction") - F.col(prediction))
    )


def additivity(
    df: DataFrame, columns: Sequence[str], base: str, prediction: str, tolerance: float = 1e-4, log_odds: bool = True
) -> DataFrame:
    """One row: does base + sum of attributions rebuild every prediction?"""
    checked = _checked(df, columns, base, prediction, log_odds)
    return checked.agg(
        F.count("*").alias("n"),
        F.max("error").alias("max_error"),
        F.avg("error").alias("mean_error"),
        F.count_if(F.col("error") > tolerance).alias("failed"),
    ).withColumn("passed", F.col("failed") == 0)


def additivity_failures(
    df: DataFrame, columns: Sequence[str], base: str, prediction: str, tolerance: float = 1e-4, log_odds: bool = True
) -> DataFrame:
    return _checked(df, columns, base, prediction, log_odds).where(F.col("error") > tolerance)


def extreme_rows(df: DataFrame, score: str, key: str) -> DataFrame:
    """The rows with the highest and the lowest score (smallest key wins a tie)."""
    everything = F.struct(*df.columns)
    extremes = df.agg(
        F.max_by(everything, F.struct(F.col(score), -F.col(key))).alias("highest"),
        F.min_by(everything, F.struct(F.col(score), F.col(key))).alias("lowest"),
    )
    return extremes.select(
        F.inline(
            F.array(
                F.struct(F.lit("highest").alias("case"), F.col("highest").alias("row")),
                F.struct(F.lit("lowest").alias("case"), F.col("lowest").alias("row")),
            )
        )
    ).select("case", "row.*")


def dependence_pairs(df: DataFrame, pairs: dict[str, str], key: str, k: int = 3) -> DataFrame:
    """(key, feature, value, attribution) of the k features with the largest mean attribution.

    ``pairs`` maps a feature column to its attribution column.
    """
    top = mean_attribution(df.select(*[F.col(a).alias(f) for f, a in pairs.items()]), list(pairs), k)
    entries = F.inline(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), F.col(a).alias("attribution"))
                for f, a in pairs.items()
            ]
        )
    )
    return df.select(key, entries).join(F.broadcast(top.select("feature")), "feature", "left_semi")
