"""Input validation and data-quality gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import FeatureSchema
from tidewatch.functions.columns import FALSE_TOKENS, TRUE_TOKENS
from tidewatch.functions.stats import safe_ratio

SEVERE_IMBALANCE = 100.0
MIN_TRAINING_SAMPLES = 1000


def header_problems(columns: Sequence[str], schema: FeatureSchema) -> list[str]:
    """Every difference between a header and the canonical column order, reported together."""
    expected = schema.column_order()
    have, want = set(columns), set(expected)
    problems = []
    if len(columns) != len(expected):
        problems.append(f"expected {len(expected)} columns, found {len(columns)}")
    missing = [c for c in expected if c not in have]
    extra = [c for c in columns if c not in want]
    if missing:
        problems.append("missing columns: " + ", ".join(missing))
    if extra:
        problems.append("unexpected columns: " + ", ".join(extra))
    if not missing and not extra and list(columns) != expected:
        problems.append("columns are present but in the wrong order")
    return problems


def header_violations(df: DataFrame, schema: FeatureSchema) -> DataFrame:
    return df.sparkSession.createDataFrame([(p,) for p in header_problems(df.columns, schema)], "problem string")


def type_violations(staged: DataFrame, schema: FeatureSchema) -> DataFrame:
    """(column, expected, bad_count, example) of text columns with values of the wrong type.

    Blank values pass.  All rows are read in one aggregate.
    """
    names = [c for c in schema.column_order() if schema.type_of(c) != "string"]
    checks = []
    for c in names:
        text = F.trim(F.col(c))
        filled = F.coalesce(text, F.lit("")) != ""
        if schema.type_of(c) == "boolean":
            good = F.lower(text).isin(*TRUE_TOKENS, *FALSE_TOKENS)
        else:
            good = text.try_cast("timestamp" if schema.type_of(c) == "timestamp" else "double").isNotNull()
        bad = filled & ~good
        checks.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(schema.type_of(c)).alias("expected"),
                F.count_if(bad).alias("bad_count"),
                F.min(F.when(bad, F.col(c))).alias("example"),
            )
        )
    return staged.agg(F.array(*checks).alias("c")).select(F.inline("c")).where("bad_count > 0")


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(F.col(target).cast("string").alias("class")).agg(F.count("*").alias("n"))


def class_imbalance(df: DataFrame, target: str) -> DataFrame:
    """One row: n_classes, imbalance_ratio (only for exactly two classes), severe."""
    per_class = class_distribution(df, target)
    row = per_class.agg(F.count("*").alias("n_classes"), F.max("n").alias("hi"), F.min("n").alias("lo"))
    ratio = F.when(F.col("n_classes") == 2, safe_ratio(F.col("hi"), F.col("lo"), None))
    return row.select(
        "n_classes",
        ratio.alias("imbalance_ratio"),
        F.coalesce(ratio > SEVERE_IMBALANCE, F.lit(False)).alias("severe"),
    )


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing) of columns with at least one NULL."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column", "n_missing").where("n_missing > 0")


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits of a whole row, equal for equal rows: what is shuffled in place of wide rows.

    NULLs are told apart by their place, and the two zeros of a double are one value.
    """
    places = [F.col(c).isNull() for c in df.columns]
    values = [
        F.when(F.col(f.name) == 0, F.lit(0).cast(f.dataType)).otherwise(F.col(f.name)) if f.dataType.typeName() in ("float", "double") else F.col(f.name)
        for f in df.schema.fields
    ]
    return [F.xxhash64(F.lit(seed), *places, *values).alias(f"__digest{seed}") for seed in (1, 2)]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows beyond the first of each distinct row."""
    per_row = df.select(*row_digest(df)).groupBy("__digest1", "__digest2").agg(F.count("*").alias("__n"))
    return per_row.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def quality_report(df: DataFrame, target: str, min_samples: int = MIN_TRAINING_SAMPLES) -> DataFrame:
    """One row: counts, imbalance, duplicates, error and warning texts, and the gate.

    Duplicates and NULLs and classes all come from the counts of distinct rows: one shuffle of digests.
    """
    if target not in df.columns:
        return df.agg(F.count("*").alias("total_rows")).select(
            "total_rows",
            F.lit(len(df.columns)).alias("total_columns"),
            F.lit(None).cast("bigint").alias("missing_values"),
            F.lit(None).cast("bigint").alias("n_classes"),
            F.lit(None).cast("double").alias("imbalance_ratio"),
            F.lit(None).cast("bigint").alias("duplicate_rows"),
            F.array(F.lit(f"Target column '{target}' not found")).alias("errors"),
            F.array().cast("array<string>").alias("warnings"),
            F.lit(False).alias("passed"),
        )
    nulls = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    narrow = df.select(*row_digest(df), target, nulls.alias("__nulls"))
    rows = narrow.groupBy("__digest1", "__digest2", target).agg(F.count("*").alias("__n"), F.sum("__nulls").alias("__nulls"))
    classes = rows.groupBy(target).agg(
        F.sum("__n").alias("n"), F.sum("__nulls").alias("nulls"), F.sum(F.col("__n") - 1).alias("dup")
    )
    ratio = F.when(F.col("n_classes") == 2, safe_ratio(F.col("hi"), F.col("lo"), None))
    totals = classes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("missing_values"),
        F.count("*").alias("n_classes"),
        F.max("n").alias("hi"),
        F.min("n").alias("lo"),
        F.coalesce(F.sum("dup"), F.lit(0)).alias("duplicate_rows"),
    ).withColumn("imbalance_ratio", ratio)
    few = F.col("total_rows") < min_samples
    severe = F.col("imbalance_ratio") > SEVERE_IMBALANCE
    keep_text = lambda c, text: F.array_compact(F.array(F.when(c, text)))
    return totals.select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        "missing_values",
        "n_classes",
        "imbalance_ratio",
        "duplicate_rows",
        keep_text(few, F.format_string("Insufficient samples: %d < %d", F.col("total_rows"), F.lit(min_samples))).alias("errors"),
        keep_text(severe, F.format_string("Severe class imbalance detected: %.1f:1", F.col("imbalance_ratio"))).alias("warnings"),
        (~few).alias("passed"),
    )


def require_quality(report: DataFrame) -> None:
    """Raise with all error texts unless the gate passed (reads the one-row report)."""
    row = report.first()
    if not row["passed"]:
        raise ValueError("; ".join(row["errors"]))


def two_class_check(tables: dict[str, DataFrame], target: str) -> DataFrame:
    """(table, positives, negatives, ok): both classes must be present in every table."""
    parts = None
    for name, df in tables.items():
        y = F.col(target).cast("boolean")
        part = df.agg(
            F.lit(name).alias("table"),
            F.count_if(y).alias("positives"),
            F.count_if(~y).alias("negatives"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts.select("*", ((F.col("positives") > 0) & (F.col("negatives") > 0)).alias("ok"))
