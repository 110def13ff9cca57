"""Column expressions shared by the operators: casts, score derivations, labels, time filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens accepted as booleans.
TRUE_TOKENS = ("true", "1", "yes")
FALSE_TOKENS = ("false", "0", "no")
# Score buckets and the upper bound of each but the last.
SCORE_BUCKETS = (("very_low", 0.2), ("low", 0.4), ("medium", 0.6), ("high", 0.8), ("very_high", None))
# Name and lower bound of each risk tier, strongest first.
RISK_TIERS = (("High Risk", 0.8), ("Medium Risk", 0.5), ("Low Risk", 0.2), ("Minimal Risk", None))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed(name: str, type_name: str, strict: bool = True) -> Column:
    """Cast a staged text column to its schema type.

    ``strict`` raises on a bad value (the run fails), otherwise bad values become NULL.
    """
    c = F.col(name)
    if type_name == "string":
        return c.alias(name)
    source = F.lower(c) if type_name == "boolean" else c
    target = {"int": "int", "double": "double", "boolean": "boolean", "timestamp": "timestamp"}[type_name]
    if strict:
        # Reject values that do not parse whatever the session's ANSI setting is.
        parsed = source.try_cast(target)
        problem = F.concat(F.lit(f"column {name}: cannot read "), c, F.lit(f" as {target}"))
        out = F.when(c.isNotNull() & parsed.isNull(), F.raise_error(problem).cast(target)).otherwise(parsed)
    else:
        out = source.try_cast(target)
    return out.alias(name)


def number_or_null(c: Column | str) -> Column:
    """Numeric value of a text or number; NULL where it does not parse."""
    return col(c).cast("string").try_cast("double")


# -- scores ---------------------------------------------------------------------------------------


def predicted(probability: Column | str, threshold: float = 0.5) -> Column:
    return (col(probability) >= threshold).cast("int")


def confidence(probability: Column | str) -> Column:
    p = col(probability)
    return F.greatest(p, 1 - p)


def is_high_confidence(score: Column | str, above: float = 0.9) -> Column:
    return col(score) > above


def is_low_confidence(score: Column | str, lower: float = 0.4, upper: float = 0.6) -> Column:
    return col(score).between(lower, upper)


def score_bucket(probability: Column | str) -> Column:
    p = col(probability)
    out = None
    for name, upper in SCORE_BUCKETS:
        if upper is None:
            return F.when(p.isNull(), F.lit(None)).otherwise(out.otherwise(name))
        out = F.when(p < upper, name) if out is None else out.when(p < upper, name)
    raise AssertionError("the last bucket is open")


def risk_tier(probability: Column | str) -> Column:
    p = col(probability)
    out = None
    for name, above in RISK_TIERS:
        if above is None:
            return out.otherwise(name)
        out = F.when(p > above, name) if out is None else out.when(p > above, name)
    raise AssertionError("the last tier is open")


def prediction_status(prediction: Column | str, truth: Column | str) -> Column:
    p, t = col(prediction), col(truth)
    return F.when(t.isNull(), "Pending").when(p == t, "Correct").otherwise("Incorrect")


def prediction_category(prediction: Column | str, truth: Column | str) -> Column:
    p, t = col(prediction), col(truth)
    return (
        F.when((p == 1) & (t == 1), "True Positive")
        .when((p == 0) & (t == 0), "True Negative")
        .when((p == 1) & (t == 0), "False Positive")
        .when((p == 0) & (t == 1), "False Negative")
        .otherwise("Unknown")
    )


def error_type(prediction: Column | str, truth: Column | str) -> Column:
    p, t = col(prediction), col(truth)
    return (
        F.when((p == 1) & (t == 0), "false_positive")
        .when((p == 0) & (t == 1), "false_negative")
        .otherwise("correct")
    )


def correctness(prediction: Column | str, truth: Column | str) -> Column:
    return F.when(col(prediction) == col(truth), "correct").otherwise("incorrect")


def prediction_match(prediction: Column | str, truth: Column | str) -> Column:
    return F.when(col(prediction) == col(truth), 1).otherwise(0)


# -- run-level labels -----------------------------------------------------------------------------


def run_severity(share: Column | str, high: float = 0.3, medium: float = 0.15) -> Column:
    s = col(share)
    return F.when(s > high, "HIGH").when(s > medium, "MEDIUM").otherwise("LOW")


def performance_status(auc: Column | str, good: float = 0.95, warning: float = 0.90) -> Column:
    a = col(auc)
    return F.when(a >= good, "GOOD").when(a >= warning, "WARNING").otherwise("CRITICAL")


def feature_severity(magnitude: Column | str, significant: float = 2.5, moderate: float = 1.0) -> Column:
    m = col(magnitude)
    return F.when(m > significant, "Significant").when(m > moderate, "Moderate").otherwise("Low")


def psi_band(psi: Column | str) -> Column:
    p = col(psi)
    return F.when(p > 0.25, "significant").when(p >= 0.1, "moderate").otherwise("none")


# -- time -----------------------------------------------------------------------------------------


def as_of_literal(as_of: datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def within_last(ts: Column | str, as_of: datetime | str, **span: int) -> Column:
    """``ts`` in ``(as_of - span, as_of]``; span as days=, hours= or minutes=.

    Written against the bare column with literal bounds, so it reaches the file scan.
    """
    parts = {"days": span.get("days", 0), "hours": span.get("hours", 0), "mins": span.get("minutes", 0)}
    interval = F.make_dt_interval(*[F.lit(parts[k]) for k in ("days", "hours", "mins")])
    upper = as_of_literal(as_of)
    return (col(ts) > upper - interval) & (col(ts) <= upper)


def half_open(ts: Column | str, start: datetime | str, end: datetime | str) -> Column:
    return (col(ts) >= as_of_literal(start)) & (col(ts) < as_of_literal(end))


def closed(ts: Column | str, start: datetime | str, end: datetime | str) -> Column:
    return col(ts).between(as_of_literal(start), as_of_literal(end))


def bucket_start(unit: str, ts: Column | str) -> Column:
    """Start of the minute, hour, day or week (Monday) of ``ts``, without a time zone."""
    return F.date_trunc(unit, col(ts)).cast("timestamp_ntz")


# -- geography ------------------------------------------------------------------------------------


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = 6371.0) -> Column:
    """Haversine distance."""
    d_lat, d_lon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(d_lat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(d_lon / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


# -- hashing --------------------------------------------------------------------------------------


def hash_bucket(key: Column | str, modulus: int = 10) -> Column:
    """Portable hash bucket: leading 32 bits of md5, modulo."""
    digest = F.md5(col(key).cast("string"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(modulus))
