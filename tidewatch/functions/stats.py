"""Statistical tail functions as plain column expressions (no Python in the plan)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_double(c: Column) -> Column:
    return c.cast("double")


def kolmogorov_sf(lam: Column) -> Column:
    """Survival function of the Kolmogorov distribution.

    Two series for the same function: the exponential one converges fast for large arguments, the
    theta form for small ones.
    """
    lam = _as_double(lam)
    large = sum(
        (F.exp(-2.0 * k * k * lam * lam) * (2.0 if k % 2 else -2.0) for k in range(1, 7)),
        F.lit(0.0),
    )
    theta = sum(
        (F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8.0) / (lam * lam)) for k in range(1, 6)),
        F.lit(0.0),
    )
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * theta
    p = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.0, small).otherwise(large)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


def ks_p_value(statistic: Column, n_a: Column, n_b: Column) -> Column:
    """Asymptotic two-sample p-value with the effective sample size ``n_a n_b / (n_a + n_b)``."""
    effective = _as_double(n_a) * _as_double(n_b) / (_as_double(n_a) + _as_double(n_b))
    return kolmogorov_sf(F.sqrt(effective) * statistic)


def _log_gamma_half(dof: Column) -> Column:
    """log Gamma(dof / 2) for a positive integer dof, by the recursion Gamma(s + 1) = s Gamma(s)."""
    odd = dof % 2 == 1
    start = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    base = F.when(odd, F.lit(0.5 * math.log(math.pi))).otherwise(F.lit(0.0))
    steps = F.floor((dof - 1) / 2).cast("int")
    terms = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(terms, base, lambda acc, k: acc + F.log(start + k.cast("double")))


#: Degrees of freedom up to which the chi-square tail is summed; its series need some tens of square roots of it.
SERIES_DOF = 1000


def chi_square_sf(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: regularised incomplete gamma Q(dof/2, x/2).

    Power series for the lower part below the mean, continued fraction for the upper part above it,
    so very small p-values keep their relative accuracy.  Beyond ``SERIES_DOF`` degrees of freedom the cube
    root of x / dof is normal to some 1e-5 and takes their place.
    """
    dof = dof.cast("long")
    k, x = _as_double(dof), F.greatest(_as_double(statistic), F.lit(0.0))
    spread = 2.0 / (9.0 * k)
    z = (F.pow(x / k, F.lit(1.0 / 3.0)) - (1.0 - spread)) / F.sqrt(spread)
    both_sides = _chi_square_series(z * z, F.lit(1))
    normal = F.when(z >= 0, 0.5 * both_sides).otherwise(1.0 - 0.5 * both_sides)
    return F.when(dof > SERIES_DOF, normal).otherwise(_chi_square_series(statistic, F.least(dof, F.lit(SERIES_DOF))))


def _chi_square_series(statistic: Column, dof: Column) -> Column:
    dof = dof.cast("int")
    s = dof.cast("double") / 2.0
    x = _as_double(statistic) / 2.0
    log_scale = s * F.log(x) - x - _log_gamma_half(dof)

    start = F.struct((F.lit(1.0) / s).alias("term"), (F.lit(1.0) / s).alias("total"))

    def add_term(acc, k):
        term = acc["term"] * x / (s + k.cast("double"))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(300)), start, add_term)["total"]
    lower = F.exp(log_scale) * series

    fraction = F.aggregate(
        F.sequence(F.lit(120), F.lit(1), F.lit(-1)),
        x + 241.0 - s,
        lambda acc, k: x + (2.0 * k - 1.0) - s - (k.cast("double") * (k.cast("double") - s)) / acc,
    )
    upper = F.exp(log_scale) / fraction
    tail = F.when(x <= 0, F.lit(1.0)).when(x < s + 1.0, 1.0 - lower).otherwise(upper)
    return F.when(dof < 1, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))


def safe_ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """numerator / denominator, ``default`` where the denominator is zero or NULL."""
    ratio = _as_double(numerator) / F.nullif(_as_double(denominator), F.lit(0.0))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))
