"""Statistics as Column expressions: intervals, tests, bands and the gated index."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_of(alpha: float) -> float:
    return NormalDist().inv_cdf(1 - alpha / 2)


def wilson(x: Column, n: Column, alpha: float = 0.05) -> tuple[Column, Column]:
    """The score interval's ends for x of n; null without trials."""
    z = z_of(alpha)
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = x / n
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.when(n.isNotNull(), F.greatest(middle - half, F.lit(0.0))), F.when(n.isNotNull(), F.least(middle + half, F.lit(1.0)))


#: Coefficients of a rational Chebyshev fit of log(erfc(x) exp(x^2) / t), relative error about 1e-7.
_ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    t = 1 / (1 + x / 2)
    fit = F.lit(_ERFC[-1])
    for c in reversed(_ERFC[:-1]):
        fit = fit * t + c
    return t * F.exp(-x * x + fit)


def normal_p(z: Column) -> Column:
    """Two-sided p of a standard normal value."""
    return erfc(F.abs(z) / math.sqrt(2))


def two_proportion_z(x1: Column, n1: Column, x2: Column, n2: Column) -> tuple[Column, Column]:
    """z and two-sided p with pooled variance; null without trials or variance."""
    n1, n2 = F.nullif(n1.cast("double"), F.lit(0.0)), F.nullif(n2.cast("double"), F.lit(0.0))
    pooled = (x1 + x2) / (n1 + n2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    z = (x1 / n1 - x2 / n2) / F.nullif(error, F.lit(0.0))
    return z, normal_p(z)


def band(value: Column, cuts: list[tuple[float, str]], below: str) -> Column:
    """The name of the highest cut that the value reaches; ``below`` under all; null for null."""
    out = F.lit(below)
    for cut, name in sorted(cuts):
        out = F.when(value >= cut, F.lit(name)).otherwise(out)
    return F.when(value.isNotNull(), out)


#: How strong an agreement is.
LANDIS_KOCH = [(0.0, "slight"), (0.21, "fair"), (0.41, "moderate"), (0.61, "substantial"), (0.81, "almost perfect")]


def landis_koch(kappa: Column) -> Column:
    return band(kappa, LANDIS_KOCH, "poor")


def sample_size(p: Column, difference: Column, alpha: float = 0.05) -> Column:
    """Least n whose interval for p is as narrow as the difference: ceil(z^2 p (1 - p) / (difference / 2)^2)."""
    return F.ceil(z_of(alpha) ** 2 * p * (1 - p) / F.pow(difference / 2, 2)).cast("long")


def gate_reason(area: Column, detectability: Column, weight: Column, addressability: Column, free: str = "none") -> Column:
    """Why an area gets no number, in order of precedence; null if it gets one. ``free`` is the code of no claim."""
    return (
        F.when(area == free, F.lit(None).cast("string"))
        .when(detectability.isin("weak", "none"), F.concat(F.lit("detectability "), detectability))
        .when(detectability.isNull(), "not present in taxonomy")
        .when(weight.isNull(), "no proximity weight")
        .when(addressability == 0, "not addressable")
    )


def opportunity(prevalence: Column, weight: Column, addressability: Column, gate: Column, severity: Column | None = None) -> Column:
    value = prevalence * weight * addressability
    return F.when(gate.isNull(), value if severity is None else value * severity)
