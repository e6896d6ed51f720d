"""The library's functions under names for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .stats import _ERFC, z_of
from .text import _nfc


def _erfc(x: str) -> str:
    t, fit = f"(1 / (1 + ({x}) / 2))", str(_ERFC[-1])
    for c in reversed(_ERFC[:-1]):
        fit = f"({fit} * {t} + {c})"
    return f"{t} * exp(-({x}) * ({x}) + {fit})"


def register(spark: SparkSession, alpha: float = 0.05) -> None:
    """Temporary functions nfc, wilson_low, wilson_high, two_prop_z, normal_p and text_hash; all but nfc are expressions."""
    spark.udf.register("nfc", _nfc)
    z = z_of(alpha)
    middle = f"((x / nullif(n, 0) + {z * z} / (2 * n)) / (1 + {z * z} / n))"
    half = f"({z} * sqrt(x / n * (1 - x / n) / n + {z * z} / (4 * n * n)) / (1 + {z * z} / n))"
    pooled = "((x1 + x2) / nullif(n1 + n2, 0))"
    bare = r"regexp_replace(lower(t), '(?U)[^\\p{L}\\p{N}_\\s]', '')"
    for head, body in {
        "wilson_low(x DOUBLE, n DOUBLE) RETURNS DOUBLE": f"CASE WHEN n > 0 THEN greatest({middle} - {half}, 0D) END",
        "wilson_high(x DOUBLE, n DOUBLE) RETURNS DOUBLE": f"CASE WHEN n > 0 THEN least({middle} + {half}, 1D) END",
        "two_prop_z(x1 DOUBLE, n1 DOUBLE, x2 DOUBLE, n2 DOUBLE) RETURNS DOUBLE": f"CASE WHEN n1 > 0 AND n2 > 0 THEN (x1 / n1 - x2 / n2) / nullif(sqrt({pooled} * (1 - {pooled}) * (1 / n1 + 1 / n2)), 0) END",
        "normal_p(z DOUBLE) RETURNS DOUBLE": _erfc("abs(z) / sqrt(2)"),
        "text_hash(t STRING) RETURNS STRING": rf"sha1(regexp_replace(regexp_replace({bare}, '(?U)\\s+', ' '), '(?U)^\\s+|\\s+$', ''))",
    }.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
