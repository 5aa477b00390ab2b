"""Arithmetic with the reference's NULL and integer rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billetic.functions._cols import as_col


def nullif_zero(c) -> Column:
    """``NULLIF(x, 0)``."""
    col = as_col(c)
    return F.when(col != F.lit(0), col)


def safe_ratio(num, den) -> Column:
    """``CAST(num AS FLOAT) / NULLIF(den, 0)`` -> double, NULL on a zero or
    NULL divisor (Spark 4 ANSI mode would raise on a plain division by 0)."""
    return as_col(num).cast("double") / nullif_zero(den).cast("double")


def int_div(num, den) -> Column:
    """Whole-number division of two integers, truncating toward zero like
    ``int / int`` in the reference; NULL on a zero divisor.

    ``n - n % d`` is an exact multiple of ``d`` (``%`` keeps the dividend's
    sign), so the division is exact for counts below 2**53.
    """
    n = as_col(num).cast("long")
    d = nullif_zero(den).cast("long")
    return ((n - n % d) / d).cast("long")
