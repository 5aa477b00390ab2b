"""First row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], rn: str = "_rn"
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``.

    Pass a total order (add tie-breakers): with ties the pick would be
    arbitrary and a recomputed task could pick differently. Catalyst turns
    ``row_number() == 1`` into a ``WindowGroupLimit`` that keeps one row per
    key inside each map task before the shuffle, so a very large group is
    reduced before it is moved.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
