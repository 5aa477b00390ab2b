"""Joins the loop creates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billetic.operators.window import broadcast_spine


def spine_join(df: DataFrame, spine: DataFrame, cond: Column) -> DataFrame:
    """Every row with every execution date it qualifies for.

    The spine is broadcast (its size is the window's day count), so the fact
    side is never shuffled for this join. Use it on *reduced* rows: the
    output has up to one copy of each input row per date.
    """
    return df.join(broadcast_spine(spine), cond, "inner")


def shift_join(
    current: DataFrame,
    previous: DataFrame,
    day: str,
    keys: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """N7 + M3 in one step: each current row gets ``value`` of the previous
    rows with the same keys whose (already shifted) ``day`` equals its own,
    else 0. Plain equality: a NULL key never matches, as in the reference's
    ``UPDATE ... JOIN``."""
    prev = previous.select(
        F.col(day).alias("_shift_day"), *[F.col(k).alias(f"_shift_{k}") for k in keys],
        F.col(value).alias(out),
    )
    cond = F.col(day) == F.col("_shift_day")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_shift_{k}"))
    joined = current.join(prev, cond, "left")
    return joined.select(
        *current.columns, F.coalesce(F.col(out), F.lit(0)).alias(out)
    )
