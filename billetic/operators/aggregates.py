"""Aggregation operators (A4, A9 and the per-date "active since" count).

Exact distinct counts only (never approximate). Every aggregate here is a
plain ``groupBy().agg()`` so Spark runs a partial aggregate before each
shuffle: a key holding a third of all rows reaches the exchange as one row per
map task, never as one giant group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billetic.operators.window import broadcast_spine


def conditional_distinct(
    df: DataFrame, keys: Sequence[str], value: str, preds: dict[str, Column]
) -> DataFrame:
    """Several ``COUNT(DISTINCT CASE WHEN p THEN value END)`` side by side.

    Two chained group-bys: ``(keys, value) -> max(flag)`` then
    ``keys -> sum(flag)``. Spark's own plan for several ``countDistinct``
    replicates every row once per distinct expression (``Expand``); this
    form reads each row once. A group whose rows all fail (or have a NULL
    ``value``) is kept with zeros, as in the grouped SQL.
    """
    keys = list(keys)
    v = F.col(value)
    flags = [
        F.max(F.when(v.isNotNull() & p, F.lit(1)).otherwise(F.lit(0))).alias(name)
        for name, p in preds.items()
    ]
    per_value = df.groupBy(*keys, value).agg(*flags)
    return per_value.groupBy(*keys).agg(
        *[F.sum(name).cast("long").alias(name) for name in preds]
    )


def last_seen(
    df: DataFrame, entity: Sequence[str], day: str, keys: Sequence[str] = (), out_day: str = "last_day",
) -> DataFrame:
    """``(keys, entity) -> latest day``, NULL being a value like any other."""
    return df.groupBy(*keys, *entity).agg(F.max(day).alias(out_day))


def last_day_histogram(
    latest: DataFrame, entity: Sequence[str], keys: Sequence[str] = (), day: str = "last_day",
    out_count: str = "n",
) -> DataFrame:
    """``(keys, last_day) -> number of entities`` of a ``last_seen`` table. An
    entity whose columns are all NULL is none (``COUNT(DISTINCT ...)`` ignores
    it), but its group stays, with 0."""
    known = reduce(or_, (F.col(e).isNotNull() for e in entity))
    return latest.groupBy(*keys, day).agg(F.count(F.when(known, 1)).alias(out_count))


def last_seen_histogram(
    df: DataFrame,
    entity: Sequence[str],
    day: str,
    keys: Sequence[str] = (),
    out_day: str = "last_day",
    out_count: str = "n",
) -> DataFrame:
    """``(keys, last_day) -> number of entities whose latest day is last_day``.

    "Entity e has a day >= b" is "latest day of e >= b", so any number of
    per-date lower bounds can later be answered from this small table
    (``count_at_least``) instead of joining every fact row to every date.
    Its size is bounded by the number of distinct days times the key groups,
    not by the number of entities.
    """
    return last_day_histogram(last_seen(df, entity, day, keys, out_day), entity, keys, out_day, out_count)


def count_at_least(
    hist: DataFrame,
    spine: DataFrame,
    value: str,
    bound: Column,
    d: str = "d",
    keys: Sequence[str] = (),
    on: Column | None = None,
    n: str = "n",
    out: str = "cnt",
) -> DataFrame:
    """For each spine row and key group: ``sum(n)`` over histogram rows with
    ``value >= bound`` (and the optional extra join condition ``on``).

    Both inputs are small (the spine has one row per date, the histogram one
    per distinct day and group), so the inequality join is cheap; groups
    without any qualifying row are absent, like the SQL ``GROUP BY``.
    """
    cond = F.col(value) >= bound
    if on is not None:
        cond = cond & on
    joined = hist.join(broadcast_spine(spine), cond, "inner")
    return joined.groupBy(d, *keys).agg(F.sum(n).cast("long").alias(out))


def with_zero_rows(spine: DataFrame, df: DataFrame, d: str, cols: Sequence[str]) -> DataFrame:
    """One row per spine date even when the aggregate has none; missing
    counts become 0 (a global ``COUNT`` over no rows is 0)."""
    joined = spine.select(d).join(df, d, "left")
    return joined.select(d, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in cols])

