"""Day filters (P4-P7) written so that the bound reaches the Parquet scan.

``CAST(ts AS DATE) >= d`` for a per-row or per-execution-date ``d`` cannot be
pushed into a scan. What *can* be pushed is a literal bound on the raw column
with the column's own type; the window is known on the driver, so every job
first states the widest literal range its dates can need (``day_range``) and
then applies the exact per-date predicate on the surviving rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billetic.functions._cols import as_col
from billetic.functions.dates import to_day
from billetic.operators.window import DateWindow


def _literal_like(df: DataFrame, col: str, day: dt.date) -> Column:
    """Midnight of ``day`` as a literal of ``col``'s type (date, timestamp or
    timestamp without time zone), so the comparison is not wrapped in a cast
    and Catalyst pushes it to the source."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.DateType):
        return F.lit(day).cast("date")
    text = F.lit(day.isoformat() + " 00:00:00")
    if isinstance(dtype, T.TimestampNTZType):
        return text.cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return text.cast("timestamp")
    raise TypeError(f"{col} is {dtype.simpleString()}, expected a date or timestamp")


def day_range(
    df: DataFrame, col: str, lo: dt.date | None = None, hi_exclusive: dt.date | None = None
) -> DataFrame:
    """Keep rows whose calendar day of ``col`` is in ``[lo, hi_exclusive)``,
    as a pushable range on the raw column."""
    cond = None
    if lo is not None:
        cond = F.col(col) >= _literal_like(df, col, lo)
    if hi_exclusive is not None:
        upper = F.col(col) < _literal_like(df, col, hi_exclusive)
        cond = upper if cond is None else cond & upper
    return df if cond is None else df.filter(cond)


def on_days(df: DataFrame, ts: str, window: DateWindow, day_col: str = "day") -> DataFrame:
    """P4, ``CAST(ts AS DATE) = d`` for every execution date ``d``: the window
    is contiguous, so this is one literal range, plus the day as a column."""
    out = day_range(df, ts, window.start, window.end + dt.timedelta(days=1))
    return out.withColumn(day_col, to_day(ts))


def on_day_set(df: DataFrame, ts: str, days: list[dt.date], day_col: str = "day") -> DataFrame:
    """``CAST(ts AS DATE) IN days`` for a non-contiguous set: the enclosing
    literal range (pushed) and then exact membership."""
    days = sorted(set(days))
    out = day_range(df, ts, days[0], days[-1] + dt.timedelta(days=1))
    out = out.withColumn(day_col, to_day(ts))
    return out.filter(F.col(day_col).isin(days))


def lookback(df: DataFrame, ts: str, window: DateWindow, months: int = 12) -> DataFrame:
    """P5/P6 literal part: rows that can satisfy ``day >= d - months`` for at
    least one execution date (no upper bound, as in the reference)."""
    return day_range(df, ts, window.earliest_lookback(months))


def since_account_start(day, created, bound) -> Column:
    """``day >= CASE WHEN created < bound THEN bound ELSE created END``.

    Written as ``when``, not ``greatest``: ``greatest`` skips a NULL
    ``created`` and would keep the row, the CASE form drops it.
    """
    c, b = as_col(created), as_col(bound)
    return as_col(day) >= F.when(c < b, b).otherwise(c)


def in_key_range(df: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``col`` lies between the least and the greatest ``col`` of
    ``keys`` (both kept), as literals that reach the scan: files and row
    groups outside the range are skipped. One small job reads ``keys`` (pass
    stored ones); two values reach the driver. No keys: no rows."""
    lo, hi = keys.agg(F.min(col), F.max(col)).first()
    return df.filter(F.lit(False) if lo is None else F.col(col).between(F.lit(lo), F.lit(hi)))
