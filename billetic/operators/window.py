"""Execution dates (T1-T4): the trailing backfill window and its period bounds.

The reference runs every KPI statement once per execution date in a loop
(today-8 ... today-1). Here the dates are *data*: a small spine DataFrame
joined to the facts, so one Spark job computes all dates at once and the date
is part of the grouping key. The window is also known on the driver as plain
Python dates (no job, no collect), which lets the jobs state literal bounds
that Parquet can use to skip row groups.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the period-bound columns added by ``with_period_bounds``.
D = "d"
MONTH_START = "month_start"
MONTH_END = "month_end"
LAST_MONTH_START = "last_month_start"
LAST_MONTH_END = "last_month_end"
LAST_YEAR_START = "last_year_start"
LAST_YEAR_END = "last_year_end"
TWELVE_MONTHS_AGO = "twelve_months_ago"


def add_months(day: dt.date, months: int) -> dt.date:
    """Python twin of Spark ``add_months`` (clamps to the month's last day)."""
    idx = day.year * 12 + (day.month - 1) + months
    year, month = divmod(idx, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


def first_of_month(day: dt.date) -> dt.date:
    return day.replace(day=1)


@dataclass(frozen=True)
class DateWindow:
    """Inclusive range of execution dates."""

    start: dt.date
    end: dt.date

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError(f"empty window {self.start} .. {self.end}")

    @classmethod
    def trailing(cls, as_of: dt.date, start_back: int = 8, end_back: int = 1) -> "DateWindow":
        """``as_of - start_back`` ... ``as_of - end_back``: the reference's
        ``GETDATE() - 8`` ... ``GETDATE() - 1`` (8 dates, both ends in)."""
        as_of = _as_date(as_of)
        return cls(as_of - dt.timedelta(days=start_back), as_of - dt.timedelta(days=end_back))

    @classmethod
    def single(cls, day: dt.date) -> "DateWindow":
        day = _as_date(day)
        return cls(day, day)

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1

    def days(self) -> list[dt.date]:
        return [self.start + dt.timedelta(days=i) for i in range(self.n_days)]

    def month_starts(self) -> list[dt.date]:
        """Distinct first-of-month dates of the window, ascending."""
        return sorted({first_of_month(d) for d in self.days()})

    def earliest_lookback(self, months: int = 12) -> dt.date:
        """Least ``d - months`` over the window: a literal lower bound that
        is safe to push to the scan for any per-date ``>= d - months``."""
        return add_months(self.start, -months)


def _as_date(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x))


def date_spine(spark: SparkSession, window: DateWindow, name: str = D) -> DataFrame:
    """One row per execution date (T1), built on the cluster from two
    literals; no driver-side list is shipped."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(window.start), F.lit(window.end), F.expr("INTERVAL 1 DAY"))
        ).alias(name)
    )


def broadcast_spine(spine: DataFrame) -> DataFrame:
    """Broadcast hint for a spine. It has one row per date, so it grows with
    the calendar and never with the data (a century is 36,525 rows)."""
    return F.broadcast(spine)


def with_period_bounds(spine: DataFrame, d: str = D) -> DataFrame:
    """Per-date period bounds (T3): month, previous month, same month last
    year, and the 12-month lookback (``add_months`` clamps month ends the way
    the reference's ``DATEADD(MONTH, ...)`` does)."""
    dc = F.col(d)
    ms = F.trunc(dc, "MM")
    return spine.select(
        "*",
        ms.alias(MONTH_START),
        F.last_day(dc).alias(MONTH_END),
        F.add_months(ms, -1).alias(LAST_MONTH_START),
        F.last_day(F.add_months(ms, -1)).alias(LAST_MONTH_END),
        F.add_months(ms, -12).alias(LAST_YEAR_START),
        F.last_day(F.add_months(ms, -12)).alias(LAST_YEAR_END),
        F.add_months(dc, -12).alias(TWELVE_MONTHS_AGO),
    )
