"""Calendar helpers as Spark Columns (all JVM-side, codegen friendly).

The reference's dialect counts *boundaries crossed*, not elapsed time:

* ``DATEDIFF(YEAR, a, b)`` is ``year(b) - year(a)``: the birthday is ignored.
* ``DATEDIFF(WEEK, a, b)`` is the number of Saturday -> Sunday midnights
  between the two days (weeks start on Sunday whatever the session's first
  day of week is).
* ``DATEDIFF(DAY, a, b)`` is the number of midnights, which is Spark's
  ``datediff(b, a)`` on the two calendar days.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billetic.functions._cols import as_col


def to_day(c) -> Column:
    """``CAST(x AS DATE)``: the calendar day of a date or timestamp."""
    return as_col(c).cast("date")


def year_diff(start, end) -> Column:
    """``DATEDIFF(YEAR, start, end)``: difference of the year numbers."""
    return F.year(as_col(end)) - F.year(as_col(start))


def _week_index(c) -> Column:
    # 1970-01-01 was a Thursday, so day n since the epoch lies in the
    # Sunday-started week floor((n + 4) / 7). floor, not div: div truncates
    # toward zero and would be wrong before 1970.
    return F.floor((F.unix_date(to_day(c)) + F.lit(4)) / F.lit(7))


def week_diff(start, end) -> Column:
    """``DATEDIFF(WEEK, start, end)``: Saturday -> Sunday crossings (int)."""
    return (_week_index(end) - _week_index(start)).cast("int")


def day_diff(start, end) -> Column:
    """``DATEDIFF(DAY, start, end)``: midnights between the two days."""
    return F.datediff(to_day(end), to_day(start))


def month_start(c) -> Column:
    """``DATEFROMPARTS(YEAR(d), MONTH(d), 1)``."""
    return F.trunc(to_day(c), "MM")


def covers(start, end, period_start, period_end) -> Column:
    """A contract covers a whole period: it starts on or before the period's
    first day and ends on or after its last day (NULL dates -> NULL)."""
    return (to_day(end) >= as_col(period_end)) & (to_day(start) <= as_col(period_start))
