"""Interval join (N6, F10): spans of whole numbers meet the points inside them.

Spark plans a join on ``lo <= at AND at <= hi`` alone as a nested loop. Here
each span is copied to the bins of ``width`` numbers it touches, meets the
points of the same bin in an equi-join, and an exact filter decides. The plan
has the same size for any number of points or any length of their range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billetic.functions import to_day

_BIN = "__bin"


def month_number(day) -> Column:
    """Months counted through the years, so that spans of months are spans of
    whole numbers."""
    d = to_day(day)
    return F.year(d) * 12 + F.month(d)


def covered_months(start, end) -> tuple[Column, Column]:
    """The first and the last month (``month_number``) that lie whole inside
    ``[start, end]``, both days included; no month does when the first is
    greater than the last. A NULL day gives a NULL end of the span."""
    return month_number(F.date_sub(to_day(start), 1)) + 1, month_number(F.date_add(to_day(end), 1)) - 1


def interval_join(
    spans: DataFrame, points: DataFrame, lo: str, hi: str, at: str,
    first: int, last: int, width: int, keys: Sequence[str] = (),
) -> DataFrame:
    """Every span with every point ``lo <= at <= hi`` of the same ``keys``;
    both sides' columns are kept (``keys`` once). Points lie in
    ``[first, last]``: a span is copied once per bin between these, at most
    ``(last - first) / width + 2`` times, however long it is. Spans that end
    before they begin, or with a NULL end, meet nothing; NULL keys never match.

    The points are shuffled or broadcast by their size like any other side;
    callers hint the broadcast where they know a bound."""
    a, b = F.greatest(F.col(lo), F.lit(first)), F.least(F.col(hi), F.lit(last))
    inside = (F.col(lo) <= F.col(hi)) & (F.col(lo) <= F.lit(last)) & (F.col(hi) >= F.lit(first))

    def bin_of(c):
        return F.floor(c / F.lit(width))

    binned = spans.withColumn(_BIN, F.explode(F.when(inside, F.sequence(bin_of(a), bin_of(b)))))
    located = points.withColumn(_BIN, bin_of(F.col(at)))
    return binned.join(located, [_BIN, *keys]).filter(
        F.col(at).between(F.col(lo), F.col(hi))).drop(_BIN)
