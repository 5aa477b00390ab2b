"""Late data (T1 + M6): a file stream over a fact table's folder tells which
days got new rows, however old, and only the dates these days touch are
computed and replaced.

The trailing refresh recomputes the last 8 dates whatever arrived; rows older
than that are found here. The stream's checkpoint remembers the files it has
seen, and each micro-batch recomputes whole dates from the fact table, so a
batch that is repeated after a failure gives the same table, and a run without
new files does nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billetic.functions import to_day
from billetic.operators import DateWindow, add_months
from billetic.sources.sinks import REPLACE_DATES, ensure_target, write_target
from billetic.streaming.refresh import JOBS


def _same_day(day: dt.date) -> list[dt.date]:
    return [day]


def _and_next_year(day: dt.date) -> list[dt.date]:
    """J9 shows a day and, as the previous year, every d whose
    ``add_months(d, -12)`` it is (28 February: the 28th and a 29th)."""
    later = [add_months(day, 12) + dt.timedelta(days=k) for k in (0, 1)]
    return [day, *[d for d in later if add_months(d, -12) == day]]


@dataclass(frozen=True)
class LateJob:
    fact: str                 # the logical source whose new rows are followed
    time: str                 # its time column
    touched: Callable[[dt.date], list[dt.date]] = _same_day


# The jobs whose rows of a date come from that day alone (J9: and from the day
# a year before). Jobs with a 12-month lookback would be touched on every date
# since; ``refresh_last_seen(since=...)`` takes corrections for those.
LATE_JOBS = {
    "title_sales_by_support": LateJob("sales", "bd_transaction_date"),
    "sales_by_channel": LateJob("sales", "bd_transaction_date"),
    "clients_by_line": LateJob("validation", "DTHR_OPERATION"),
    "validation_rate_per_user": LateJob("validation", "DTHR_OPERATION"),
    "validation_counts_yoy": LateJob("validation", "DTHR_OPERATION", _and_next_year),
}


def windows_of(days: Iterable[dt.date], gap: int = 7) -> list[DateWindow]:
    """Runs of dates as windows: dates at most ``gap`` days apart share one (the
    dates between are computed again, to the same rows), so that scattered
    dates do not become one job each."""
    out: list[DateWindow] = []
    for day in sorted(set(days)):
        if out and (day - out[-1].end).days <= gap:
            out[-1] = DateWindow(out[-1].start, day)
        else:
            out.append(DateWindow.single(day))
    return out


def refresh_late(
    spark: SparkSession, name: str, sources, landing: str, as_of: dt.date, path: str, checkpoint: str,
) -> list[dt.date]:
    """Replace the dates before ``as_of`` of the report at ``path`` that files
    new in ``landing`` (the Parquet folder of the job's fact table, which
    ``sources`` reads too) touch; returns these dates, ascending.

    ``checkpoint`` is the stream's own folder, on shared storage; a new one
    sees all files as new and so derives all dates. Rows without a time touch
    nothing. Only the distinct days of a batch reach the driver: they grow
    with the calendar, not with the rows."""
    late, job = LATE_JOBS[name], JOBS[name]
    ensure_target(spark, path, job.target)
    replaced: set[dt.date] = set()

    def batch(rows: DataFrame, _id: int) -> None:
        found = rows.select(to_day(late.time).alias("day")).filter(F.col("day").isNotNull()).distinct()
        days = {d for r in found.collect() for d in late.touched(r.day) if d < as_of}
        for window in windows_of(days):
            df = job.compute(sources, window, as_of)
            write_target(df, path, job.target, REPLACE_DATES, dates=window.days())
        replaced.update(days)

    files = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
    query = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()
    return sorted(replaced)
