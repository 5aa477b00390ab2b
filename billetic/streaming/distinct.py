"""Kept distinct taps (J9 / A3): the ids of each day and product as words of
64 bits (``operators.bitmaps``), stored by day.

Sets merge where counts do not: rows that arrive later, or twice, are put in
by ``bit_or`` without reading their day's other rows again, and the distinct
ids of a week or a month come from its days' words. Integer ids only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billetic.operators import DateWindow, add_months, count_words, merge_words
from billetic.plans import validations
from billetic.session import staged
from billetic.sources import targets as T
from billetic.sources.sinks import REPLACE_DATES, ensure_target, read_target, write_target

DAY = T.TAP_WORDS.partition
KEYS = validations.DAY_PRODUCT


def merge_taps(spark: SparkSession, state: str, taps: DataFrame) -> list[dt.date]:
    """Put new ``taps`` (logical validation rows, of any days) into the words
    kept at ``state``; returns the days they touch, ascending.

    Only these days' words are read and written, no other tap is. Merging is
    idempotent: a batch that is repeated, or a file delivered twice, changes
    nothing. Rows without a time are no day's. The distinct days of a batch
    are all that reaches the driver."""
    ensure_target(spark, state, T.TAP_WORDS)
    words = validations.tap_words(taps, None, None).filter(F.col(DAY).isNotNull())
    new = staged(words, "tap-words")
    days = sorted(r[0] for r in new.select(DAY).distinct().collect())
    if days:
        old = read_target(spark, state, T.TAP_WORDS).filter(F.col(DAY).isin(days))
        merged = staged(merge_words(old.unionByName(new), KEYS), "tap-words")
        write_target(merged, state, T.TAP_WORDS, REPLACE_DATES)
    return days


def recount_days(spark: SparkSession, state: str, taps: DataFrame, start: dt.date, end: dt.date) -> None:
    """Replace the days from ``start`` up to (not including) ``end`` by what
    ``taps`` holds of them now: corrected or deleted rows leave the state
    here, as merging never takes an id out. The range is pushed to the scan."""
    ensure_target(spark, state, T.TAP_WORDS)
    days = [start + dt.timedelta(days=k) for k in range((end - start).days)]
    write_target(validations.tap_words(taps, start, end), state, T.TAP_WORDS, REPLACE_DATES, dates=days)


def _counted(spark: SparkSession, state: str) -> set[dt.date]:
    """The days counted in full, which merged rows alone say nothing about;
    kept beside the state, one row a day. Empty if it is not there or was left
    empty by a run that died: what is needed is counted again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{state}-counted")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return set()
    return {r.day for r in spark.read.schema("day date").parquet(f"{state}-counted").collect()}


def _set_counted(spark: SparkSession, state: str, days: set[dt.date]) -> None:
    spark.createDataFrame([(d,) for d in sorted(days)], "day date").coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{state}-counted")


def refresh_counts(
    spark: SparkSession, sources, as_of: dt.date, path: str, state: str, start_back: int = 8, end_back: int = 1,
) -> DataFrame:
    """``refresh`` of J9 from the words kept at ``state``: same rows, but a run
    reads the taps of its window, and of the days a year before only those
    never counted in full (none once a year is kept). Returns the run's
    dates of the report.

    Corrections of older days need ``recount_days``, late rows
    ``merge_taps``; both also serve the dates a year later. Days no run ever
    covered are not in the state, but for rows that were merged."""
    window = DateWindow.trailing(as_of, start_back, end_back)
    counted, one = _counted(spark, state), dt.timedelta(days=1)
    missing = sorted({add_months(d, -12) for d in window.days()} - counted)
    if missing:
        recount_days(spark, state, sources.validation(), missing[0], missing[-1] + one)
    recount_days(spark, state, sources.validation(), window.start, window.end + one)
    _set_counted(spark, state, counted.union(missing, window.days()))
    ensure_target(spark, path, T.VALIDATION_COUNTS)
    counts = validations.validation_counts_of(read_target(spark, state, T.TAP_WORDS), window)
    write_target(counts, path, T.VALIDATION_COUNTS, REPLACE_DATES, dates=window.days())
    return read_target(spark, path, T.VALIDATION_COUNTS).filter(
        F.col(T.VALIDATION_COUNTS.partition).between(F.lit(window.start), F.lit(window.end)))


def distinct_by_period(words: DataFrame, period: str, out: str = "n") -> DataFrame:
    """Distinct ids per ``period`` ("week", "month", "quarter" or "year") and
    product from day words: an id seen on several days counts once."""
    first = F.trunc(DAY, period).alias("period_start")
    merged = merge_words(words.withColumn("period_start", first), ["period_start", KEYS[1]])
    return count_words(merged, ["period_start", KEYS[1]], out)
