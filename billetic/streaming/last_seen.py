"""Kept last-seen state (J2, J6 / A4): the latest day of each entity, carried
from run to run, so that a daily run reads its window's facts and not twelve
months of them.

The state is one row per entity, stored as one folder per run
(``path/as_of=<date>``). A run starts from the newest complete folder older
than its own date and writes its own, so repeating a run gives the same state
and a run that died leaves nothing that another would read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billetic.operators import DateWindow
from billetic.operators.aggregates import last_seen
from billetic.plans import clients, sales
from billetic.session import staged
from billetic.sources import targets as T
from billetic.sources.sinks import REPLACE_DATES, ensure_target, read_target, write_target

LAST = "last_day"


def _runs(spark: SparkSession, path: str) -> list[dt.date]:
    """The dates of the complete runs kept at ``path``, ascending."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    root = Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    return sorted(dt.date.fromisoformat(n.removeprefix("as_of=")) for n in names
                  if n.startswith("as_of=") and fs.exists(Path(f"{path}/{n}/_SUCCESS")))


def _forget(spark: SparkSession, path: str, runs: Sequence[dt.date]) -> None:
    for run in runs:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/as_of={run.isoformat()}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def advance(
    spark: SparkSession, path: str, facts: Callable[[dt.date], DataFrame], entity: Sequence[str],
    window: DateWindow, as_of: dt.date, day: str = "_day", since: dt.date | None = None,
) -> DataFrame:
    """The latest day (``last_day``) of every entity with a day in the
    window's 12-month lookback, derived from the state of the run before and
    stored as the state of ``as_of``.

    ``facts(d)`` gives the rows (``entity`` columns and ``day``) from day d on,
    with the bound pushed to their scan. They are read from the window's first
    day, or from the last run's date if that is earlier (skipped runs), or from
    ``since`` (corrections of older days); the first run reads the lookback.

    The max is merged, not added to: an entity last seen in the days read
    takes the latest day they hold *now*. Where they hold none any more
    (deleted or corrected rows) its latest day lies before them and cannot
    be known from the state, so only these entities are looked up in the
    lookback again (semi-join; no scan if there are none). The result
    equals a full run as long as older days did not change. NULLs in
    entity columns are values. The state keeps the last two runs."""
    entity = list(entity)
    oldest = window.earliest_lookback()
    before = [r for r in _runs(spark, path) if r < as_of]
    if before:
        start = max(oldest, min(d for d in (window.start, before[-1], since) if d is not None))
        old = spark.read.parquet(f"{path}/as_of={before[-1].isoformat()}").filter(F.col(LAST) >= F.lit(oldest))
        none = F.lit(None).cast("date")
        fresh = last_seen(facts(start), entity, day, out_day=LAST)
        merged = staged(old.select(*entity, F.col(LAST).alias("_old"), none.alias("_new")).unionByName(
            fresh.select(*entity, none.alias("_old"), F.col(LAST).alias("_new"))
        ).groupBy(*entity).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new")), "last-seen")
        lost = F.col("_new").isNull() & (F.col("_old") >= F.lit(start))
        latest = merged.filter(~lost).select(*entity, F.coalesce("_new", "_old").alias(LAST))
        gone = merged.filter(lost).select(*[F.col(e).alias(f"_gone_{e}") for e in entity])
        if not gone.isEmpty():
            rows = facts(oldest)
            same = [F.col(e).eqNullSafe(F.col(f"_gone_{e}")) for e in entity]
            latest = latest.unionByName(last_seen(rows.join(gone, same, "left_semi"), entity, day, out_day=LAST))
    else:
        latest = last_seen(facts(oldest), entity, day, out_day=LAST)
    stored = f"{path}/as_of={as_of.isoformat()}"
    latest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(stored)
    _forget(spark, path, before[:-1])
    return spark.read.schema(latest.schema).parquet(stored)


def _total_clients(spark, sources, window, as_of, state, since):
    latest = advance(spark, state, lambda d: sales.sale_clients(sources.sales(), d),
                     [*sales.CLIENT_KEYS, *sales.CLIENT], window, as_of, since=since)
    return sales.total_clients_of(latest, window)


def _active_clients(spark, sources, window, as_of, state, since):
    latest = advance(spark, state, lambda d: clients.card_days(sources.validation(), d),
                     clients.CARD_MONTH, window, as_of, since=since)
    per_card = latest.select(*clients.CARD_MONTH, F.col(LAST).alias("_last"), F.lit(None).cast("date").alias("_first"))
    return clients.active_clients_of(per_card, sources.card(), window)


KEPT = {"total_clients": (T.TOTAL_CLIENTS, _total_clients), "active_clients": (T.ACTIVE_CLIENTS, _active_clients)}


def refresh_last_seen(
    spark: SparkSession, name: str, sources, as_of: dt.date, path: str, state: str,
    start_back: int = 8, end_back: int = 1, since: dt.date | None = None,
) -> DataFrame:
    """``refresh`` of J2 or J6 from the state kept at ``state``: same rows,
    but the facts of the window are all that is read. Returns the run's dates
    of the stored table. Cards are joined at read time, so a card that enters
    or leaves the register counts from the next run on, as in a full run."""
    target, compute = KEPT[name]
    window = DateWindow.trailing(as_of, start_back, end_back)
    df = compute(spark, sources, window, as_of, state, since)
    ensure_target(spark, path, target)
    write_target(df, path, target, REPLACE_DATES, dates=window.days())
    return read_target(spark, path, target).filter(
        F.col(target.partition).between(F.lit(window.start), F.lit(window.end)))
