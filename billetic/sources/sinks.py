"""Writers and table-changing operators.

Pure forms (``upsert``, ``update_from``, ``delete_where``, ``replace_dates``,
``duplicate_keys``) take and return DataFrames; the ``*_into`` / ``write_*``
forms apply them to a date-partitioned Parquet table at ``path``.

Rules kept everywhere:

* Only the partitions (dates) a run touches are rewritten, with dynamic
  partition overwrite, so the cost of a run is proportional to its window,
  not to the table's history.
* A table is never overwritten from a plan that still reads it: the merged
  rows are first checkpointed into the session's checkpoint directory (the
  cluster's shared ``spark.checkpoint.dir``), which also cuts the lineage so
  a lost executor does not re-read a half-written table.
* Checks run in the pass that computes the rows, as observed metrics: a
  largest count per key, a flag, a mask of the dates present. All are maxima
  or bitwise ORs, so a task that runs twice leaves them as they are.
* Before a write the rows are rebalanced on the partition column (AQE
  splits a hot date and merges small ones), so one date does not become one
  straggling task and small dates do not become thousands of tiny files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billetic.sources.targets import Target, conform
from billetic.session import ensure_checkpoint_dir

APPEND, OVERWRITE, REPLACE_DATES = "append", "overwrite", "replace_dates"


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def ensure_target(spark: SparkSession, path: str, target: Target) -> None:
    """Create an empty table with the target's schema if none exists
    (``mode("ignore")`` writes nothing when the path is already there)."""
    empty = spark.createDataFrame([], target.schema)
    empty.write.mode("ignore").partitionBy(target.partition).parquet(path)


def read_target(spark: SparkSession, path: str, target: Target) -> DataFrame:
    """Read a target back in its declared column order (Parquet puts the
    partition column last)."""
    return conform(spark.read.schema(target.schema).parquet(path), target)


def write_target(df: DataFrame, path: str, target: Target, mode: str = REPLACE_DATES,
                 dates: Iterable[dt.date] | None = None) -> None:
    """S5/S6 + M2/M5/M6.

    * ``append`` (M2): the reference's ``INSERT``; re-running a window
      duplicates its rows.
    * ``overwrite`` (M5): ``TRUNCATE`` then reload.
    * ``replace_dates`` (M6): replace the dates present in ``df`` and, of the
      run's ``dates``, also those without any new row (they are emptied);
      re-running a window changes nothing (the repeatable form of M2). With
      ``dates`` the rows are computed once, into the checkpoint directory,
      where the same pass notes which of ``dates`` have rows (a bit each).
      The new dates are written before the empty ones go: a run that dies
      between the two leaves some to empty, which its rerun does.
    """
    out, empty = conform(df, target), []
    if mode == REPLACE_DATES and dates is not None:
        out, empty = _computed_without(out, target.partition, sorted(set(dates)))
    out = out.hint("rebalance", target.partition)
    writer = out.write.partitionBy(target.partition)
    if mode == APPEND:
        writer.mode("append").parquet(path)
    elif mode == OVERWRITE:
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    elif mode == REPLACE_DATES:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        drop_dates(df.sparkSession, path, target, empty)
    else:
        raise ValueError(f"unknown write mode {mode!r}")


def _computed_once(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df`` computed into the checkpoint directory, and the ``metrics`` over
    its rows, observed in the same pass (NULL where there are no rows)."""
    ensure_checkpoint_dir(df.sparkSession)
    if not metrics:
        return df.checkpoint(eager=True), {}
    seen = Observation()
    out = df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).checkpoint(eager=True)
    return out, seen.get


def _computed_without(df: DataFrame, day: str, dates: Sequence[dt.date]) -> tuple[DataFrame, list[dt.date]]:
    """``df`` computed once, and those of the ascending ``dates`` it has no row
    on, from one 64-bit mask per 64 days of their span."""
    if not dates:
        return _computed_once(df)[0], []
    span = (dates[-1] - dates[0]).days
    nth = F.datediff(F.col(day), F.lit(dates[0]))
    masks = {
        f"mask_{w}": F.bit_or(F.when(nth.between(64 * w, 64 * w + 63), _bit(nth - 64 * w)))
        for w in range(span // 64 + 1)
    }
    out, seen = _computed_once(df, **masks)
    at = {d: divmod((d - dates[0]).days, 64) for d in dates}
    return out, [d for d, (w, bit) in at.items() if not (seen[f"mask_{w}"] or 0) >> bit & 1]


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))


def drop_dates(spark: SparkSession, path: str, target: Target, dates: Sequence[dt.date]) -> None:
    """Remove whole dates from a stored table: their partition folders go, no
    job runs and no other date is touched. Dates that are not there are none
    of its business, so a repeated call is harmless."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for day in dates:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{target.partition}={day.isoformat()}")
        folder.getFileSystem(conf).delete(folder, True)


# -- pure table-changing operators -------------------------------------------

def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """M1, ``MERGE``: matched target rows take the source row, unmatched
    source rows are inserted, other target rows stay.

    ``null_safe=True`` treats NULL keys as equal (a NULL-label row is
    updated on the next run); ``False`` is the SQL ``=`` of the reference,
    under which such a row is inserted again on every run. Source keys must
    be unique (check with ``duplicate_keys``).
    """
    src_keys = source.select(*keys)
    kept = target.join(src_keys, _key_cond(target, src_keys, keys, null_safe), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    assignments: dict[str, str],
) -> DataFrame:
    """M3, ``UPDATE t SET t.c = s.v FROM t JOIN s ON keys``: target rows
    with a matching source row take ``s.v`` for each ``c`` (even a NULL
    ``v``), the others are unchanged; no row is added or removed. Plain
    equality: NULL keys never match. Source keys must be unique."""
    s = source.select(
        *[F.col(k).alias(f"_src_{k}") for k in keys],
        F.lit(True).alias("_src_hit"),
        *[F.col(v).alias(f"_src_val_{c}") for c, v in assignments.items()],
    )
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"_src_{k}")
        cond = c if cond is None else cond & c
    joined = target.join(s, cond, "left")
    hit = F.col("_src_hit").isNotNull()
    cols = [
        F.when(hit, F.col(f"_src_val_{c}")).otherwise(F.col(c))
        .cast(target.schema[c].dataType).alias(c)
        if c in assignments
        else F.col(c)
        for c in target.columns
    ]
    return joined.select(*cols)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """M4, ``DELETE WHERE cond``: rows where ``cond`` is true go; rows where it
    is false *or NULL* stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def replace_dates(target: DataFrame, source: DataFrame, day: str) -> DataFrame:
    """M6 as a pure operator: the target without the source's dates, plus the
    source. A NULL date is a date like the others (dynamic partition
    overwrite replaces the NULL partition too)."""
    dates = source.select(F.col(day).alias("_day")).distinct()
    kept = target.join(dates, target[day].eqNullSafe(dates["_day"]), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """M7: keys that occur more than once (the unenforced UNIQUE constraint,
    checked). Empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


# -- the same, applied to a stored table -------------------------------------

def _affected(spark: SparkSession, path: str, target: Target, dates: DataFrame,
              known_dates=None) -> DataFrame:
    """The target's rows on the dates being rewritten. With the dates known
    on the driver (a run's window) they are a literal ``IN`` on the
    partition column, which prunes partitions at planning time; otherwise a
    semi-join with the source's dates."""
    current = read_target(spark, path, target)
    if known_dates is not None:
        current = current.filter(F.col(target.partition).isin(list(known_dates)))
    return current.join(dates, target.partition, "left_semi")


def _checked_source(source: DataFrame, keys: Sequence[str], nulls_match: bool, day: str,
                    known_dates, refusal: str) -> DataFrame:
    """The source computed once, refused if a key occurs twice (under plain
    equality a key with a NULL is like no other) or if a row lies outside
    ``known_dates``: these prune the target's partitions, so such a row would
    overwrite its date without the rows already there. Rows are grouped by
    key on the way, which moves nothing if the job's last step grouped them
    so, and both checks are metrics of that pass."""
    alone = F.lit(None).cast("long")
    if not nulls_match:
        some_null = F.lit(False)
        for k in keys:
            some_null = some_null | F.col(k).isNull()
        alone = F.when(some_null, F.monotonically_increasing_id())
    outside = F.lit(False)
    if known_dates is not None:
        outside = ~F.col(day).isin(list(known_dates)) | F.col(day).isNull()
    rest = [c for c in source.columns if c not in keys]
    by_key = source.withColumns({"_alone": alone, "_outside": outside}).groupBy(*keys, "_alone").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_outside").alias("_outside"), *[F.first(c).alias(c) for c in rest])
    out, seen = _computed_once(by_key, rows=F.max("_rows"), outside=F.max("_outside"))
    if (seen["rows"] or 0) > 1:
        raise ValueError(refusal)
    if seen["outside"]:
        raise ValueError("the source has dates outside known_dates")
    return out.select(*source.columns)


def upsert_into(
    spark: SparkSession, path: str, target: Target, source: DataFrame, null_safe: bool = True,
    known_dates=None,
) -> None:
    """M1 on storage: merge ``source`` into the dates it covers.

    The source is computed and checked in one pass, into the checkpoint
    directory; merge and write read that. Like ``MERGE``, refuses a source in
    which a key occurs twice (it would update one target row twice). ``known_dates``
    (the run's window, if the caller has it) bounds the dates the source can
    hold, so only those partitions of the target are read.
    """
    ensure_target(spark, path, target)
    src = _checked_source(conform(source, target), target.keys, null_safe, target.partition, known_dates,
                          f"source keys {target.keys} are not unique; MERGE would fail")
    dates = src.select(target.partition).distinct()
    merged = upsert(_affected(spark, path, target, dates, known_dates), src, target.keys, null_safe)
    write_target(merged.checkpoint(eager=True), path, target, REPLACE_DATES)


def update_into(
    spark: SparkSession,
    path: str,
    target: Target,
    source: DataFrame,
    keys: Sequence[str],
    assignments: dict[str, str],
    known_dates=None,
) -> None:
    """M3 on storage: the source is computed once; only dates that have a
    matching source row are read and rewritten (``known_dates`` prunes them at planning time)."""
    ensure_target(spark, path, target)
    source = _checked_source(source, keys, False, target.partition, known_dates,
                             f"source keys {list(keys)} are not unique; a row would be updated twice")
    dates = source.select(F.col(target.partition)).distinct()
    updated = update_from(_affected(spark, path, target, dates, known_dates), source, keys,
                          assignments)
    write_target(updated.checkpoint(eager=True), path, target, REPLACE_DATES)


def delete_from(spark: SparkSession, path: str, target: Target, cond: Column) -> None:
    """M4 on storage: rewrites the whole table (the reference deletes over
    all dates)."""
    ensure_checkpoint_dir(spark)
    kept = delete_where(read_target(spark, path, target), cond).checkpoint(eager=True)
    write_target(kept, path, target, OVERWRITE)
