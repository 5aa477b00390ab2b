"""Late files: the dates they touch, and only these, are replaced."""

import datetime as dt
import os

import pytest

from billetic.plans import registry as R
from billetic.plans.validations import validation_counts_yoy, validation_rate_per_user
from billetic.operators import DateWindow
from billetic.sources.catalog import CatalogSources
from billetic.sources.sinks import read_target
from billetic.sources.targets import VALIDATION_COUNTS, VALIDATION_RATE
from billetic.streaming import JOBS, LATE_JOBS, refresh, refresh_late
from billetic.streaming.late import windows_of

TAP = ("DTHR_OPERATION timestamp_ntz, bd_linkedcustomer long, bd_mobibnumber string, NUM_LIGNE long, "
       "LIBEL_LONG_PRODUIRE string, bd_support_class string, validation_id long")
AS_OF = dt.date(2024, 3, 5)


def land(spark, folder, *taps):
    rows = [(None if day is None else dt.datetime.combine(day, dt.time(9)), who, str(who), 1, "p", "S1", i)
            for i, (day, who) in enumerate(taps)]
    spark.createDataFrame(rows, TAP).coalesce(1).write.mode("append").parquet(folder)


def files(path):
    return {(os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns)
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_thirty_days_old_tap_changes_its_row_and_no_other(spark, tmp_path):
    facts, path, seen = f"{tmp_path}/facts", f"{tmp_path}/report", f"{tmp_path}/seen"
    folder, src = f"{facts}/validation", CatalogSources(spark, f"{tmp_path}/facts")
    old = AS_OF - dt.timedelta(days=30)
    recent = AS_OF - dt.timedelta(days=2)
    land(spark, folder, (old, 1), (old, 2), (recent, 1), (None, 3), (AS_OF, 5))
    assert refresh_late(spark, "validation_rate_per_user", src, folder, AS_OF, path, seen) == [old, recent]
    refresh(spark, "validation_rate_per_user", src, AS_OF, path)
    before = dict(rows(read_target(spark, path, VALIDATION_RATE)))
    assert before == {old: 1.0, recent: 1.0}
    kept = {f for f in files(path) if old.isoformat() not in f[0]}

    land(spark, folder, (old, 2))
    refresh(spark, "validation_rate_per_user", src, AS_OF, f"{tmp_path}/trailing")      # does not see it
    assert old not in dict(rows(read_target(spark, f"{tmp_path}/trailing", VALIDATION_RATE)))
    assert refresh_late(spark, "validation_rate_per_user", src, folder, AS_OF, path, seen) == [old]
    assert dict(rows(read_target(spark, path, VALIDATION_RATE))) == {old: 1.5, recent: 1.0}
    assert kept <= files(path)

    after = files(path)
    assert refresh_late(spark, "validation_rate_per_user", src, folder, AS_OF, path, seen) == []
    assert files(path) == after
    # a lost checkpoint sees all files as new: all dates again, the same rows
    stored = rows(read_target(spark, path, VALIDATION_RATE))
    assert refresh_late(spark, "validation_rate_per_user", src, folder, AS_OF, path, f"{seen}2") == [old, recent]
    assert rows(read_target(spark, path, VALIDATION_RATE)) == stored


def test_a_late_day_touches_its_anniversary_too(spark, tmp_path):
    facts, path, seen = f"{tmp_path}/facts", f"{tmp_path}/report", f"{tmp_path}/seen"
    folder, src = f"{facts}/validation", CatalogSources(spark, f"{tmp_path}/facts")
    days = [dt.date(2023, 2, 1), dt.date(2023, 2, 28), dt.date(2024, 2, 1), dt.date(2024, 2, 28), dt.date(2024, 2, 29)]
    land(spark, folder, *[(d, 1) for d in days])
    refresh_late(spark, "validation_counts_yoy", src, folder, AS_OF, path, seen)
    land(spark, folder, (dt.date(2023, 2, 28), 4), (dt.date(2023, 2, 1), 4))
    got = refresh_late(spark, "validation_counts_yoy", src, folder, AS_OF, path, seen)
    assert got == days
    want = validation_counts_yoy(src.validation(), DateWindow(dt.date(2023, 1, 1), AS_OF))
    assert rows(read_target(spark, path, VALIDATION_COUNTS)) == rows(want)
    leap = LATE_JOBS["validation_counts_yoy"].touched
    assert leap(dt.date(2023, 2, 28))[1:] == [dt.date(2024, 2, 28), dt.date(2024, 2, 29)]
    assert leap(dt.date(2024, 2, 29)) == [dt.date(2024, 2, 29)]
    assert leap(dt.date(2022, 2, 28))[1:] == [dt.date(2023, 2, 28)]


@pytest.mark.parametrize("name", ["sales_by_channel", "title_sales_by_support"])
def test_late_sales(spark, tmp_path, name):
    """Sales of two files; the report of the second is the job's own."""
    src = R._src(spark, "/root/testdata/sf0.001")
    facts = f"{tmp_path}/facts"
    for table in ("sale_detail", "support"):
        getattr(src, table)().write.parquet(f"{facts}/{table}")
    stored = CatalogSources(spark, facts)
    path, seen, as_of = f"{tmp_path}/report", f"{tmp_path}/seen", R.SALES_AS_OF
    window = DateWindow(as_of - dt.timedelta(days=40), as_of - dt.timedelta(days=1))
    sales = src.sales().filter(f"date(bd_transaction_date) >= date'{window.start}'")
    first = "pmod(hash(bd_sales_transaction_id), 2) = 0"
    for part in (first, f"NOT {first}"):
        sales.filter(part).write.mode("append").parquet(f"{facts}/sales")
        refresh_late(spark, name, stored, f"{facts}/sales", as_of, path, seen)
    target = JOBS[name].target
    want = JOBS[name].compute(stored, window, as_of)
    assert rows(read_target(spark, path, target)) == rows(want) != []


def test_windows_of_scattered_dates():
    d = dt.date(2024, 1, 1)
    days = [d + dt.timedelta(days=k) for k in (0, 1, 8, 16, 40, 40)]
    assert windows_of(days) == [DateWindow(d, days[2]), DateWindow.single(days[3]), DateWindow.single(days[4])]
    assert windows_of([]) == []
