"""The trailing refresh of every job: running twice leaves the same table,
and the table holds what the job computes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from billetic.operators import DateWindow
from billetic.plans import registry as R
from billetic.sources.fixtures import FixtureSources
from billetic.sources.sinks import read_target
from billetic.streaming import JOBS, refresh
from conftest import SF_SMALL

AS_OF = {
    "title_sales_by_support": R.SALES_AS_OF,
    "active_clients": R.SALES_AS_OF,
    "active_contract_clients": R.SALES_AS_OF,
    "clients_by_line": R.EVENTS_AS_OF,
    "avg_weekly_validations": R.EVENTS_AS_OF,
    "total_clients": R.SALES_AS_OF,
    "purchase_to_validation_delay": R.MONTH_START_AS_OF,
    "validations_by_age": R.EVENTS_AS_OF,
    "validation_counts_yoy": R.SALES_AS_OF,
    "validation_rate_per_user": R.EVENTS_AS_OF,
    "sales_by_channel": R.SALES_AS_OF,
}
KIND = {"active_clients": "b", "purchase_to_validation_delay": "b", "validation_counts_yoy": "b"}


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_refresh_twice_is_repeatable(spark, tmp_table, name):
    src = FixtureSources(spark, SF_SMALL, KIND.get(name, "a"))
    target = JOBS[name].target
    computed = table(refresh(spark, name, src, AS_OF[name], tmp_table))
    first = table(read_target(spark, tmp_table, target))
    refresh(spark, name, src, AS_OF[name], tmp_table)
    second = table(read_target(spark, tmp_table, target))
    assert first == second == computed


def test_next_day_moves_the_window(spark, tmp_table):
    src = FixtureSources(spark, SF_SMALL, "a")
    target = JOBS["validation_rate_per_user"].target
    refresh(spark, "validation_rate_per_user", src, dt.date(2024, 1, 20), tmp_table)
    refresh(spark, "validation_rate_per_user", src, dt.date(2024, 1, 21), tmp_table)
    days = sorted(r[0] for r in read_target(spark, tmp_table, target).collect())
    assert days == [dt.date(2024, 1, d) for d in range(12, 21)]


def test_purchase_delay_reload_empties_stale_dates_and_keeps_older_ones(spark, tmp_table):
    from billetic.sources.sinks import APPEND, write_target
    from billetic.sources.targets import PURCHASE_DELAY

    src = FixtureSources(spark, SF_SMALL, "b")
    old_row = ("1", "Brand#00", "N", dt.date(2001, 1, 5), dt.date(2001, 1, 6), 1)       # before start
    stale_row = ("1", "Brand#00", "N", dt.date(2001, 12, 25), dt.date(2001, 12, 26), 1)  # no new rows that day
    write_target(spark.createDataFrame([old_row, stale_row], PURCHASE_DELAY.schema),
                 tmp_table, PURCHASE_DELAY, APPEND)
    computed = table(R.q_purchase_to_validation_delay(spark, SF_SMALL, R.MONTH_START_AS_OF))
    stored = table(refresh(spark, "purchase_to_validation_delay", src, R.MONTH_START_AS_OF,
                           tmp_table))
    assert all(r[3] != dt.date(2001, 12, 25) for r in computed)
    assert stored == sorted(computed + [old_row], key=str)


def test_a_day_that_loses_its_rows_is_emptied(spark, tmp_table):
    class Corrected(FixtureSources):
        def validation(self):
            return super().validation().filter("date(DTHR_OPERATION) <> date'2024-01-18'")

    target, name = JOBS["validation_rate_per_user"].target, "validation_rate_per_user"
    refresh(spark, name, FixtureSources(spark, SF_SMALL, "a"), dt.date(2024, 1, 20), tmp_table)
    refresh(spark, name, Corrected(spark, SF_SMALL, "a"), dt.date(2024, 1, 21), tmp_table)
    days = sorted(r[0] for r in read_target(spark, tmp_table, target).collect())
    assert days == [dt.date(2024, 1, d) for d in range(12, 21) if d != 18]


@pytest.mark.parametrize("name", ["title_sales_by_support", "validation_rate_per_user"])
def test_a_refresh_computes_its_job_once(spark, tmp_table, name):
    """A refresh passes as many rows through a marked column of the source as
    the job alone, whatever the writer checks, merges and writes."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def marked(x):
        seen.add(1)
        return x

    class Counted(FixtureSources):
        def sales(self):
            key = "bd_sales_transaction_id"
            return super().sales().withColumn(key, marked(key))

        def validation(self):
            return super().validation().withColumn("bd_linkedcustomer", marked("bd_linkedcustomer"))

    as_of, src = AS_OF[name], Counted(spark, SF_SMALL, "a")
    JOBS[name].compute(src, DateWindow.trailing(as_of), as_of).collect()
    once = seen.value
    for n in (2, 3):
        refresh(spark, name, src, as_of, tmp_table)
        assert seen.value == n * once > 0
