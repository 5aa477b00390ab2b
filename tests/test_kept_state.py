"""Kept last-seen state: equal to the full run after new, corrected and
deleted rows; and the days it reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from billetic.operators import DateWindow
from billetic.plans import clients, sales
from billetic.streaming import refresh_last_seen
from billetic.streaming.last_seen import advance, _runs

SALE = ("bd_sales_transaction_id long, bd_transaction_date timestamp_ntz, bd_contact_linked long, "
        "bd_productlonglabel string")
TAP = "DTHR_OPERATION timestamp_ntz, bd_linkedcustomer long, bd_mobibnumber string"
AS_OF = dt.date(2024, 3, 5)


class Rows:
    """Logical sources over plain lists, which a test changes between runs."""

    def __init__(self, spark):
        self.spark, self.sale_rows, self.tap_rows, self.read_from = spark, [], [], []

    def sales(self):
        return self.spark.createDataFrame(self.sale_rows, SALE)

    def validation(self):
        return self.spark.createDataFrame(self.tap_rows, TAP)

    def card(self):
        return self.spark.createDataFrame([(str(i),) for i in range(0, 30, 2)] + [("4",)], "bd_mobibnumber string")


def at(day, hour=12):
    return dt.datetime.combine(day, dt.time(hour))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def full(name, src, as_of):
    window = DateWindow.trailing(as_of)
    return rows(sales.total_clients(src.sales(), window) if name == "total_clients"
                else clients.active_clients(src.validation(), src.card(), window))


def random_rows(rnd, n, lo, hi):
    days = (hi - lo).days
    sale = [(rnd.choice([None, rnd.randint(0, 40)]), at(lo + dt.timedelta(days=rnd.randint(0, days))),
             rnd.choice([None, rnd.randint(0, 15)]), rnd.choice(["p", "q", None])) for _ in range(n)]
    tap = [(at(lo + dt.timedelta(days=rnd.randint(0, days))), rnd.choice([None, rnd.randint(0, 12)]),
            rnd.choice([None, str(rnd.randint(0, 29))])) for _ in range(n)]
    return sale, tap


@pytest.mark.parametrize("name", ["total_clients", "active_clients"])
@pytest.mark.parametrize("seed", [1, 2])
def test_kept_state_equals_the_full_run(spark, tmp_path, name, seed):
    """New rows, rows of the window deleted, a skipped run, a month that
    leaves the lookback, a repeated run."""
    rnd = random.Random(seed)
    src = Rows(spark)
    as_of = AS_OF
    src.sale_rows, src.tap_rows = random_rows(rnd, 150, AS_OF - dt.timedelta(days=420), AS_OF)
    path, state = f"{tmp_path}/report", f"{tmp_path}/state"
    for step in (0, 1, 12, 1):
        as_of += dt.timedelta(days=step)
        # what the run may see change: the days from the window (or the last run) on
        since = as_of - dt.timedelta(days=8 if step < 8 else step)
        new = random_rows(rnd, 25, since, as_of + dt.timedelta(days=1))
        src.sale_rows = [r for r in src.sale_rows if r[1].date() < since or rnd.random() < 0.5] + new[0]
        src.tap_rows = [r for r in src.tap_rows if r[0].date() < since or rnd.random() < 0.5] + new[1]
        for _ in range(2):
            got = rows(refresh_last_seen(spark, name, src, as_of, path, state))
            assert got == full(name, src, as_of)
    assert _runs(spark, state) == [as_of - dt.timedelta(days=1), as_of]


def test_a_deleted_last_day_is_looked_up_again(spark, tmp_path):
    """The client's latest sale goes: it falls back to the one before, and a
    client without any other goes; the rest is not looked up."""
    src = Rows(spark)
    d = AS_OF - dt.timedelta(days=3)
    old = dt.date(2023, 3, 1)       # within 12 months of the first dates of the window only
    src.sale_rows = [(1, at(old), 7, "p"), (2, at(d), 7, "p"), (3, at(d), 8, "p"), (4, at(d), 9, "p")]
    path, state = f"{tmp_path}/report", f"{tmp_path}/state"
    refresh_last_seen(spark, "total_clients", src, AS_OF - dt.timedelta(days=1), path, state)
    src.sale_rows = [r for r in src.sale_rows if r[0] not in (2, 3)]
    got = rows(refresh_last_seen(spark, "total_clients", src, AS_OF, path, state))
    assert got == full("total_clients", src, AS_OF)
    assert {(r[0], r[2]) for r in got} >= {(dt.date(2024, 3, 1), 2), (dt.date(2024, 3, 4), 1)}


def test_only_the_window_is_read_unless_something_was_lost(spark, tmp_path):
    asked = []
    table = [("a", dt.date(2024, 2, 1)), ("b", dt.date(2024, 3, 1)), (None, dt.date(2024, 3, 2))]

    def facts(since):
        asked.append(since)
        return spark.createDataFrame([r for r in table if r[1] >= since], "e string, _day date")

    def run(as_of, **kw):
        asked.clear()
        return rows(advance(spark, str(tmp_path), facts, ["e"], DateWindow.trailing(as_of), as_of, **kw))

    window = DateWindow.trailing(AS_OF)
    assert run(AS_OF) == sorted(table, key=str) and asked == [window.earliest_lookback()]
    assert run(AS_OF + dt.timedelta(days=1)) == sorted(table, key=str)
    assert asked == [window.start + dt.timedelta(days=1)]
    table.remove((None, dt.date(2024, 3, 2)))      # a NULL entity is one like others
    assert run(AS_OF + dt.timedelta(days=2)) == sorted(table, key=str) and len(asked) == 2
    table[0] = ("a", dt.date(2024, 1, 20))         # an old correction, announced by ``since``
    assert run(AS_OF + dt.timedelta(days=3), since=dt.date(2024, 1, 1)) == sorted(table, key=str)
    table.clear()
    assert run(AS_OF + dt.timedelta(days=4), since=dt.date(2024, 1, 1)) == []


def test_an_unfinished_state_is_not_read(spark, tmp_path):
    src = Rows(spark)
    src.sale_rows = [(1, at(AS_OF - dt.timedelta(days=30)), 7, "p")]
    (tmp_path / "state" / "as_of=2024-03-04").mkdir(parents=True)
    got = rows(refresh_last_seen(spark, "total_clients", src, AS_OF, f"{tmp_path}/report", f"{tmp_path}/state"))
    assert got == full("total_clients", src, AS_OF) and got


def test_empty_tables(spark, tmp_path):
    src = Rows(spark)
    assert rows(refresh_last_seen(spark, "total_clients", src, AS_OF, f"{tmp_path}/a", f"{tmp_path}/b")) == []
    for as_of in (AS_OF, AS_OF + dt.timedelta(days=1)):
        got = refresh_last_seen(spark, "active_clients", src, as_of, f"{tmp_path}/c", f"{tmp_path}/d")
        assert got.agg(F.sum("CurrentMonthActiveClients"), F.count("*")).first()[:] == (0, 8)
