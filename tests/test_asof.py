"""The as-of join, J7's ``first_after``, J2's ``cap_at_date`` and J8's kept state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from billetic.operators import DateWindow, next_row_join
from billetic.plans import active_clients, purchase_to_validation_delay, validations_by_age
from billetic.plans import registry as R
from billetic.sources.fixtures import FixtureSources
from billetic.streaming import refresh_by_age
from conftest import SF_SMALL

LEFT = "who long, bought timestamp_ntz, article string"
RIGHT = "who long, tapped timestamp_ntz, tap_id long, class string"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def brute(left, right, how):
    out = []
    for who, when, article in left:
        later = [r for r in right if r[0] == who and who is not None and when is not None and r[1] is not None
                 and r[1] >= when]
        best = min(later, key=lambda r: (r[1], r[2] is None, r[2] or 0, r[3] is None, r[3] or ""), default=None)
        if best or how == "left":
            out.append((who, when, article, *(best[1:] if best else (None, None, None))))
    return sorted(out, key=str)


def joined(spark, left, right, how="inner", **kw):
    df = next_row_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["who"], "bought",
                       "tapped", ties=["tap_id", "class"], how=how, **kw)
    assert df.columns == ["who", "bought", "article", "tapped", "tap_id", "class"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_against_brute_force(spark, how):
    rnd = random.Random(3)
    for days in (1, 3, 40):
        span = days * 24 * 60
        left = [(rnd.choice([1, 2, 3, None]), rnd.choice([at(rnd.randrange(span) // 7 * 7), None, at(5)]), f"a{i}")
                for i in range(80)]
        right = [(rnd.choice([1, 1, 2, 4, None]), rnd.choice([at(rnd.randrange(span) // 7 * 7), at(5), None]),
                  rnd.choice([None, *range(9)]), rnd.choice([None, "x", "y"])) for _ in range(120)]
        assert joined(spark, left, right, how) == brute(left, right, how)
    assert joined(spark, [], right, how) == [] and joined(spark, left, [], how) == brute(left, [], how)


def test_other_parts_of_time_give_the_same(spark):
    rnd = random.Random(4)
    left = [(1, at(rnd.randrange(90_000)), f"a{i}") for i in range(60)]
    right = [(1, at(rnd.randrange(90_000)), i, "x") for i in range(60)]
    for part in (lambda t: F.trunc(t, "MM"), lambda t: F.date_trunc("hour", t)):
        assert joined(spark, left, right, part=part) == brute(left, right, "inner")


def test_names_must_differ(spark):
    left = spark.createDataFrame([], "who long, t timestamp_ntz")
    with pytest.raises(ValueError, match="both tables"):
        next_row_join(left, left, ["who"], "t", "t")


def test_a_third_of_the_taps_on_one_customer(spark):
    """The hot customer is sorted a day at a time: no window sees more than a day of taps."""
    taps = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("who"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.pmod(F.col("id") * 7919, F.lit(60 * 24 * 60)).cast("int"))).alias("tapped"),
        F.col("id").alias("tap_id"), F.lit("x").alias("class"))
    buys = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("who"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.pmod(F.col("id") * 104729, F.lit(60 * 24 * 60)).cast("int"))).alias("bought"),
        F.concat(F.lit("a"), "id").alias("article"))
    df = next_row_join(buys, taps, ["who"], "bought", "tapped", ties=["tap_id", "class"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan and "_part" in plan.split("hashpartitioning(")[1].split(")")[0]
    got = sorted((tuple(r) for r in df.collect()), key=str)
    left, right = [tuple(r) for r in buys.collect()], [tuple(r) for r in taps.collect()]
    by = {}
    for r in right:
        by.setdefault(r[0], []).append(r)
    want = [x for row in left for x in brute([row], by.get(row[0], []), "inner")]
    assert got == sorted(want, key=str) and len(got) > 850


def test_first_after_keeps_who_tapped_before_too(spark):
    sales = spark.createDataFrame([(1, "A", dt.datetime(2024, 1, 10)), (2, "A", dt.datetime(2024, 1, 10))],
                                  "bd_contact_linked long, bd_articlelonglabel string, bd_transaction_date timestamp_ntz")
    taps = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 1, 2), "S"), (2, 1, dt.datetime(2024, 1, 25), "T"), (3, 2, dt.datetime(2024, 1, 10), "S")],
        "validation_id long, bd_linkedcustomer long, DTHR_OPERATION timestamp_ntz, bd_support_class string")
    window = DateWindow.trailing(dt.date(2024, 1, 31))
    plain = purchase_to_validation_delay(sales, taps, window).collect()
    after = purchase_to_validation_delay(sales, taps, window, first_after=True).collect()
    assert [r.bd_contact_linked for r in plain] == ["2"]
    assert sorted((r.bd_contact_linked, r.bd_support_class, r.Delai) for r in after) == [("1", "T", 15), ("2", "S", 0)]


def test_a_tap_after_the_date_does_not_count_when_capped(spark):
    taps = spark.createDataFrame([(1, "c1", dt.datetime(2024, 1, 29, 9)), (2, "c1", dt.datetime(2024, 1, 25))],
                                 "bd_linkedcustomer long, bd_mobibnumber string, DTHR_OPERATION timestamp_ntz")
    cards = spark.createDataFrame([("c1",)], "bd_mobibnumber string")
    window = DateWindow.trailing(dt.date(2024, 1, 31))

    def current(**kw):
        return {r[0].day: r[1] for r in active_clients(taps, cards, window, **kw).collect()}

    assert set(current().values()) == {2}
    assert current(cap_at_date=True) == {23: 0, 24: 0, 25: 1, 26: 1, 27: 1, 28: 1, 29: 2, 30: 2}


class Taps:
    def __init__(self, src, validation):
        self.src, self.rows = src, validation

    def validation(self):
        return self.rows

    def contact(self):
        return self.src.contact()


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_kept_ages(spark, tmp_table):
    src = FixtureSources(spark, SF_SMALL, "a")
    taps = src.validation()
    old, new = R.EVENTS_AS_OF - dt.timedelta(days=20), R.EVENTS_AS_OF
    first = table(refresh_by_age(spark, Taps(src, taps), old, tmp_table))
    assert first == table(validations_by_age(taps, src.contact(), old)) and first
    # twelve days were skipped; they are counted with the next run
    assert table(refresh_by_age(spark, Taps(src, taps), new, tmp_table)) == table(
        validations_by_age(taps, src.contact(), new))
    # a correction in the window and the loss of a day's taps; the year turns and all ages with it
    day = F.to_date("DTHR_OPERATION")
    changed = taps.filter((day != F.lit(new - dt.timedelta(days=3))) & ~(
        (day == F.lit(new - dt.timedelta(days=2))) & (F.col("validation_id") % 2 == 0)))
    assert table(refresh_by_age(spark, Taps(src, changed), new, tmp_table)) == table(
        validations_by_age(changed, src.contact(), new))
    later = new + dt.timedelta(days=400)
    assert table(refresh_by_age(spark, Taps(src, changed), later, tmp_table)) == table(
        validations_by_age(changed, src.contact(), later))


def test_a_kept_run_reads_its_window_only(spark, tmp_table):
    src = FixtureSources(spark, SF_SMALL, "a")
    taps = src.validation()
    refresh_by_age(spark, Taps(src, taps), R.EVENTS_AS_OF, tmp_table)
    window = taps.filter(F.col("DTHR_OPERATION") >= F.lit(R.EVENTS_AS_OF - dt.timedelta(days=8)))
    # taps before the window are gone from the source: the state still has them
    got = table(refresh_by_age(spark, Taps(src, window), R.EVENTS_AS_OF, tmp_table))
    assert got == table(validations_by_age(taps, src.contact(), R.EVENTS_AS_OF))
