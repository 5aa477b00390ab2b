"""Properties: one job over 8 dates equals 8 one-date
runs; the rewrites equal the reference's direct forms."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billetic.functions import week_diff
from billetic.operators import DateWindow, add_months, conditional_distinct, lookback
from billetic.plans import registry as R
from billetic.plans.sales import total_clients
from billetic.sources.fixtures import FixtureSources
from conftest import SF_SMALL

D = dt.date


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


WINDOWED = {
    "title_sales_by_support": R.SALES_AS_OF,
    "active_clients": R.SALES_AS_OF,
    "active_contract_clients": R.MONTH_START_AS_OF,
    "clients_by_line": R.EVENTS_AS_OF,
    "avg_weekly_validations": R.EVENTS_AS_OF,
    "total_clients": R.SALES_AS_OF,
    "validation_counts_yoy": R.LEAP_WINDOW_AS_OF,
    "validation_rate_per_user": R.EVENTS_AS_OF,
    "sales_by_channel": R.SALES_AS_OF,
}


@pytest.mark.parametrize("name", sorted(WINDOWED))
def test_window_equals_union_of_single_dates(spark, name):
    fn = getattr(R, f"q_{name}")
    as_of = WINDOWED[name]
    whole = fn(spark, SF_SMALL, as_of)
    parts = None
    for back in range(8, 0, -1):
        day = as_of - dt.timedelta(days=back)
        one = fn(spark, SF_SMALL, as_of, window=DateWindow.single(day))
        parts = one if parts is None else parts.unionByName(one)
    assert as_set(whole) == as_set(parts)


def test_total_clients_one_pass_equals_two_branches(spark):
    sales = FixtureSources(spark, SF_SMALL).sales()
    window = DateWindow.trailing(R.SALES_AS_OF)
    got = total_clients(sales, window)
    rows = []
    for d in window.days():
        s = sales.filter(F.col("bd_transaction_date").cast("date") >= F.lit(add_months(d, -12)))
        ident = s.filter(F.col("bd_contact_linked").isNotNull()).groupBy("bd_productlonglabel").agg(
            F.countDistinct("bd_contact_linked").alias("c"))
        anon = s.filter(F.col("bd_contact_linked").isNull()).groupBy("bd_productlonglabel").agg(
            F.countDistinct("bd_sales_transaction_id").alias("c"))
        per = ident.unionByName(anon).groupBy("bd_productlonglabel").agg(F.sum("c").alias("c"))
        rows += [(d, r[0], int(r[1])) for r in per.collect()]
    assert as_set(got) == sorted(rows, key=str)


def test_conditional_distinct_equals_count_distinct(spark):
    v = lookback(FixtureSources(spark, SF_SMALL, "b").validation(), "DTHR_OPERATION",
                 DateWindow.trailing(R.SALES_AS_OF))
    v = v.withColumn("day", F.to_date("DTHR_OPERATION"))
    preds = {
        "weekend": F.dayofweek("day").isin(1, 7),
        "recent": F.col("day") >= F.lit(D(2001, 7, 1)),
        "line_low": F.col("NUM_LIGNE") < 10,
    }
    got = conditional_distinct(v, ["LIBEL_LONG_PRODUIRE"], "bd_linkedcustomer", preds)
    want = v.groupBy("LIBEL_LONG_PRODUIRE").agg(*[
        F.countDistinct(F.when(p, F.col("bd_linkedcustomer"))).alias(n) for n, p in preds.items()])
    assert as_set(got.select("LIBEL_LONG_PRODUIRE", *preds)) == as_set(
        want.select("LIBEL_LONG_PRODUIRE", *preds))


def _sundays_between(a: dt.date, b: dt.date) -> int:
    lo, hi, sign = (a, b, 1) if b >= a else (b, a, -1)
    first_sunday = lo + dt.timedelta(days=(6 - lo.weekday()) % 7 or 7)
    if first_sunday > hi:
        return 0
    return sign * (1 + (hi - first_sunday).days // 7)


dates = st.dates(min_value=D(1900, 1, 1), max_value=D(2100, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=200))
def test_week_diff_matches_sunday_count(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(week_diff("a", "b")).collect()]
    assert got == [_sundays_between(a, b) for a, b in pairs]


def test_previous_year_column_equals_last_years_run(spark):
    """The previous-year count of a day is the current count of the same
    day one year earlier (outside leap days)."""
    v = FixtureSources(spark, SF_SMALL, "b").validation()
    from billetic.plans.validations import validation_counts_yoy

    this_year = validation_counts_yoy(v, DateWindow.trailing(D(2001, 8, 1))).collect()
    last_year = validation_counts_yoy(v, DateWindow.trailing(D(2000, 8, 1))).collect()
    current = {(r.Date_de_validation, r.Type_abonnement): r.Nombre_de_validation for r in last_year}
    checked = 0
    for r in this_year:
        want = current.get((add_months(r.Date_de_validation, -12), r.Type_abonnement), 0)
        assert r.Nombre_de_validation_annee_precedente == want
        checked += want > 0
    assert checked > 0


def test_purchase_delay_window_equals_distinct_union_of_single_dates(spark):
    """J7 inserts one copy per execution date in the reference; the window
    form is the distinct union of the one-date runs (two months here)."""
    as_of = R.MONTH_START_AS_OF
    whole = R.q_purchase_to_validation_delay(spark, SF_SMALL, as_of)
    parts = None
    for back in range(8, 0, -1):
        day = as_of - dt.timedelta(days=back)
        one = R.q_purchase_to_validation_delay(spark, SF_SMALL, as_of,
                                               window=DateWindow.single(day))
        parts = one if parts is None else parts.unionByName(one)
    assert as_set(whole) == as_set(parts.distinct())
    assert parts.count() > parts.distinct().count()      # the copies the reference would insert


def test_purchase_delay_copies_equal_the_plain_union_of_single_dates(spark):
    """``copies=True``: the reference's literal output, one copy per date."""
    from billetic.plans.validations import purchase_to_validation_delay

    src = FixtureSources(spark, SF_SMALL, "b")
    window = DateWindow.trailing(R.MONTH_START_AS_OF)
    copies = purchase_to_validation_delay(src.sales(), src.validation(), window, copies=True)
    parts = None
    for day in window.days():
        one = purchase_to_validation_delay(src.sales(), src.validation(), DateWindow.single(day))
        parts = one if parts is None else parts.unionByName(one)
    assert as_set(copies) == as_set(parts)
