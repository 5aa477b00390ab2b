"""Column helpers on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from billetic.functions import (
    age_band,
    covers,
    day_diff,
    equipment_label,
    int_div,
    safe_ratio,
    support_label,
    week_diff,
    year_diff,
)
from billetic.operators.window import DateWindow, add_months

D = dt.date


def one(spark, col, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


@pytest.mark.parametrize(
    "a,b,weeks",
    [
        (D(2024, 1, 6), D(2024, 1, 7), 1),    # Saturday -> Sunday: one boundary
        (D(2024, 1, 7), D(2024, 1, 13), 0),   # Sunday -> Saturday: none
        (D(2024, 1, 7), D(2024, 1, 8), 0),    # Sunday -> Monday
        (D(2024, 1, 1), D(2024, 1, 31), 4),
        (D(2024, 1, 31), D(2024, 1, 1), -4),
        (D(1969, 12, 27), D(1969, 12, 28), 1),  # before 1970 (floor, not div)
        (D(1960, 3, 1), D(2024, 3, 1), 3339),
    ],
)
def test_week_diff_counts_saturday_sunday_crossings(spark, a, b, weeks):
    assert one(spark, week_diff("a", "b"), "a date, b date", [(a, b)]) == [weeks]


def test_week_diff_null(spark):
    assert one(spark, week_diff("a", "b"), "a date, b date", [(None, D(2024, 1, 1))]) == [None]


def test_year_diff_ignores_birthday(spark):
    rows = [(D(2000, 12, 31), D(2001, 1, 1)), (D(2000, 1, 1), D(2000, 12, 31)), (None, D(2001, 1, 1))]
    assert one(spark, year_diff("a", "b"), "a date, b date", rows) == [1, 0, None]


def test_day_diff_counts_midnights(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1))]
    assert one(spark, day_diff("a", "b"), "a timestamp_ntz, b timestamp_ntz", rows) == [1]


@pytest.mark.parametrize(
    "age,between,open_low",
    [
        (None, "65+", "65+"),
        (-1, "65+", "0-12 ans"),
        (0, "0-12 ans", "0-12 ans"),
        (12, "0-12 ans", "0-12 ans"),
        (13, "12-18 ans", "12-18 ans"),
        (18, "12-18 ans", "12-18 ans"),
        (19, "18-24 ans", "18-24 ans"),
        (24, "18-24 ans", "18-24 ans"),
        (25, "24-40 ans", "24-40 ans"),
        (40, "24-40 ans", "24-40 ans"),
        (41, "40-65 ans", "40-65 ans"),
        (65, "40-65 ans", "40-65 ans"),
        (66, "65+", "65+"),
    ],
)
def test_age_band_variants(spark, age, between, open_low):
    df = spark.createDataFrame([(age,)], "age int")
    row = df.select(age_band("age"), age_band("age", open_low=True)).first()
    assert (row[0], row[1]) == (between, open_low)


def test_support_label_unknown_is_null(spark):
    got = one(spark, support_label("c"), "c int", [(899240000,), (899240004,), (899240005,), (None,)])
    assert got == ["Billet Papier", "Ticket sans contact", None, None]


def test_equipment_label_passes_unknown_through(spark):
    got = one(spark, equipment_label("c"), "c string", [("MG",), ("VM",), ("XX",), (None,)])
    assert got == ["POS (guichet), Application dépositaire", "Valideur évènementiel", "XX", None]


def test_int_div_truncates_and_guards_zero(spark):
    rows = [(7, 2), (-7, 2), (6, 3), (1, 0), (None, 2)]
    assert one(spark, int_div("a", "b"), "a long, b long", rows) == [3, -3, 2, None, None]


def test_safe_ratio(spark):
    rows = [(3, 2), (1, 0), (5, None)]
    assert one(spark, safe_ratio("a", "b"), "a long, b long", rows) == [1.5, None, None]


def test_covers_whole_period(spark):
    rows = [
        (D(2024, 1, 1), D(2024, 1, 31), True),
        (D(2024, 1, 2), D(2024, 2, 28), False),   # starts on the 2nd
        (D(2023, 12, 1), D(2024, 1, 30), False),  # ends before month end
        (None, D(2024, 3, 1), None),
    ]
    df = spark.createDataFrame(rows, "s date, e date, want boolean")
    got = df.select(covers("s", "e", F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 31))).alias("c"), "want")
    assert all(r.c == r.want for r in got.collect())


@pytest.mark.parametrize(
    "day,months",
    [(D(2024, 3, 31), -1), (D(2023, 2, 28), 12), (D(2024, 2, 29), -12), (D(2025, 2, 28), -12),
     (D(2024, 1, 31), 1), (D(2000, 2, 29), 12)],
)
def test_python_add_months_matches_spark(spark, day, months):
    got = one(spark, F.add_months("d", months), "d date", [(day,)])
    assert got == [add_months(day, months)]


def test_window_trailing_has_eight_dates():
    w = DateWindow.trailing(D(2024, 1, 2))
    assert w.days()[0] == D(2023, 12, 25) and w.days()[-1] == D(2024, 1, 1)
    assert w.n_days == 8
    assert w.month_starts() == [D(2023, 12, 1), D(2024, 1, 1)]
    assert w.earliest_lookback() == D(2022, 12, 25)
