"""The interval join and the months a contract covers, against plain Python."""

import calendar
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from billetic.functions import covers
from billetic.operators import covered_months, interval_join


@pytest.mark.parametrize("width", [1, 5, 12, 1000])
def test_interval_join_equals_brute_force(spark, width):
    rnd = random.Random(width)

    def maybe(x):
        return None if rnd.random() < 0.05 else x

    spans = [(i, rnd.choice(["a", "b", None]), maybe(lo := rnd.randint(-60, 60)),
              maybe(lo + rnd.choice([-3, 0, 1, 7, 200]))) for i in range(300)]
    points = [(i, rnd.choice(["a", "b", None]), rnd.randint(-20, 30)) for i in range(40)]
    got = interval_join(
        spark.createDataFrame(spans, "s long, k string, lo int, hi int"),
        spark.createDataFrame(points, "p long, k string, at int"), "lo", "hi", "at", -20, 30, width, ["k"])
    want = sorted((s, p) for s, k, lo, hi in spans for p, k2, at in points
                  if k is not None and k == k2 and lo is not None and hi is not None and lo <= at <= hi)
    assert sorted((r.s, r.p) for r in got.collect()) == want and want


def test_interval_join_of_empty_sides(spark):
    spans = spark.createDataFrame([(1, 2)], "lo int, hi int")
    points = spark.createDataFrame([], "at int")
    assert interval_join(spans, points, "lo", "hi", "at", 0, 9, 4).isEmpty()
    none = spark.createDataFrame([], "lo int, hi int")
    assert interval_join(none, spark.createDataFrame([(1,)], "at int"), "lo", "hi", "at", 0, 9, 4).isEmpty()


def test_covered_months_equal_the_rule_of_each_month(spark):
    rnd = random.Random(5)
    day = dt.date(1999, 11, 1)
    rows = [(dt.date(1999, 12, 1), dt.date(2000, 2, 29)), (dt.date(2000, 2, 1), dt.date(2000, 2, 28)),
            (dt.date(2000, 2, 2), dt.date(2000, 3, 31)), (None, day), (day, None)]
    rows += [(day + dt.timedelta(days=rnd.randint(0, 200)), day + dt.timedelta(days=rnd.randint(0, 300)))
             for _ in range(200)]
    df = spark.createDataFrame(rows, "s date, e date").withColumn("i", F.monotonically_increasing_id())
    months = spark.createDataFrame(
        [(dt.date(y, m, 1), dt.date(y, m, calendar.monthrange(y, m)[1]), y * 12 + m)
         for y in (1999, 2000) for m in range(1, 13)], "ms date, me date, at int")
    first, last = covered_months("s", "e")
    got = interval_join(df.withColumn("lo", first).withColumn("hi", last), months,
                        "lo", "hi", "at", 1999 * 12 + 1, 2000 * 12 + 12, 12)
    want = df.join(months, covers("s", "e", "ms", "me"))
    assert sorted((r.i, r.at) for r in got.collect()) == sorted((r.i, r.at) for r in want.collect())
