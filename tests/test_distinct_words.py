"""Mergeable distinct counts: words of 64 ids against plain sets, the kept
taps of J9 against its full run, and periods rolled up from days."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from billetic.operators import DateWindow, count_words, id_words, merge_words
from billetic.plans.validations import tap_words, validation_counts_yoy
from billetic.sources.sinks import read_target
from billetic.sources.targets import TAP_WORDS
from billetic.streaming import distinct_by_period, merge_taps, recount_days, refresh_counts

TAP = "validation_id long, DTHR_OPERATION timestamp_ntz, LIBEL_LONG_PRODUIRE string"
EDGES = [0, 1, 62, 63, 64, 65, 127, 128, -1, -63, -64, -65, 2**63 - 1, -(2**63), 2**62, None]


class Taps:
    """The validation source over a list that a test changes between runs."""

    def __init__(self, spark):
        self.spark, self.rows = spark, []

    def validation(self):
        return self.spark.createDataFrame(self.rows, TAP)


def at(day, hour=12):
    return dt.datetime.combine(day, dt.time(hour))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_taps(rnd, n, days):
    return [(rnd.choice([rnd.randint(-200, 400), rnd.choice(EDGES)]), at(rnd.choice(days), rnd.randint(0, 23)),
             rnd.choice(["p", "q", None])) for _ in range(n)]


def counted(groups):
    return sorted(((k, len(v - {None})) for k, v in groups.items()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_words_count_as_sets_do(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["a", "b", None]), rnd.choice(EDGES + [rnd.randint(-300, 300)])) for _ in range(400)] + [("nulls", None)]
    want = {}
    for k, v in data:
        want.setdefault(k, set()).add(v)
    df = spark.createDataFrame(data, "k string, v long")
    assert sorted(((r.k, r.n) for r in count_words(id_words(df, ["k"], "v"), ["k"]).collect()), key=str) == counted(want)
    parts = df.randomSplit([0.5, 0.5], seed)
    both = merge_words(id_words(parts[0], ["k"], "v").unionByName(id_words(parts[1], ["k"], "v")).unionByName(
        id_words(df, ["k"], "v")), ["k"])
    assert rows(count_words(both, ["k"])) == rows(count_words(id_words(df, ["k"], "v"), ["k"]))


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_every_integer_type(spark, kind):
    df = spark.sql(f"SELECT 'k' AS k, CAST(v AS {kind}) AS v FROM VALUES (-128), (127), (0), (0), (NULL) AS t(v)")
    assert rows(count_words(id_words(df, ["k"], "v"), ["k"])) == [("k", 3)]


def test_empty_input_and_other_types(spark):
    empty = spark.createDataFrame([], "k string, v long")
    assert rows(count_words(id_words(empty, ["k"], "v"), ["k"])) == []
    with pytest.raises(TypeError, match="expected an integer"):
        id_words(spark.createDataFrame([], "k string, v string"), ["k"], "v")


def test_dense_ids_shuffle_few_rows(spark):
    """A map task hands on one row per 64 ids, a hot key's words spread."""
    df = spark.range(64_000).select((F.col("id") % 1).alias("k"), F.col("id").alias("v"))
    words = id_words(df, ["k"], "v")
    assert words.count() == 1000
    text = words._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(k#\d+L, id_word#\d+L", text)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("as_of", [dt.date(2024, 3, 5), dt.date(2025, 3, 4)])
def test_by_words_equals_count_distinct(spark, as_of):
    rnd, src, w = random.Random(7), Taps(spark), DateWindow.trailing(as_of)
    days = w.days() + [d.replace(year=d.year - 1) for d in w.days() if (d.month, d.day) != (2, 29)] + [dt.date(2024, 2, 29)]
    src.rows = some_taps(rnd, 500, days)
    assert rows(validation_counts_yoy(src.validation(), w, by_words=True)) == rows(validation_counts_yoy(src.validation(), w))


def test_kept_taps_equal_the_full_run(spark, tmp_path):
    """New and deleted rows, late rows merged, skipped runs, a repeated run, a
    run a year on (whose year before is the state) and one for an older date."""
    rnd, src = random.Random(3), Taps(spark)
    path, state = f"{tmp_path}/report", f"{tmp_path}/state"
    first = dt.date(2024, 3, 5)
    src.rows = some_taps(rnd, 200, [first - dt.timedelta(days=k) for k in (1, 2, 5, 8, 366, 367, 371, 374)])
    as_of = first
    for step in (0, 1, 0, 11, 350):
        as_of += dt.timedelta(days=step)
        window = DateWindow.trailing(as_of)
        new = some_taps(rnd, 60, window.days())
        src.rows = [r for r in src.rows if r[1].date() < window.start or rnd.random() < 0.6] + new
        assert rows(refresh_counts(spark, src, as_of, path, state)) == rows(validation_counts_yoy(src.validation(), window))
    late = some_taps(rnd, 40, [as_of - dt.timedelta(days=k) for k in (1, 20, 366)])
    src.rows += late
    merge_taps(spark, state, spark.createDataFrame(late, TAP))
    for day in (as_of, as_of - dt.timedelta(days=19), first - dt.timedelta(days=40)):
        window = DateWindow.trailing(day)
        assert rows(refresh_counts(spark, src, day, path, state)) == rows(validation_counts_yoy(src.validation(), window))


def test_a_day_known_from_merged_rows_only_is_counted_when_needed(spark, tmp_path):
    src, path, state = Taps(spark), f"{tmp_path}/report", f"{tmp_path}/state"
    day, later = dt.date(2024, 3, 1), dt.date(2025, 3, 2)
    src.rows = [(1, at(day), "p"), (2, at(day), "p"), (3, at(later - dt.timedelta(days=1)), "p")]
    merge_taps(spark, state, spark.createDataFrame(src.rows[:1], TAP))
    assert rows(refresh_counts(spark, src, later, path, state)) == [(dt.date(2025, 3, 1), "p", 1, 2)]


def test_merging_reads_and_writes_the_touched_days_only(spark, tmp_path):
    state = tmp_path / "state"
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    taps = lambda *r: spark.createDataFrame(list(r), TAP)
    assert merge_taps(spark, str(state), taps((1, at(days[0]), "p"), (1, at(days[1]), "p"), (9, None, "p"))) == days
    other = sorted(f.name for f in (state / "Date_de_validation=2024-01-01").glob("*.parquet"))
    late = taps((1, at(days[1]), "p"), (2, at(days[1]), "p"))
    for _ in range(2):
        assert merge_taps(spark, str(state), late) == days[1:]
        words = read_target(spark, str(state), TAP_WORDS)
        assert rows(count_words(words, ["Date_de_validation", "Type_abonnement"])) == [(days[0], "p", 1), (days[1], "p", 2)]
    assert sorted(f.name for f in (state / "Date_de_validation=2024-01-01").glob("*.parquet")) == other
    assert merge_taps(spark, str(state), taps()) == []
    recount_days(spark, str(state), taps((2, at(days[1]), "p")), days[1], days[1] + dt.timedelta(days=1))
    words = read_target(spark, str(state), TAP_WORDS)
    assert rows(count_words(words, ["Date_de_validation"])) == [(days[0], 1), (days[1], 1)]


@pytest.mark.parametrize("period", ["week", "month", "quarter", "year"])
def test_periods_count_an_id_of_many_days_once(spark, period):
    rnd = random.Random(11)
    taps = some_taps(rnd, 300, [dt.date(2023, 12, 1) + dt.timedelta(days=k) for k in range(0, 120, 7)])
    df = spark.createDataFrame(taps, TAP)
    want = df.groupBy(F.trunc(F.col("DTHR_OPERATION").cast("date"), period), "LIBEL_LONG_PRODUIRE").agg(
        F.countDistinct("validation_id"))
    assert rows(distinct_by_period(tap_words(df, None, None), period)) == rows(want)
