"""One customer holds a third of all taps. The jobs must give the same rows
whether Spark broadcasts or shuffles, and a shuffle join on the customer
must have its hot partition split by AQE (skew join) instead of running in
one task."""

import contextlib
import io
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from billetic.operators import DateWindow
from billetic.plans import registry as R
from billetic.plans.clients import active_clients, avg_weekly_validations, clients_by_line
from billetic.plans.validations import validation_rate_per_user, validations_by_age
from billetic.sources.fixtures import FixtureSources

SF = "/root/testdata/sf0.01"
HOT = 7
WINDOW = DateWindow.trailing(R.EVENTS_AS_OF)

SHUFFLE_EVERYTHING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@contextmanager
def settings(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    """Validations where a third of the taps belong to one customer, spread
    over several map tasks (as many files would be)."""
    src = FixtureSources(spark, SF, "a")
    v = src.validation()
    is_hot = F.col("validation_id") % 3 == 0
    v = v.withColumn("bd_linkedcustomer",
                     F.when(is_hot, F.lit(HOT).cast("long")).otherwise(F.col("bd_linkedcustomer")))
    v = v.withColumn("bd_mobibnumber",
                     F.when(is_hot, F.lit(str(HOT))).otherwise(F.col("bd_mobibnumber")))
    return src, v.repartition(8)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


JOBS = {
    "active_clients": lambda s, v: active_clients(v, s.card(), WINDOW),
    "clients_by_line": lambda s, v: clients_by_line(v, s.contact(), s.line(), WINDOW),
    "avg_weekly_validations": lambda s, v: avg_weekly_validations(v, s.contact(), WINDOW),
    "validations_by_age": lambda s, v: validations_by_age(v, s.contact(), R.EVENTS_AS_OF),
    "validation_rate_per_user": lambda s, v: validation_rate_per_user(v, WINDOW),
}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_same_rows_with_shuffles_and_skew_splitting(spark, hot, name):
    src, v = hot
    default = table(JOBS[name](src, v))
    with settings(spark, SHUFFLE_EVERYTHING):
        shuffled = table(JOBS[name](src, v))
    assert default == shuffled and len(default) > 0


def test_hot_customer_partition_is_split(spark, hot):
    src, v = hot
    with settings(spark, SHUFFLE_EVERYTHING):
        df = validations_by_age(v, src.contact(), R.EVENTS_AS_OF)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
    final = buf.getvalue().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final


def test_rate_per_user_matches_direct_count(spark, hot):
    src, v = hot
    got = dict(table(validation_rate_per_user(v, WINDOW)))
    days = v.select(F.to_date("DTHR_OPERATION").alias("d"), "bd_linkedcustomer").filter(
        F.col("d").between(WINDOW.start, WINDOW.end))
    want = {r.d: r.n / r.u for r in days.groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("bd_linkedcustomer").alias("u")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_hot_card_partition_is_split(spark, hot):
    """A third of the taps on one card that very many customers used, and
    a register that lists the card twice."""
    src, v = hot
    v = v.withColumn("bd_mobibnumber", F.when(F.col("validation_id") % 3 == 0, F.lit("1")).otherwise(
        F.col("bd_mobibnumber"))).withColumn("bd_linkedcustomer", F.when(
            F.col("validation_id") % 3 == 0, F.col("validation_id")).otherwise(F.col("bd_linkedcustomer")))
    cards = src.card()
    twice = cards.union(cards.filter("bd_mobibnumber = '1'"))
    want = table(active_clients(v, cards, WINDOW))
    with settings(spark, SHUFFLE_EVERYTHING | {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        df = active_clients(v, twice, WINDOW)
        assert table(df) == want
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
    assert "SortMergeJoin(skew=true)" in buf.getvalue().split("Initial Plan")[0]
