"""Every registered query: the 11 KPI jobs at the execution dates of
``FIXTURES.md`` (plus the dates that exercise their traps), and the reusable
operators applied to the same tables. Each entry takes ``(spark, sf_dir)``
and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billetic.functions import age_band, covers, equipment_label, to_day, week_diff, year_diff
from billetic.operators import (
    DateWindow,
    add_months,
    conditional_distinct,
    date_spine,
    first_per_group,
    lookback,
    on_day_set,
    on_days,
    since_account_start,
    spine_join,
    with_period_bounds,
    with_zero_rows,
)
from billetic.operators.window import (
    LAST_MONTH_START,
    LAST_YEAR_START,
    MONTH_START,
    TWELVE_MONTHS_AGO,
)
from billetic.plans.clients import (
    CURRENT,
    LAST_MONTH,
    LAST_YEAR,
    active_clients,
    active_contract_clients,
    avg_weekly_validations,
    clients_by_line,
)
from billetic.plans.sales import sales_by_channel, title_sales_by_support, total_clients
from billetic.plans.validations import (
    HISTORY_START,
    purchase_to_validation_delay,
    validation_counts_yoy,
    validation_rate_per_user,
    validations_by_age,
)
from billetic.sources.catalog import CatalogSources
from billetic.sources.colocated import read_colocated, store_colocated
from billetic.sources.fixtures import FixtureSources
from billetic.session import ensure_checkpoint_dir
from billetic.sources.sinks import (
    APPEND,
    OVERWRITE,
    REPLACE_DATES,
    delete_from,
    duplicate_keys,
    ensure_target,
    read_target,
    replace_dates,
    update_from,
    update_into,
    upsert,
    upsert_into,
    write_target,
)
from billetic.sources.targets import (
    ACTIVE_CLIENTS,
    AVG_WEEKLY_VALIDATIONS,
    SALES_BY_CHANNEL,
    TAP_WORDS,
    TITLE_SALES,
    VALIDATION_COUNTS,
    VALIDATION_RATE,
    conform,
)

# Execution dates ("today") of the registered runs.
SALES_AS_OF = dt.date(2001, 8, 1)        # orders end on 2001-08-01
MONTH_START_AS_OF = dt.date(2001, 8, 2)  # window holds a 1st of month and two months
LEAP_LOOKUP_AS_OF = dt.date(2001, 3, 5)  # last year's window holds 2000-02-29
LEAP_WINDOW_AS_OF = dt.date(2000, 3, 4)  # the window holds 2000-02-29
EVENTS_AS_OF = dt.date(2024, 1, 31)      # events cover 2024-01-01 .. 2024-01-30
OLD_ACCOUNTS_AS_OF = dt.date(2025, 1, 20)  # accounts of over a year; the lookback starts inside January
NO_TAPS_AS_OF = dt.date(2025, 3, 1)      # the last tap is more than 12 months ago

Query = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, sf_dir: str, kind: str = "a") -> FixtureSources:
    return FixtureSources(spark, sf_dir, kind)


def _w(as_of: dt.date, window: DateWindow | None = None) -> DateWindow:
    """The run's window: the trailing 8 dates of ``as_of`` unless given."""
    return window if window is not None else DateWindow.trailing(as_of)


# -- the 11 jobs -------------------------------------------------------------

def q_title_sales_by_support(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    s = _src(spark, sf_dir)
    return title_sales_by_support(s.sale_detail(), s.support(), s.sales(), _w(as_of, window))


def q_active_clients(spark, sf_dir, as_of=SALES_AS_OF, kind="b", window=None, cap_at_date=False):
    s = _src(spark, sf_dir, kind)
    return active_clients(s.validation(), s.card(), _w(as_of, window), cap_at_date)


def q_active_contract_clients(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    s = _src(spark, sf_dir)
    return active_contract_clients(s.sale_detail(), s.contact(), s.article(), _w(as_of, window))


def q_clients_by_line(spark, sf_dir, as_of=EVENTS_AS_OF, kind="a", window=None):
    s = _src(spark, sf_dir, kind)
    return clients_by_line(s.validation(), s.contact(), s.line(), _w(as_of, window))


def q_avg_weekly_validations(spark, sf_dir, as_of=EVENTS_AS_OF, min_avg=4, window=None):
    s = _src(spark, sf_dir, "a")
    return avg_weekly_validations(s.validation(), s.contact(), _w(as_of, window), min_avg)


def q_total_clients(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    return total_clients(_src(spark, sf_dir).sales(), _w(as_of, window))


def q_purchase_to_validation_delay(spark, sf_dir, as_of=SALES_AS_OF, window=None, first_after=False):
    s = _src(spark, sf_dir, "b")
    return purchase_to_validation_delay(s.sales(), s.validation(), _w(as_of, window), first_after=first_after)


def q_validations_by_age(spark, sf_dir, as_of=EVENTS_AS_OF, start=HISTORY_START, kind="a"):
    s = _src(spark, sf_dir, kind)
    return validations_by_age(s.validation(), s.contact(), as_of, start)


def q_validation_counts_yoy(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    return validation_counts_yoy(_src(spark, sf_dir, "b").validation(), _w(as_of, window))


def q_validation_rate_per_user(spark, sf_dir, as_of=EVENTS_AS_OF, window=None):
    return validation_rate_per_user(_src(spark, sf_dir, "a").validation(), _w(as_of, window))


def q_sales_by_channel(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    return sales_by_channel(_src(spark, sf_dir).sales(), _w(as_of, window))


# -- operators applied to the tables ----------------------------------------

def q_period_bounds(spark, sf_dir):
    """The period bounds of every distinct validation day (years of
    history, leap days included)."""
    v = _src(spark, sf_dir, "b").validation()
    days = v.select(to_day("DTHR_OPERATION").alias("d")).distinct()
    return with_period_bounds(days)


def q_age_bands(spark, sf_dir, as_of=SALES_AS_OF):
    """contacts per age at the first of the month and both band
    variants. Births run to 2020, so at 2001 some ages are negative: the
    variants differ there (and NULL ages are the last band in both)."""
    c = _src(spark, sf_dir).contact()
    age = year_diff("birthdate", F.lit(as_of.replace(day=1)))
    return c.groupBy(
        age.alias("Age"),
        age_band(age).alias("band_between"),
        age_band(age, open_low=True).alias("band_open_low"),
    ).agg(F.count(F.lit(1)).alias("n_contacts"))


def q_account_weeks(spark, sf_dir):
    """taps of known clients per number of Saturday->Sunday crossings
    between account creation and the tap day (negative when the account is
    newer than the tap)."""
    s = _src(spark, sf_dir, "a")
    v = s.validation().join(s.contact(), F.col("bd_linkedcustomer") == F.col("Id"))
    return v.groupBy(week_diff("createdon", "DTHR_OPERATION").alias("Weeks")).agg(
        F.count(F.lit(1)).alias("n_validations")
    )


def q_equipment_labels(spark, sf_dir):
    """F8 pass-through map: sales rows per equipment code and label."""
    sales = _src(spark, sf_dir).sales()
    return sales.groupBy(
        "bd_equipment_type", equipment_label("bd_equipment_type").alias("EquipementType")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def q_active_clients_by_spine_join(spark, sf_dir, as_of=SALES_AS_OF, kind="b", window=None):
    """A4 + N6 + A9: J2 written the direct way -- distinct (customer, day),
    broadcast range join to the dates, conditional distinct counts. Must
    equal ``active_clients`` (a property check of the histogram plan)."""
    s = _src(spark, sf_dir, kind)
    window = _w(as_of, window)
    v = lookback(s.validation(), "DTHR_OPERATION", window)
    v = v.join(s.card(), "bd_mobibnumber", "left_semi").select(
        "bd_linkedcustomer", to_day("DTHR_OPERATION").alias("_day")
    ).distinct()
    spine = with_period_bounds(date_spine(spark, window))
    x = spine_join(v, spine, F.col("_day") >= F.col(TWELVE_MONTHS_AGO))
    day = F.col("_day")
    counts = conditional_distinct(x, ["d"], "bd_linkedcustomer", {
        CURRENT: day >= F.col(MONTH_START),
        LAST_MONTH: (day >= F.col(LAST_MONTH_START)) & (day < F.col(MONTH_START)),
        LAST_YEAR: (day >= F.col(LAST_YEAR_START))
        & (day < F.add_months(F.col(LAST_YEAR_START), 1)),
    })
    out = with_zero_rows(spine, counts, "d", [CURRENT, LAST_MONTH, LAST_YEAR])
    return conform(out.withColumnRenamed("d", "DateOfExecution"), ACTIVE_CLIENTS)


def q_first_validation_per_customer(spark, sf_dir):
    """W2 over the whole validation table: each customer's first tap (ties
    broken by validation id, then support class)."""
    v = _src(spark, sf_dir, "a").validation().filter(F.col("bd_linkedcustomer").isNotNull())
    first = first_per_group(
        v, ["bd_linkedcustomer"],
        [F.col("DTHR_OPERATION").asc(), F.col("validation_id").asc_nulls_last(),
         F.col("bd_support_class").asc_nulls_last()],
    )
    return first.select("bd_linkedcustomer", "DTHR_OPERATION", "validation_id",
                        "bd_support_class", "NUM_LIGNE")


def q_title_sales_upsert(spark, sf_dir):
    """M1: the J1 table after a run at 2001-07-29, then a run at 2001-08-01
    merged into it by (SalesDate, support_type), NULL labels matching."""
    older = q_title_sales_by_support(spark, sf_dir, dt.date(2001, 7, 29))
    newer = q_title_sales_by_support(spark, sf_dir, SALES_AS_OF)
    return upsert(older, newer, TITLE_SALES.keys, null_safe=True)


def q_validation_rate_replace_dates(spark, sf_dir):
    """M6: the J10 table of a run at 2024-01-27 with the dates of a run at
    2024-01-31 replaced."""
    older = q_validation_rate_per_user(spark, sf_dir, dt.date(2024, 1, 27))
    newer = q_validation_rate_per_user(spark, sf_dir, EVENTS_AS_OF)
    return replace_dates(older, newer, "ValidationDate")


def q_validation_counts_update(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    """M3: J9 the reference's way -- insert the day counts with 0, then
    update the previous-year column from last year's counts."""
    inserted, last_year = _counts_and_last_year(spark, sf_dir, _w(as_of, window))
    return update_from(inserted, last_year, ["Date_de_validation", "Type_abonnement"],
                       {"Nombre_de_validation_annee_precedente": "_last_year"})


def _counts_and_last_year(spark, sf_dir, window):
    v = _src(spark, sf_dir, "b").validation().select(
        "DTHR_OPERATION", "LIBEL_LONG_PRODUIRE", "validation_id")
    inserted = on_days(v, "DTHR_OPERATION", window, "Date_de_validation").groupBy(
        "Date_de_validation", F.col("LIBEL_LONG_PRODUIRE").alias("Type_abonnement")
    ).agg(
        F.countDistinct("validation_id").cast("int").alias("Nombre_de_validation"),
        F.lit(0).alias("Nombre_de_validation_annee_precedente"),
    )
    prev_days = [add_months(d, -12) for d in window.days()]
    last_year = on_day_set(v, "DTHR_OPERATION", prev_days, "_ly").groupBy(
        F.add_months("_ly", 12).alias("Date_de_validation"),
        F.col("LIBEL_LONG_PRODUIRE").alias("Type_abonnement"),
    ).agg(F.countDistinct("validation_id").alias("_last_year"))
    return inserted, last_year


def q_duplicate_validation_ids(spark, sf_dir):
    """M7: validation ids that occur more than once."""
    v = _src(spark, sf_dir, "b").validation()
    return duplicate_keys(v, ["validation_id"])


def q_sales_lines_in_lookback(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    """P5 + N6: per execution date, sales rows and transactions on or after
    d - 12 months (no upper bound): the literal least bound is pushed to the
    scan, the exact per-date bound is a broadcast range join on rows reduced
    to (transaction, day) -> rows first."""
    window = _w(as_of, window)
    s = lookback(_src(spark, sf_dir).sales(), "bd_transaction_date", window)
    per_day = s.groupBy("bd_sales_transaction_id", to_day("bd_transaction_date").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"))
    spine = with_period_bounds(date_spine(spark, window)).select("d", TWELVE_MONTHS_AGO)
    x = spine_join(per_day, spine, F.col("_day") >= F.col(TWELVE_MONTHS_AGO))
    return x.groupBy("d").agg(F.sum("_n").alias("n_lines"),
                              F.countDistinct("bd_sales_transaction_id").alias("n_transactions"))


def q_contracts_covering_month(spark, sf_dir, as_of=MONTH_START_AS_OF, window=None):
    """per execution date, contracts that cover the whole month of the
    date (start on or before its first day, end on or after its last)."""
    window = _w(as_of, window)
    sd = _src(spark, sf_dir).sale_detail().select(
        to_day("bd_contract_start_date").alias("_start"),
        to_day("bd_contract_end_date").alias("_end"))
    per_span = sd.groupBy("_start", "_end").agg(F.count(F.lit(1)).alias("_n"))
    spine = with_period_bounds(date_spine(spark, window)).select("d", MONTH_START, "month_end")
    x = spine_join(per_span, spine,
                   covers("_start", "_end", F.col(MONTH_START), F.col("month_end")))
    return x.groupBy("d").agg(F.sum("_n").alias("n_contracts"))


def q_validations_since_account_start(spark, sf_dir, as_of=EVENTS_AS_OF, window=None):
    """Per execution date and known customer, taps on or after
    ``CASE WHEN created < d - 12 months THEN d - 12 months ELSE created END``
    (a NULL creation date keeps nothing)."""
    window = _w(as_of, window)
    s = _src(spark, sf_dir, "a")
    daily = lookback(s.validation(), "DTHR_OPERATION", window).groupBy(
        "bd_linkedcustomer", to_day("DTHR_OPERATION").alias("_day")).agg(
        F.count("validation_id").alias("_n"))
    daily = daily.join(s.contact().select("Id", "createdon"),
                       F.col("bd_linkedcustomer") == F.col("Id"))
    spine = with_period_bounds(date_spine(spark, window)).select("d", TWELVE_MONTHS_AGO)
    x = spine_join(daily, spine,
                   since_account_start("_day", "createdon", F.col(TWELVE_MONTHS_AGO)))
    return x.groupBy("d", "bd_linkedcustomer").agg(F.sum("_n").alias("n_validations"))


def q_avg_weekly_validations_deleted(spark, sf_dir, as_of=EVENTS_AS_OF, window=None):
    """M4 seen from the other side: the rows J5's delete removes (average
    below 4). A NULL average is neither kept by this nor deleted by J5's."""
    s = _src(spark, sf_dir, "a")
    kept_and_deleted = avg_weekly_validations(s.validation(), s.contact(), _w(as_of, window),
                                              min_avg=float("-inf"))
    return kept_and_deleted.filter(F.col("AverageValidationsPerWeek") < 4)


# -- writers: into a table under the checkpoint folder, and read back ----------

def _path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def q_stored_append(spark, sf_dir):
    """S4 + S5/S6 + M2: the J11 run appended twice to a table that was created
    empty; its rows are there twice."""
    path = _path(spark, "append")
    ensure_target(spark, path, SALES_BY_CHANNEL)
    for _ in range(2):
        write_target(q_sales_by_channel(spark, sf_dir), path, SALES_BY_CHANNEL, APPEND)
    return read_target(spark, path, SALES_BY_CHANNEL)


def q_stored_overwrite(spark, sf_dir):
    """M5: the J10 table of an older run, truncated and reloaded."""
    path = _path(spark, "overwrite")
    for as_of in (dt.date(2024, 1, 20), EVENTS_AS_OF):
        write_target(q_validation_rate_per_user(spark, sf_dir, as_of), path, VALIDATION_RATE, OVERWRITE)
    return read_target(spark, path, VALIDATION_RATE)


def q_stored_replace_dates(spark, sf_dir):
    """M6: the J10 table of 2024-01-27, its dates replaced by a run at
    2024-01-31 that finds no tap on 2024-01-25 any more: the date goes."""
    path = _path(spark, "replace")
    older = DateWindow.trailing(dt.date(2024, 1, 27))
    write_target(q_validation_rate_per_user(spark, sf_dir, window=older), path, VALIDATION_RATE,
                 REPLACE_DATES, dates=older.days())
    corrected = _src(spark, sf_dir).validation().filter(
        to_day("DTHR_OPERATION") != F.lit(dt.date(2024, 1, 25)))
    newer = _w(EVENTS_AS_OF)
    write_target(validation_rate_per_user(corrected, newer), path, VALIDATION_RATE,
                 REPLACE_DATES, dates=newer.days())
    return read_target(spark, path, VALIDATION_RATE)


def q_stored_upsert(spark, sf_dir):
    """M1 on storage: as ``title_sales_upsert``, through the stored table."""
    path = _path(spark, "upsert")
    for as_of in (dt.date(2001, 7, 29), SALES_AS_OF):
        upsert_into(spark, path, TITLE_SALES, q_title_sales_by_support(spark, sf_dir, as_of),
                    known_dates=_w(as_of).days())
    return read_target(spark, path, TITLE_SALES)


def q_stored_update(spark, sf_dir, as_of=SALES_AS_OF):
    """M3 on storage: J9's day counts written with 0, then the previous
    year's column updated in the stored table."""
    path, window = _path(spark, "update"), _w(as_of)
    inserted, last_year = _counts_and_last_year(spark, sf_dir, window)
    write_target(inserted, path, VALIDATION_COUNTS, REPLACE_DATES, dates=window.days())
    update_into(spark, path, VALIDATION_COUNTS, last_year.filter(
        F.col("Date_de_validation").isin(window.days())), ["Date_de_validation", "Type_abonnement"],
        {"Nombre_de_validation_annee_precedente": "_last_year"}, known_dates=window.days())
    return read_target(spark, path, VALIDATION_COUNTS)


def _kept(spark, name, src, as_of):
    """A run 8 days before, then the run of ``as_of`` from its state."""
    from billetic.streaming import refresh_last_seen

    path, state = _path(spark, name), _path(spark, f"{name}-state")
    refresh_last_seen(spark, name, src, as_of - dt.timedelta(days=8), path, state)
    return refresh_last_seen(spark, name, src, as_of, path, state)


def q_total_clients_kept(spark, sf_dir, as_of=SALES_AS_OF):
    """J6 from the kept latest day of each client."""
    return _kept(spark, "total_clients", _src(spark, sf_dir), as_of)


def q_active_clients_kept(spark, sf_dir, as_of=SALES_AS_OF, kind="b"):
    """J2 from the kept latest day of each card, customer and month."""
    return _kept(spark, "active_clients", _src(spark, sf_dir, kind), as_of)


def q_validation_rate_late(spark, sf_dir, as_of=EVENTS_AS_OF):
    """J10 over a fact folder where the afternoons of the first ten days come
    weeks late: a first run stores all days, a second replaces those ten."""
    from billetic.streaming import refresh_late

    facts, path, seen = (_path(spark, f"late-{x}") for x in ("facts", "report", "checkpoint"))
    taps, src = _src(spark, sf_dir, "a").validation(), CatalogSources(spark, facts)
    late = (to_day("DTHR_OPERATION") < F.lit(dt.date(2024, 1, 11))) & (F.hour("DTHR_OPERATION") >= 12)
    for rows in (taps.filter(~late), taps.filter(late)):
        rows.write.mode("append").parquet(f"{facts}/validation")
        refresh_late(spark, "validation_rate_per_user", src, f"{facts}/validation", as_of, path, seen)
    return read_target(spark, path, VALIDATION_RATE)


def q_title_sales_colocated(spark, sf_dir, as_of=SALES_AS_OF, window=None):
    """J1 on sale lines stored by transaction: the planner keeps them in
    place where the window's keys are too many to broadcast."""
    s = _src(spark, sf_dir)
    table = f"sale_lines_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store_colocated(s.sale_detail(), table, "bd_sales_transaction_id", buckets, _path(spark, table))
    return title_sales_by_support(read_colocated(spark, table), s.support(), s.sales(), _w(as_of, window))


def q_validation_counts_by_words(spark, sf_dir, as_of=SALES_AS_OF, kind="b"):
    """J9 with its distinct counts from words of 64 ids."""
    return validation_counts_yoy(_src(spark, sf_dir, kind).validation(), _w(as_of, None), by_words=True)


def q_validation_counts_kept(spark, sf_dir, as_of=SALES_AS_OF):
    """J9 from kept words: a run 8 days before, the afternoon taps of the
    window merged twice (no id counts twice), then the run of ``as_of``."""
    from billetic.streaming import merge_taps, refresh_counts

    path, state = _path(spark, "counts"), _path(spark, "counts-state")
    src = _src(spark, sf_dir, "b")
    refresh_counts(spark, src, as_of - dt.timedelta(days=8), path, state)
    taps = on_days(src.validation(), "DTHR_OPERATION", _w(as_of, None)).filter(F.hour("DTHR_OPERATION") >= 4)
    for _ in range(2):
        merge_taps(spark, state, taps)
    return refresh_counts(spark, src, as_of, path, state)


def q_distinct_customers_by_week(spark, sf_dir):
    """A3 rolled up: customers per week and product from the words of the
    days, merged in two parts of the rows that share customers and days."""
    from billetic.streaming import distinct_by_period, merge_taps

    state = _path(spark, "customers-state")
    taps = _src(spark, sf_dir, "a").validation().withColumn("validation_id", F.col("bd_linkedcustomer"))
    early = F.hour("DTHR_OPERATION") < 12
    for part in (taps.filter(early), taps.filter(~early)):
        merge_taps(spark, state, part)
    return distinct_by_period(read_target(spark, state, TAP_WORDS), "week", "customers").withColumnRenamed(
        "Type_abonnement", "product")


def q_validations_by_age_kept(spark, sf_dir, as_of=EVENTS_AS_OF):
    """J8 from its kept state: the days before the window counted by one run,
    the window's days by the next, which reads no others."""
    from billetic.streaming.refresh import refresh_by_age

    path, src = _path(spark, "byage"), _src(spark, sf_dir, "a")
    refresh_by_age(spark, src, as_of - dt.timedelta(days=8), path)
    return refresh_by_age(spark, src, as_of, path)


def q_stored_delete(spark, sf_dir):
    """M4 on storage: all of J5's rows written, those below 4 deleted."""
    path = _path(spark, "delete")
    write_target(q_avg_weekly_validations(spark, sf_dir, min_avg=float("-inf")), path,
                 AVG_WEEKLY_VALIDATIONS, OVERWRITE)
    delete_from(spark, path, AVG_WEEKLY_VALIDATIONS, F.col("AverageValidationsPerWeek") < 4)
    return read_target(spark, path, AVG_WEEKLY_VALIDATIONS)


QUERIES: dict[str, Query] = {
    # jobs
    "title_sales_by_support": q_title_sales_by_support,
    "active_clients": q_active_clients,
    "active_contract_clients": q_active_contract_clients,
    "clients_by_line": q_clients_by_line,
    "avg_weekly_validations": q_avg_weekly_validations,
    "total_clients": q_total_clients,
    "purchase_to_validation_delay": q_purchase_to_validation_delay,
    "validations_by_age": q_validations_by_age,
    "validation_counts_yoy": q_validation_counts_yoy,
    "validation_rate_per_user": q_validation_rate_per_user,
    "sales_by_channel": q_sales_by_channel,
    # jobs at the dates of their traps
    "active_clients_dense": lambda sp, d: q_active_clients(sp, d, EVENTS_AS_OF, "a"),
    "active_contract_clients_month_start":
        lambda sp, d: q_active_contract_clients(sp, d, MONTH_START_AS_OF),
    "purchase_to_validation_delay_two_months":
        lambda sp, d: q_purchase_to_validation_delay(sp, d, MONTH_START_AS_OF),
    "validation_counts_yoy_leap_lookup":
        lambda sp, d: q_validation_counts_yoy(sp, d, LEAP_LOOKUP_AS_OF),
    "validation_counts_yoy_leap_window":
        lambda sp, d: q_validation_counts_yoy(sp, d, LEAP_WINDOW_AS_OF),
    # options of the jobs
    "active_clients_capped": lambda sp, d: q_active_clients(sp, d, cap_at_date=True),
    "active_clients_capped_dense": lambda sp, d: q_active_clients(sp, d, EVENTS_AS_OF, "a", cap_at_date=True),
    "purchase_to_first_validation_after":
        lambda sp, d: q_purchase_to_validation_delay(sp, d, first_after=True),
    "purchase_to_first_validation_after_two_months":
        lambda sp, d: q_purchase_to_validation_delay(sp, d, MONTH_START_AS_OF, first_after=True),
    "validations_by_age_kept": q_validations_by_age_kept,
    "title_sales_colocated": q_title_sales_colocated,
    "total_clients_kept": q_total_clients_kept,
    "active_clients_kept": q_active_clients_kept,
    "active_clients_kept_dense": lambda sp, d: q_active_clients_kept(sp, d, EVENTS_AS_OF, "a"),
    "validation_rate_late": q_validation_rate_late,
    "validation_counts_yoy_by_words": q_validation_counts_by_words,
    "validation_counts_yoy_by_words_dense": lambda sp, d: q_validation_counts_by_words(sp, d, EVENTS_AS_OF, "a"),
    "validation_counts_yoy_kept": q_validation_counts_kept,
    "distinct_customers_by_week": q_distinct_customers_by_week,
    # births after the run: negative ages, where the band variants differ
    "clients_by_line_future_births": lambda sp, d: q_clients_by_line(sp, d, SALES_AS_OF, "b"),
    "validations_by_age_future_births":
        lambda sp, d: q_validations_by_age(sp, d, SALES_AS_OF, dt.date(2001, 1, 1), "b"),
    # accounts older than 12 months (52 weeks), taps inside the lookback band
    "avg_weekly_validations_old_accounts":
        lambda sp, d: q_avg_weekly_validations(sp, d, OLD_ACCOUNTS_AS_OF, 0),
    "validations_since_account_start_old":
        lambda sp, d: q_validations_since_account_start(sp, d, OLD_ACCOUNTS_AS_OF),
    # A window without taps still gives one row per date, zeros
    "active_clients_no_activity": lambda sp, d: q_active_clients(sp, d, NO_TAPS_AS_OF, "a"),
    # operators
    "period_bounds": q_period_bounds,
    "age_bands": q_age_bands,
    "account_weeks": q_account_weeks,
    "equipment_labels": q_equipment_labels,
    "active_clients_by_spine_join": q_active_clients_by_spine_join,
    "first_validation_per_customer": q_first_validation_per_customer,
    "title_sales_upsert": q_title_sales_upsert,
    "validation_rate_replace_dates": q_validation_rate_replace_dates,
    "validation_counts_update": q_validation_counts_update,
    "duplicate_validation_ids": q_duplicate_validation_ids,
    "sales_lines_in_lookback": q_sales_lines_in_lookback,
    "contracts_covering_month": q_contracts_covering_month,
    "validations_since_account_start": q_validations_since_account_start,
    "avg_weekly_validations_deleted": q_avg_weekly_validations_deleted,
    # writers
    "stored_append": q_stored_append,
    "stored_overwrite": q_stored_overwrite,
    "stored_replace_dates": q_stored_replace_dates,
    "stored_upsert": q_stored_upsert,
    "stored_update": q_stored_update,
    "stored_delete": q_stored_delete,
}
