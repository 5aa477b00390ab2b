"""Validation KPIs: purchase-to-validation delay (J7), validations by age
(J8), validation counts with the previous year (J9), validations per user
(J10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billetic.functions import age_band, day_diff, safe_ratio, to_day
from billetic.operators import (
    DateWindow,
    add_months,
    count_words,
    date_spine,
    day_range,
    first_per_group,
    id_words,
    merge_words,
    next_row_join,
    on_day_set,
    on_days,
    shift_join,
    spine_join,
)
from billetic.operators.window import first_of_month
from billetic.sources.targets import (
    BY_BIRTH_YEAR,
    PURCHASE_DELAY,
    TAP_WORDS,
    VALIDATION_COUNTS,
    VALIDATION_RATE,
    VALIDATIONS_BY_AGE,
    conform,
)

TS = "DTHR_OPERATION"
CUSTOMER = "bd_linkedcustomer"
PRODUCT = "LIBEL_LONG_PRODUIRE"

# J8's history starts here (the reference hard-codes it).
HISTORY_START = dt.date(2023, 1, 1)


def _passes(month_col: str, months: list[dt.date]) -> F.Column:
    """The month-start passes a month's row belongs to: every window month
    start on or before it (a pass reads "day >= month start", no upper
    bound)."""
    arr = F.array(*[F.lit(m) for m in months])
    return F.explode(F.filter(arr, lambda m: m <= F.col(month_col)))


def purchase_to_validation_delay(
    sales: DataFrame, validations: DataFrame, window: DateWindow, copies: bool = False,
    first_after: bool = False,
) -> DataFrame:
    """For each month start M of the window (one pass per month, as the
    reference's per-date loop only depends on the month): each contact's
    last purchase per article since M, the contact's first validation since
    M, and the delay in days, kept when the validation is not before the
    purchase. When the window spans two months the passes are merged with
    ``distinct``. ``copies=True`` gives the reference's literal output
    instead: one copy of a month's rows per execution date in that month.

    ``first_after=True`` takes the contact's first validation at or after the
    purchase instead of the first of the month, so that a customer who also
    tapped earlier in the month is not dropped (``next_row_join``: one sort per
    customer and day, borders carried between days).

    Sales and taps are first reduced by calendar month (the last purchase, the
    first tap of each); only the reduced rows are copied to the passes and
    reduced again, so a backfill of a year copies no fact row.

    The first validation per customer and month uses ``row_number() = 1`` with
    a total order (time, validation id, support class); Spark keeps one row
    per key in each map task before the shuffle (``WindowGroupLimit``), so a
    customer with a third of all taps is not sorted in one task. No semi-join
    to the buyers before it: that would shuffle every tap, while the inner
    join afterwards sees one row per customer.
    """
    months = window.month_starts()
    s = day_range(sales.select("bd_contact_linked", "bd_articlelonglabel", "bd_transaction_date"),
                  "bd_transaction_date", months[0])
    who = ["bd_contact_linked", "bd_articlelonglabel"]
    last_tx = s.filter(F.col("bd_contact_linked").isNotNull()).groupBy(
        *who, F.trunc("bd_transaction_date", "MM").alias("_month")
    ).agg(F.max("bd_transaction_date").alias("_max_tx"))
    last_tx = last_tx.select(*who, "_max_tx", _passes("_month", months).alias("_pass")).groupBy(
        "_pass", *who).agg(F.max("_max_tx").alias("_max_tx"))

    v = day_range(validations.select(TS, CUSTOMER, "validation_id", "bd_support_class"), TS,
                  months[0])
    v = v.filter(F.col(CUSTOMER).isNotNull()).withColumn("_month", F.trunc(TS, "MM"))
    earliest = [F.col(TS).asc(), F.col("validation_id").asc_nulls_last(),
                F.col("bd_support_class").asc_nulls_last()]
    if first_after:
        pairs = next_row_join(
            last_tx.withColumnRenamed("bd_contact_linked", CUSTOMER), v, [CUSTOMER], "_max_tx", TS,
            ties=["validation_id", "bd_support_class"])
        return _delays(pairs.withColumnRenamed(CUSTOMER, "bd_contact_linked"), window, months, copies)
    per_month = first_per_group(v, [CUSTOMER, "_month"], earliest)
    first = first_per_group(
        per_month.select(TS, CUSTOMER, "validation_id", "bd_support_class",
                         _passes("_month", months).alias("_vpass")),
        ["_vpass", CUSTOMER], earliest)
    joined = last_tx.join(
        first,
        (F.col("_pass") == F.col("_vpass")) & (F.col("bd_contact_linked") == F.col(CUSTOMER)),
    ).filter(F.col(TS) >= F.col("_max_tx"))
    return _delays(joined, window, months, copies)


def _delays(joined: DataFrame, window: DateWindow, months: list[dt.date], copies: bool) -> DataFrame:
    """The report's rows from (pass, contact, article, purchase, tap)."""
    out = joined.select(
        "_pass",
        F.col("bd_contact_linked").cast("string").alias("bd_contact_linked"),
        "bd_articlelonglabel",
        "bd_support_class",
        to_day("_max_tx").alias("max_transaction_date"),
        to_day(TS).alias("first_validation_date_after_transaction"),
        day_diff("_max_tx", TS).alias("Delai"),
    )
    if copies:
        dates = date_spine(out.sparkSession, window).select(
            F.trunc("d", "MM").alias("_pass"), "d")
        return conform(spine_join(out, dates.withColumnRenamed("_pass", "_m"),
                                  F.col("_pass") == F.col("_m")), PURCHASE_DELAY)
    out = out.drop("_pass")
    if len(months) > 1:
        # passes overlap (an earlier month's pass sees the later months too);
        # with a single pass each (contact, article) row is already unique
        out = out.distinct()
    return conform(out, PURCHASE_DELAY)


def validations_by_birth_year(
    validations: DataFrame, contact: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """J8's exact counts per day from ``start`` up to (not including)
    ``end``, with the birth year in place of the age: rows of one day depend
    on that day's taps only and never change as time goes on, so they can be
    kept (``BY_BIRTH_YEAR``) and aged when they are read."""
    v = day_range(validations.select(TS, PRODUCT, "bd_support_class", CUSTOMER, "validation_id"), TS, start, end)
    j = v.join(contact.select("Id", F.year("birthdate").alias("Annee_naissance")), F.col(CUSTOMER) == F.col("Id"))
    agg = j.groupBy(
        to_day(TS).alias("Date_de_validation"),
        F.col(PRODUCT).alias("Type_abonnement"),
        F.col("bd_support_class").alias("Type_support"),
        "Annee_naissance",
    ).agg(F.countDistinct("validation_id").alias("Nombre_de_validation"))
    return conform(agg, BY_BIRTH_YEAR)


def aged(by_birth_year: DataFrame, as_of: dt.date) -> DataFrame:
    """J8's rows from counts by birth year, for a run at ``as_of``."""
    age = F.lit(first_of_month(as_of - dt.timedelta(days=1)).year) - F.col("Annee_naissance")
    out = by_birth_year.select("*", age.alias("Age"), age_band(age).alias("Categorie_age"))
    return conform(out, VALIDATIONS_BY_AGE)


def validations_by_age(
    validations: DataFrame, contact: DataFrame, as_of: dt.date, start: dt.date = HISTORY_START
) -> DataFrame:
    """Per validation day from ``start`` to the day before ``as_of``,
    product, support class, age (year of the day before ``as_of`` minus birth
    year, for all history) and band (variant A): distinct validations of
    known clients. Exact distinct count: Spark aggregates (keys, id) first,
    so a hot group is spread over tasks by id."""
    # Age and band are a one-to-one function of the birth year within a run
    # (NULL <-> NULL), so the distinct count is grouped by the year (one int
    # per shuffled row) and age and band are derived from the aggregate.
    return aged(validations_by_birth_year(validations, contact, start, as_of), as_of)


DAY_PRODUCT = ["Date_de_validation", "Type_abonnement"]


def validation_counts_yoy(validations: DataFrame, window: DateWindow, by_words: bool = False) -> DataFrame:
    """Per day of the window and product, distinct validations, and the
    count of the same product on ``add_months(day, -12)``.

    Last year's rows are the days ``{add_months(d, -12)}`` exactly (never a
    range: 2024-02-28 and 2024-02-29 both shift to 2025-02-28), shifted back
    by 12 months and left-joined on (day, product); a 29 February therefore
    finds nothing and keeps 0, and a NULL product never matches.

    ``by_words`` counts integer ids in words of 64 (``id_words``): less
    shuffle where a day's ids lie close together; same rows.
    """
    v = validations.select(TS, F.col(PRODUCT).alias("Type_abonnement"), "validation_id")
    cur = on_days(v, TS, window, "Date_de_validation")
    prev = on_day_set(v, TS, _year_before(window), "_ly_day").withColumn(
        "Date_de_validation", F.add_months("_ly_day", 12))
    if by_words:
        cur, prev = (id_words(x, DAY_PRODUCT, "validation_id") for x in (cur, prev))
        return _with_last_year(count_words(cur, DAY_PRODUCT), count_words(prev, DAY_PRODUCT))
    cur, prev = (x.groupBy(*DAY_PRODUCT).agg(F.countDistinct("validation_id").alias("n")) for x in (cur, prev))
    return _with_last_year(cur, prev)


def _year_before(window: DateWindow) -> list[dt.date]:
    return [add_months(d, -12) for d in window.days()]


def _with_last_year(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """J9's rows from the counts ``n`` of the window's days and of the days a
    year before, these already under the date that shows them."""
    out = shift_join(cur.withColumnRenamed("n", "Nombre_de_validation"), prev.withColumnRenamed("n", "_prev"),
                     "Date_de_validation", ["Type_abonnement"], "_prev", "Nombre_de_validation_annee_precedente")
    return conform(out, VALIDATION_COUNTS)


def tap_words(validations: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The distinct taps of each day from ``start`` up to (not including)
    ``end`` and product, as words that can be kept and merged."""
    v = day_range(validations.select(TS, PRODUCT, "validation_id"), TS, start, end)
    days = v.select(to_day(TS).alias("Date_de_validation"), F.col(PRODUCT).alias("Type_abonnement"), "validation_id")
    return conform(id_words(days, DAY_PRODUCT, "validation_id"), TAP_WORDS)


def validation_counts_of(words: DataFrame, window: DateWindow) -> DataFrame:
    """J9 from kept words (``tap_words``), one row per day, product and word."""
    day = F.col("Date_de_validation")
    cur = words.filter(day.between(F.lit(window.start), F.lit(window.end)))
    prev = words.filter(day.isin(_year_before(window))).withColumn("Date_de_validation", F.add_months(day, 12))
    return _with_last_year(count_words(cur, DAY_PRODUCT), count_words(merge_words(prev, DAY_PRODUCT), DAY_PRODUCT))


def validation_rate_per_user(validations: DataFrame, window: DateWindow) -> DataFrame:
    """Per day of the window, taps per identified customer: all taps
    (anonymous ones too) over distinct non-NULL customers; NULL when a day
    has only anonymous taps, no row for a day without taps. One group-by:
    the reference's per-customer counts re-joined to the per-day users are
    the same sums."""
    v = on_days(validations.select(TS, CUSTOMER), TS, window, "ValidationDate")
    agg = v.groupBy("ValidationDate").agg(
        F.count(F.lit(1)).alias("_n"), F.countDistinct(CUSTOMER).alias("_users")
    )
    return conform(
        agg.select("ValidationDate", safe_ratio("_n", "_users").alias("AverageValidationsPerUser")),
        VALIDATION_RATE,
    )
