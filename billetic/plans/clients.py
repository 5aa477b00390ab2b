"""Client KPIs: active clients (J2), active contract holders (J3), clients
by line (J4), frequent travellers (J5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billetic.functions import age_band, safe_ratio, to_day, week_diff, year_diff
from billetic.functions.labels import (
    ANONYMOUS_CARD,
    KNOWN_CLIENT,
    UNKNOWN_CLIENT,
    UNKNOWN_CLIENT_ID,
)
from billetic.operators import (
    DateWindow,
    date_spine,
    day_range,
    lookback,
    on_days,
    since_account_start,
    spine_join,
    with_period_bounds,
    with_zero_rows,
)
from billetic.operators.intervals import covered_months, interval_join, month_number
from billetic.operators.window import (
    LAST_MONTH_START,
    LAST_YEAR_START,
    MONTH_START,
    TWELVE_MONTHS_AGO,
    add_months,
    broadcast_spine,
)
from billetic.sources.sinks import delete_where
from billetic.sources.targets import (
    ACTIVE_CLIENTS,
    ACTIVE_CONTRACT_CLIENTS,
    AVG_WEEKLY_VALIDATIONS,
    CLIENTS_BY_LINE,
    conform,
)

TS = "DTHR_OPERATION"
CUSTOMER = "bd_linkedcustomer"
CARD = "bd_mobibnumber"

CURRENT = "CurrentMonthActiveClients"
LAST_MONTH = "LastMonthActiveClients"
LAST_YEAR = "LastYearSameMonthActiveClients"


def active_clients(validations: DataFrame, cards: DataFrame, window: DateWindow,
                   cap_at_date: bool = False) -> DataFrame:
    """Per execution date d, distinct customers (card in the register,
    day >= d - 12 months) active in d's month from its first day on (no
    upper bound), in the previous month, and in the same month last year
    from day d - 12 months on.

    Plan: taps are reduced to (card, customer, month) -> latest day, then
    joined to the card register, then to (customer, month) -> latest
    day. "Active in [lo, month end]" is "latest day in that month >= lo", and
    "active on or after lo" is "latest day overall >= lo", so one small
    histogram of latest days (days x months rows at most) meets the broadcast
    dates once and answers all three counts; the taps are never copied per
    execution date. With ``cap_at_date`` days after d do not count: a customer
    is active in d's month if the first day in that month is on or before d,
    so a histogram of first days takes the place of the latest days overall
    (the other two periods end before d anyway). A customer holding a third of all taps is one row per
    map task after the first partial aggregate.
    """
    per_card = card_days(validations, window.earliest_lookback()).groupBy(*CARD_MONTH).agg(
        F.max("_day").alias("_last"), F.min("_day").alias("_first"))
    return active_clients_of(per_card, cards, window, cap_at_date)


CARD_MONTH = [CARD, CUSTOMER, "_month"]


def card_days(validations: DataFrame, since: dt.date) -> DataFrame:
    """``(card, customer, _month, _day)`` of the customers' taps from ``since``
    on."""
    v = day_range(validations.select(TS, CUSTOMER, CARD), TS, since)
    return v.filter(F.col(CUSTOMER).isNotNull()).select(
        CARD, CUSTOMER, to_day(TS).alias("_day")
    ).withColumn("_month", F.trunc("_day", "MM"))


def active_clients_of(per_card: DataFrame, cards: DataFrame, window: DateWindow,
                      cap_at_date: bool = False) -> DataFrame:
    """J2 from the latest (``_last``) and the first (``_first``, for
    ``cap_at_date`` only) day of each card, customer and month, over the
    window's lookback."""
    spark = per_card.sparkSession
    # ``IN (SELECT DISTINCT card)`` as an inner join with the plain register:
    # Catalyst would push a semi-join below the aggregate onto raw taps; the
    # inner join stays on the reduced rows, so a register too big to broadcast
    # shuffles (card, customer, month) rows, not a year of taps. A card listed
    # twice repeats rows that the max absorbs; without a distinct() between
    # the exchange and the join, AQE can split a card of very many customers.
    known = per_card.join(cards.select(CARD), CARD)
    per_month = known.groupBy(CUSTOMER, "_month").agg(
        F.max("_last").alias("_last"), F.min("_first").alias("_first"))

    # One small histogram, tagged: the latest day within each month, and either
    # the latest day overall per customer ("_month" NULL) or, capped, the first
    # day within each month.
    none = F.lit(None).cast("date")
    if cap_at_date:
        other = per_month.select("_month", none.alias("_last"), "_first")
    else:
        other = per_month.groupBy(CUSTOMER).agg(F.max("_last").alias("_last")).select(
            none.alias("_month"), "_last", none.alias("_first"))
    hist = other.unionByName(per_month.select("_month", "_last", none.alias("_first"))).groupBy(
        "_month", "_last", "_first"
    ).agg(F.count(F.lit(1)).alias("n"))

    spine = with_period_bounds(date_spine(spark, window))
    m, last = F.col("_month"), F.col("_last")
    if cap_at_date:
        is_cur = (m == F.col(MONTH_START)) & (F.col("_first") <= F.col("d"))
    else:
        is_cur = m.isNull() & (last >= F.col(MONTH_START))
    is_last = (m == F.col(LAST_MONTH_START)) & last.isNotNull()
    is_last_year = (m == F.col(LAST_YEAR_START)) & (last >= F.col(TWELVE_MONTHS_AGO))
    joined = spine_join(hist, spine, is_cur | is_last | is_last_year)
    counts = joined.groupBy("d").agg(
        *[F.sum(F.when(cond, F.col("n"))).alias(name)
          for name, cond in ((CURRENT, is_cur), (LAST_MONTH, is_last), (LAST_YEAR, is_last_year))]
    )
    out = with_zero_rows(spine, counts, "d", [CURRENT, LAST_MONTH, LAST_YEAR])
    return conform(out.withColumnRenamed("d", "DateOfExecution"), ACTIVE_CLIENTS)


# J3's periods, and by how many months each lies before the run's month.
PERIODS = {"cur": 0, "last": 1, "last_year": 12}
COVERS, ANY = "covers", "any"


def _contract_spans(
    sale_detail: DataFrame, article: DataFrame, window: DateWindow, first: int, last: int
) -> DataFrame:
    """``(contact, product, _from, _to, _start)``: per contact, product and
    span of whole months covered between the months ``first`` and ``last``,
    the latest contract start (NULL span: covers none of them)."""
    sd = sale_detail.select("bd_contact_linked", "bd_article_code_lookup",
                            "bd_contract_start_date", "bd_contract_end_date")
    sd = day_range(sd, "bd_contract_start_date", window.earliest_lookback(12))
    sd = sd.join(article, F.col("bd_article_code_lookup") == F.col("bd_articleid"))
    since, until = covered_months("bd_contract_start_date", "bd_contract_end_date")
    any_month = (since <= until) & (since <= F.lit(last)) & (until >= F.lit(first))
    return sd.select(
        "bd_contact_linked", "bd_productlonglabel",
        F.when(any_month, F.greatest(since, F.lit(first))).alias("_from"),
        F.when(any_month, F.least(until, F.lit(last))).alias("_to"),
        to_day("bd_contract_start_date").alias("_start"),
    ).groupBy("bd_contact_linked", "bd_productlonglabel", "_from", "_to").agg(
        F.max("_start").alias("_start"))


def _contract_periods(spark, window: DateWindow) -> DataFrame:
    """``(_kind, _at, _month, _period)``: the periods of each month of the
    window, with the month each one asks about; "any" asks about its own."""
    months = window.month_starts()
    uses = [(COVERS, name, back) for name, back in PERIODS.items()] + [(ANY, ANY, 0)]
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(months[0]), F.lit(months[-1]), F.expr("INTERVAL 1 MONTH"))).alias("_month")
    ).select("_month", F.explode(F.array(*[F.struct(
        F.lit(kind).alias("_kind"), F.lit(name).alias("_period"),
        (month_number("_month") - back).alias("_at")) for kind, name, back in uses])).alias("_p")
    ).select("_month", "_p.*")


def active_contract_clients(
    sale_detail: DataFrame, contact: DataFrame, article: DataFrame, window: DateWindow
) -> DataFrame:
    """Per execution date d, product and age band (variant A, age at the
    first of d's month), distinct contacts whose contract -- started on or
    after d - 12 months -- covers the whole current month, the previous
    month, the same month last year. A group exists for d when any of its
    contracts started on or after d - 12 months.

    A contract covers a span of whole months, so contracts are reduced to the
    latest start per (contact, product, span) before anything is copied. The
    reduced rows meet the window's periods in an interval join (the periods
    grow with the calendar only, and are broadcast). For a fixed month and
    period the rest is "latest covering start >= d - 12 months", answered per
    date from a histogram of those starts. One pass over the contracts and
    one plan, for any window.
    """
    spark = sale_detail.sparkSession
    months = [m.year * 12 + m.month for m in window.month_starts()]
    first, last = months[0] - max(PERIODS.values()), months[-1]
    spans = _contract_spans(sale_detail, article, window, first, last)
    clients = spans.join(contact.select("Id", "birthdate"), F.col("bd_contact_linked") == F.col("Id"))
    # "any" counts for every month of the window, whose age bands differ
    asked = clients.select(
        "bd_contact_linked", "bd_productlonglabel", "birthdate", "_start", F.explode(F.array(
            F.struct(F.lit(COVERS).alias("_kind"), "_from", "_to"),
            F.struct(F.lit(ANY).alias("_kind"), F.lit(months[0]).alias("_from"),
                     F.lit(last).alias("_to")))).alias("_s"),
    ).select("*", "_s.*").drop("_s")
    met = interval_join(asked, broadcast_spine(_contract_periods(spark, window)), "_from", "_to", "_at",
                        first, last, width=12, keys=["_kind"])
    # distinct contacts: a contact listed twice in the contact table with
    # two birth dates of the same band is still one client of that band
    latest = met.groupBy(
        F.col("bd_productlonglabel").alias("type_abonnement"),
        age_band(year_diff("birthdate", "_month")).alias("Categorie_age"),
        "bd_contact_linked", "_month", "_period",
    ).agg(F.max("_start").alias("_start"))
    hist = latest.groupBy("type_abonnement", "Categorie_age", "_month", "_period", "_start").agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = with_period_bounds(date_spine(spark, window)).select(
        "d", MONTH_START, TWELVE_MONTHS_AGO)
    on_or_after = (F.col("_month") == F.col(MONTH_START)) & (F.col("_start") >= F.col(TWELVE_MONTHS_AGO))
    out = spine_join(hist, spine, on_or_after).groupBy("d", "type_abonnement", "Categorie_age").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("_period") == p, F.col("n"))), F.lit(0)).alias(name)
            for p, name in ((ANY, "_any"), ("cur", CURRENT), ("last", LAST_MONTH),
                            ("last_year", LAST_YEAR))
        ]
    ).filter(F.col("_any") > 0)
    return conform(out.withColumnRenamed("d", "DateOfExecution"), ACTIVE_CONTRACT_CLIENTS)


def clients_by_line(
    validations: DataFrame, contact: DataFrame, line: DataFrame, window: DateWindow
) -> DataFrame:
    """Per execution date, the distinct (known client, line label) pairs
    with age and band (variant B, age at the first of the month), plus one
    anonymous row per line label that had a tap on card '0'.

    Taps are reduced to distinct (day, customer, line) before the joins, so
    the dimension joins see one row per client-line-day, not one per tap.
    """
    v = on_days(validations.select(TS, CUSTOMER, CARD, "NUM_LIGNE"), TS, window, "DateOfExecution")
    line = line.select("NUM_LIGNE", "LIBEL_LIGNE")

    # For a given date the output columns are functions of (id, birth year,
    # line label) and back, so the final DISTINCT runs on those narrow keys
    # and the strings are derived after it.
    known = (
        v.filter(F.col(CUSTOMER).isNotNull())
        .select("DateOfExecution", CUSTOMER, "NUM_LIGNE").distinct()
        .join(contact.select("Id", F.year("birthdate").alias("_birth_year")),
              F.col(CUSTOMER) == F.col("Id"))
        .join(line, "NUM_LIGNE")
        .select("DateOfExecution", "Id", "_birth_year", "LIBEL_LIGNE").distinct()
    )
    age = F.year("DateOfExecution") - F.col("_birth_year")
    known = known.select(
        "DateOfExecution",
        F.col("Id").cast("string").alias("ClientID"),
        age.cast("int").alias("Age"),
        "LIBEL_LIGNE",
        age_band(age, open_low=True).alias("AgeCategory"),
        F.lit(KNOWN_CLIENT).alias("ClientType"),
    )

    anonymous = (
        v.filter(F.col(CARD) == ANONYMOUS_CARD)
        .select("DateOfExecution", "NUM_LIGNE").distinct()
        .join(line, "NUM_LIGNE")
        .select(
            "DateOfExecution",
            F.lit(UNKNOWN_CLIENT_ID).alias("ClientID"),
            F.lit(None).cast("int").alias("Age"),
            "LIBEL_LIGNE",
            F.lit(None).cast("string").alias("AgeCategory"),
            F.lit(UNKNOWN_CLIENT).alias("ClientType"),
        )
        .distinct()
    )
    return conform(known.unionByName(anonymous), CLIENTS_BY_LINE)


def avg_weekly_validations(
    validations: DataFrame, contact: DataFrame, window: DateWindow, min_avg: float = 4
) -> DataFrame:
    """Per execution date d and customer, validations since
    max(account creation, d - 12 months) (no upper bound), the number of
    weeks, the weekly average (over 52 weeks for old accounts, else over the
    weeks from creation to d - 1); rows with an average below ``min_avg`` are
    deleted (a NULL average stays).

    Taps are first counted per (customer, day). The per-date lower bound
    ``lb(d) = max(created, d - 12 months)`` only moves inside the band
    ``[max(created, first d - 12m), max(created, last d - 12m))``. So one row
    per customer holds the sum of the days at or above the band's top, which
    count for every date, and a list of the days inside the band (at most one
    per window date). The dates are expanded after that last shuffle; no
    customer's history is copied per execution date.
    """
    v = lookback(validations.select(TS, CUSTOMER, "validation_id"), TS, window)
    daily = (
        v.filter(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER, to_day(TS).alias("_day"))
        .agg(F.count("validation_id").alias("_n"))
    )
    # a NULL creation date makes the reference's bound NULL: no row counts
    daily = daily.join(
        contact.select("Id", "createdon").filter(F.col("createdon").isNotNull()),
        F.col(CUSTOMER) == F.col("Id"),
    )
    created, day = F.col("createdon"), F.col("_day")
    first_bound = F.lit(window.earliest_lookback(12))
    last_bound = F.lit(add_months(window.end, -12))
    band_top = F.when(created > last_bound, created).otherwise(last_bound)
    band_bottom = F.when(created > first_bound, created).otherwise(first_bound)
    above, in_band = day >= band_top, (day >= band_bottom) & (day < band_top)
    per_customer = daily.filter(above | in_band).groupBy(CUSTOMER, "createdon").agg(
        F.count(F.when(above, 1)).alias("_days"),
        F.coalesce(F.sum(F.when(above, F.col("_n"))), F.lit(0)).alias("_sum"),
        F.collect_list(F.when(in_band, F.struct("_day", "_n"))).alias("_band"),
    )
    per_date = per_customer.select("*", F.explode(F.sequence(
        F.lit(window.start), F.lit(window.end), F.expr("INTERVAL 1 DAY"))).alias("d"))
    counted = F.filter("_band", lambda b: since_account_start(
        b["_day"], "createdon", F.add_months(F.col("d"), -12)))
    g = per_date.withColumn("_counted", counted).filter(
        (F.col("_days") > 0) | (F.size("_counted") > 0)).select(
        "d", CUSTOMER, "createdon",
        (F.col("_sum") + F.aggregate("_counted", F.lit(0).cast("long"), lambda s, b: s + b["_n"])).alias("_cnt"))

    lb = F.add_months(F.col("d"), -12)
    old = created < lb
    weeks = F.when(old, F.lit(52)).otherwise(week_diff("createdon", "d"))
    average = F.when(old, F.col("_cnt").cast("double") / F.lit(52)).otherwise(
        safe_ratio("_cnt", week_diff("createdon", F.date_sub(F.col("d"), 1)))
    )
    out = g.select(
        F.col(CUSTOMER).cast("string").alias("ClientID"),
        to_day("createdon").alias("AccountCreationDate"),
        F.col("d").alias("DateOfExecution"),
        F.col("_cnt").cast("double").alias("ValidationCount"),
        F.when(weeks != 0, weeks).alias("Weeks"),
        average.alias("AverageValidationsPerWeek"),
    )
    out = delete_where(out, F.col("AverageValidationsPerWeek") < F.lit(min_avg))
    return conform(out, AVG_WEEKLY_VALIDATIONS)
