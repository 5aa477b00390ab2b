"""Hand-made cases for the traps of each job (FIXTURES.md section 4);
expected rows worked out by hand from the reference's rules."""

import datetime as dt
from decimal import Decimal

from billetic.operators import DateWindow
from billetic.plans.clients import (
    active_clients,
    active_contract_clients,
    avg_weekly_validations,
    clients_by_line,
)
from billetic.plans.sales import sales_by_channel, title_sales_by_support, total_clients
from billetic.plans.validations import (
    purchase_to_validation_delay,
    validation_counts_yoy,
    validation_rate_per_user,
)
from billetic.sources.sinks import upsert

D, T = dt.date, dt.datetime

VALIDATION = ("validation_id long, DTHR_OPERATION timestamp_ntz, bd_linkedcustomer long, "
              "bd_mobibnumber string, NUM_LIGNE long, LIBEL_LONG_PRODUIRE string, "
              "bd_support_class string")
SALES = ("bd_sales_transaction_id long, bd_transaction_date timestamp_ntz, bd_contact_linked long, "
         "bd_productlonglabel string, bd_articlelonglabel string, bd_equipment_type string, "
         "bd_global_amount decimal(18,2)")
SALE_DETAIL = ("bd_sales_transaction_id long, bd_support_serial_number_lookup long, "
               "bd_contact_linked long, bd_article_code_lookup long, "
               "bd_contract_start_date timestamp_ntz, bd_contract_end_date timestamp_ntz")
CONTACT = "Id long, birthdate date, createdon date"


def tap(vid, when, customer, card=None, line=1, product="P", klass="S0"):
    card = card if card is not None else (str(customer) if customer is not None else "0")
    return (vid, when, customer, card, line, product, klass)


def sale(tx, when, contact, product="P", article="A", equipment="MG", amount="1.00"):
    return (tx, when, contact, product, article, equipment, Decimal(amount))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# -- J1 ------------------------------------------------------------------------

def _j1_inputs(spark):
    day = T(2024, 5, 2)
    sd = spark.createDataFrame([
        (1, 10, 1, 1, None, None), (1, 10, 1, 1, None, None),        # 2 lines on tx 1
        (2, 20, 1, 1, None, None), (3, 20, 1, 1, None, None), (4, 20, 1, 1, None, None),
        (5, 21, 1, 1, None, None), (6, 21, 1, 1, None, None), (7, 21, 1, 1, None, None),
        (8, 21, 1, 1, None, None),                                    # 7 sales on 2 cards
        (9, 30, 1, 1, None, None),                                    # unknown support code
        (10, None, 1, 1, None, None),                                 # no card: ignored
    ], SALE_DETAIL)
    support = spark.createDataFrame(
        [(10, 899240000), (20, 899240001), (21, 899240001), (30, 899240005)],
        "id long, bd_id_support_label int")
    sales = spark.createDataFrame(
        [sale(1, day, 1)] * 3 + [sale(t, day, 1) for t in range(2, 11)], SALES)
    return sd, support, sales


def test_j1_multiplicity_whole_division_and_null_label(spark):
    sd, support, sales = _j1_inputs(spark)
    out = title_sales_by_support(sd, support, sales, DateWindow.single(D(2024, 5, 2)))
    assert rows(out, "support_type", "Sales", "unique_cards", "average_sales") == sorted([
        ("Billet Papier", 6, 1, 6),          # 2 sale lines x 3 sales rows
        ("Carte MOBIB", 7, 2, 3),            # 7 // 2
        (None, 1, 1, 1),
    ], key=str)


def test_j1_upsert_twice_null_safe_and_literal(spark):
    sd, support, sales = _j1_inputs(spark)
    src = title_sales_by_support(sd, support, sales, DateWindow.single(D(2024, 5, 2)))
    safe = upsert(upsert(src, src, ["SalesDate", "support_type"]), src, ["SalesDate", "support_type"])
    assert safe.filter("support_type IS NULL").count() == 1
    assert safe.count() == 3
    literal = upsert(src, src, ["SalesDate", "support_type"], null_safe=False)
    assert literal.filter("support_type IS NULL").count() == 2


# -- J2 ------------------------------------------------------------------------

def test_j2_periods_register_and_zero_rows(spark):
    v = spark.createDataFrame([
        tap(1, T(2024, 3, 20, 8), 1),            # after d, same month: current
        tap(2, T(2024, 2, 29, 8), 2),            # last month
        tap(3, T(2023, 3, 5, 8), 3),             # last year's month, before d - 12 months
        tap(4, T(2023, 3, 15, 8), 4),            # last year's month, after d - 12 months
        tap(5, T(2024, 3, 11, 8), 5),            # card not in the register
        tap(6, T(2024, 3, 1, 8), None),          # anonymous
    ], VALIDATION)
    cards = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("0",)], "bd_mobibnumber string")
    out = active_clients(v, cards, DateWindow(D(2024, 3, 10), D(2024, 3, 10)))
    assert rows(out, "DateOfExecution", "CurrentMonthActiveClients", "LastMonthActiveClients",
                "LastYearSameMonthActiveClients") == [(D(2024, 3, 10), 1, 1, 1)]

    empty = spark.createDataFrame([], VALIDATION)
    out = active_clients(empty, cards, DateWindow(D(2024, 3, 1), D(2024, 3, 3)))
    assert rows(out, "DateOfExecution", "CurrentMonthActiveClients", "LastMonthActiveClients",
                "LastYearSameMonthActiveClients") == [
        (D(2024, 3, 1), 0, 0, 0), (D(2024, 3, 2), 0, 0, 0), (D(2024, 3, 3), 0, 0, 0)]


# -- J3 ------------------------------------------------------------------------

def test_j3_first_of_month_and_contract_from_the_second(spark):
    sd = spark.createDataFrame([
        (1, None, 1, 100, T(2023, 3, 1), T(2024, 12, 31)),   # starts on last year's 1st
        (2, None, 2, 100, T(2023, 6, 1), T(2024, 12, 31)),
        (3, None, 3, 100, T(2024, 3, 2), T(2024, 12, 31)),   # starts on the 2nd
    ], SALE_DETAIL)
    contact = spark.createDataFrame(
        [(i, D(1990, 1, 1), D(2020, 1, 1)) for i in (1, 2, 3)], CONTACT)
    article = spark.createDataFrame([(100, "Abo")], "bd_articleid long, bd_productlonglabel string")
    out = active_contract_clients(sd, contact, article, DateWindow(D(2024, 3, 1), D(2024, 3, 2)))
    got = rows(out, "DateOfExecution", "type_abonnement", "Categorie_age",
               "CurrentMonthActiveClients", "LastMonthActiveClients", "LastYearSameMonthActiveClients")
    # d = 1st: contracts 1 and 2 cover March and February, contract 1 also
    # March last year; contract 3 starts after the 1st. d = 2nd: contract 1
    # started before d - 12 months and is dropped; last year is 0.
    assert got == [
        (D(2024, 3, 1), "Abo", "24-40 ans", 2, 2, 1),
        (D(2024, 3, 2), "Abo", "24-40 ans", 1, 1, 0),
    ]


# -- J4 ------------------------------------------------------------------------

def test_j4_card_zero_with_customer_and_shared_label(spark):
    v = spark.createDataFrame([
        tap(1, T(2024, 1, 5, 8), 7, card="0", line=1),   # anonymous card with a customer
        tap(2, T(2024, 1, 5, 9), 7, line=2),             # line 2 has the same label
        tap(3, T(2024, 1, 5, 9), None, line=3),          # anonymous, no customer
    ], VALIDATION)
    contact = spark.createDataFrame([(7, D(2030, 1, 1), D(2020, 1, 1))], CONTACT)
    line = spark.createDataFrame([(1, "L1"), (2, "L1"), (3, "L3")], "NUM_LIGNE long, LIBEL_LIGNE string")
    out = clients_by_line(v, contact, line, DateWindow.single(D(2024, 1, 5)))
    assert rows(out, "ClientID", "Age", "LIBEL_LIGNE", "AgeCategory", "ClientType") == sorted([
        ("7", -6, "L1", "0-12 ans", "Client Connu"),      # variant B: negative age is 0-12
        ("N/A", None, "L1", None, "Client Non Connu"),
        ("N/A", None, "L3", None, "Client Non Connu"),
    ], key=str)


# -- J5 ------------------------------------------------------------------------

def test_j5_weeks_rules_threshold_and_null_creation(spark):
    old = D(2020, 1, 1)
    taps = [tap(1, T(2024, 1, 6, 8), 1)]                          # created Sat, d Sun
    taps += [tap(2, T(2024, 1, 7, 8), 2)]                         # created Sun, d Mon
    taps += [tap(100 + i, T(2023, 6, 1, 8), 3) for i in range(208)]   # 208 / 52 = 4.0
    taps += [tap(400 + i, T(2023, 6, 1, 8), 4) for i in range(207)]   # 207 / 52 < 4
    taps += [tap(700 + i, T(2023, 6, 1, 8), 5) for i in range(300)]   # no creation date
    v = spark.createDataFrame(taps, VALIDATION)
    contact = spark.createDataFrame([
        (1, None, D(2024, 1, 6)), (2, None, D(2024, 1, 7)), (3, None, old), (4, None, old),
        (5, None, None),
    ], CONTACT)
    sat_sun = avg_weekly_validations(v, contact, DateWindow.single(D(2024, 1, 7)))
    got = {r.ClientID: (r.ValidationCount, r.Weeks, r.AverageValidationsPerWeek)
           for r in sat_sun.collect()}
    # customer 2 (created that Sunday): the divisor ends on Saturday, so the
    # average is 1 / -1 and the delete removes the row.
    assert got == {"1": (1.0, 1, None), "3": (208.0, 52, 4.0)}

    sun_mon = avg_weekly_validations(v, contact, DateWindow.single(D(2024, 1, 8)))
    got = {r.ClientID: (r.Weeks, r.AverageValidationsPerWeek) for r in sun_mon.collect()}
    assert got["2"] == (None, None)


# -- J6 ------------------------------------------------------------------------

def test_j6_contacts_per_product_and_null_product(spark):
    sales = spark.createDataFrame([
        sale(1, T(2024, 1, 2), 9, product="P1"),
        sale(2, T(2024, 1, 3), 9, product="P2"),          # same contact, other product
        sale(3, T(2024, 1, 3), None, product="P1"),       # anonymous transaction, 2 rows
        sale(3, T(2024, 1, 3), None, product="P1"),
        sale(4, T(2024, 1, 4), 8, product=None),          # NULL product is a group
        sale(5, T(2022, 1, 4), 7, product="P1"),          # older than 12 months
    ], SALES)
    out = total_clients(sales, DateWindow.single(D(2024, 1, 10)))
    assert rows(out, "type_abonnement", "total_clients") == sorted(
        [("P1", 2), ("P2", 1), (None, 1)], key=str)


# -- J7 ------------------------------------------------------------------------

def test_j7_validation_before_purchase_ties_and_two_months(spark):
    sales = spark.createDataFrame([
        sale(1, T(2024, 2, 10), 1, article="A"),
        sale(2, T(2024, 2, 10), 2, article="B"),
    ], SALES)
    v = spark.createDataFrame([
        tap(1, T(2024, 2, 5, 8), 1), tap(2, T(2024, 2, 20, 8), 1),      # first one before purchase
        tap(9, T(2024, 2, 12, 8), 2, klass="Z"), tap(3, T(2024, 2, 12, 8), 2, klass="Y"),
    ], VALIDATION)
    out = purchase_to_validation_delay(sales, v, DateWindow(D(2024, 2, 27), D(2024, 3, 3)))
    # customer 1: no row; customer 2: tie at 08:00 broken by the lower id;
    # March's pass finds no purchase, February's row appears once.
    assert rows(out, "bd_contact_linked", "bd_articlelonglabel", "bd_support_class",
                "max_transaction_date", "first_validation_date_after_transaction", "Delai") == [
        ("2", "B", "Y", D(2024, 2, 10), D(2024, 2, 12), 2)]


# -- J9 ------------------------------------------------------------------------

def test_j9_leap_days_null_product_and_last_year_only(spark):
    v = spark.createDataFrame([
        tap(1, T(2024, 2, 28, 8), 1), tap(2, T(2024, 2, 28, 9), 1),
        tap(3, T(2024, 2, 29, 8), 1),
        tap(4, T(2025, 2, 28, 8), 1),
        tap(5, T(2023, 2, 28, 8), 1),
        tap(6, T(2024, 2, 28, 8), 1, product="OLD"),            # only last year
        tap(7, T(2025, 2, 28, 8), 1, product=None), tap(8, T(2024, 2, 28, 8), 1, product=None),
    ], VALIDATION)
    out = validation_counts_yoy(v, DateWindow.single(D(2025, 2, 28)))
    assert rows(out, "Type_abonnement", "Nombre_de_validation",
                "Nombre_de_validation_annee_precedente") == sorted(
        [("P", 1, 2), (None, 1, 0)], key=str)
    leap = validation_counts_yoy(v, DateWindow(D(2024, 2, 28), D(2024, 2, 29)))
    assert rows(leap, "Date_de_validation", "Type_abonnement", "Nombre_de_validation",
                "Nombre_de_validation_annee_precedente") == sorted([
        (D(2024, 2, 28), "P", 2, 1), (D(2024, 2, 28), "OLD", 1, 0), (D(2024, 2, 28), None, 1, 0),
        (D(2024, 2, 29), "P", 1, 0)], key=str)


# -- J10 -----------------------------------------------------------------------

def test_j10_anonymous_only_day_and_day_without_taps(spark):
    v = spark.createDataFrame([
        tap(1, T(2024, 1, 1, 8), 1), tap(2, T(2024, 1, 1, 9), 1), tap(3, T(2024, 1, 1, 9), None),
        tap(4, T(2024, 1, 2, 9), None),
    ], VALIDATION)
    out = validation_rate_per_user(v, DateWindow(D(2024, 1, 1), D(2024, 1, 3)))
    assert rows(out, "ValidationDate", "AverageValidationsPerUser") == sorted(
        [(D(2024, 1, 1), 3.0), (D(2024, 1, 2), None)], key=str)


# -- J11 -----------------------------------------------------------------------

def test_j11_pass_through_labels_and_truncated_amounts(spark):
    day = T(2024, 1, 1)
    sales = spark.createDataFrame([
        sale(1, day, 1, equipment="XX", amount="10.99"),
        sale(2, day, 1, equipment=None, amount="-10.99"),
        sale(3, day, 1, equipment="DI", amount="1.50"), sale(3, day, 1, equipment="DI", amount="1.50"),
    ], SALES)
    out = sales_by_channel(sales, DateWindow.single(D(2024, 1, 1)))
    assert rows(out, "EquipementType", "SalesQuant", "Sales") == sorted(
        [("XX", 1, 10), (None, 1, -10), ("Valideur embarqué", 1, 3)], key=str)


def test_j5_lookback_band_against_brute_force(spark):
    """Taps on every day of the lookback band, accounts created before,
    inside and after it; counts compared with a direct count per date."""
    window = DateWindow(D(2024, 2, 26), D(2024, 3, 4))      # lookbacks clamp at 2023-02-28
    created = {1: D(2020, 1, 1), 2: D(2023, 3, 1), 3: D(2023, 2, 27), 4: D(2024, 3, 2)}
    taps, vid = [], 0
    for cust in created:
        day = D(2023, 2, 20)
        while day <= D(2024, 3, 10):
            if day.day % 3 == 0 or D(2023, 2, 25) <= day <= D(2023, 3, 6):
                vid += 1
                taps.append(tap(vid, T(day.year, day.month, day.day, 7), cust))
            day += dt.timedelta(days=1)
    v = spark.createDataFrame(taps, VALIDATION)
    contact = spark.createDataFrame([(c, None, d) for c, d in created.items()], CONTACT)
    out = avg_weekly_validations(v, contact, window, min_avg=-1e9)
    got = {(r.DateOfExecution, r.ClientID): r.ValidationCount for r in out.collect()}

    from billetic.operators.window import add_months

    want = {}
    for d in window.days():
        for cust, c in created.items():
            lb = max(c, add_months(d, -12))
            n = sum(1 for t in taps if t[2] == cust and t[1].date() >= lb)
            if n:
                want[(d, str(cust))] = float(n)
    assert got == want


def test_j6_a_null_transaction_is_no_client(spark):
    """COUNT(DISTINCT transaction) ignores NULL; the product keeps its row."""
    from billetic.plans.sales import total_clients

    day = dt.datetime(2024, 1, 5)
    sales = spark.createDataFrame(
        [(1, day, None, "P1"), (None, day, None, "P1"), (None, day, None, "P2")],
        "bd_sales_transaction_id long, bd_transaction_date timestamp_ntz, bd_contact_linked long, "
        "bd_productlonglabel string")
    got = total_clients(sales, DateWindow.single(dt.date(2024, 1, 6))).collect()
    assert sorted((r.type_abonnement, r.total_clients) for r in got) == [("P1", 1), ("P2", 0)]
