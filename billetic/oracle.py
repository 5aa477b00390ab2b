"""DuckDB SQL for every registered query (the correctness gate).

Each statement says the rule of SURVEY section 2.12 in its own way, so that
it is a second opinion on the Spark plans: months are numbers (12 x year +
month) and periods differences of them, age bands and labels are small tables
of literals to join, weeks are differences of truncated dates, last year's
counts are the daily counts joined to themselves. Nothing of the engine is
imported: labels, bands, windows and dates are stated here again. The logical
sources are built from the driver's views with the mapping of FIXTURES.md
section 2.

A builder returns the statement and the common table expressions it reads:
logical sources, and ``spine``, the execution dates (column ``d``).
"""

from __future__ import annotations

import datetime as dt

# The execution dates of the registered runs.
SALES_AS_OF = dt.date(2001, 8, 1)
MONTH_START_AS_OF = dt.date(2001, 8, 2)
LEAP_LOOKUP_AS_OF = dt.date(2001, 3, 5)
LEAP_WINDOW_AS_OF = dt.date(2000, 3, 4)
EVENTS_AS_OF = dt.date(2024, 1, 31)
OLD_ACCOUNTS_AS_OF = dt.date(2025, 1, 20)
NO_TAPS_AS_OF = dt.date(2025, 3, 1)

# Labels by code, and age bands as (from, to, label).
SUPPORTS = """(VALUES (899240000, 'Billet Papier'), (899240001, 'Carte MOBIB'),
  (899240002, 'M-Ticketing TEC'), (899240003, 'M-Ticketing SNCB'),
  (899240004, 'Ticket sans contact')) support_name(code, label)"""
CHANNELS = """(VALUES ('MG', 'POS (guichet), Application dépositaire'), ('DI', 'Valideur embarqué'),
  ('VM', 'Valideur évènementiel'), ('TW', 'VAD partenaire de rechargement, site web, Mobile'),
  ('PC', 'Portable de contrôle')) channel_name(code, label)"""


def bands(name: str = "band", lowest: int = 0) -> str:
    return f"""(VALUES ({lowest}, 12, '0-12 ans'), (13, 18, '12-18 ans'), (19, 24, '18-24 ans'),
  (25, 40, '24-40 ans'), (41, 65, '40-65 ans')) {name}(low, high, label)"""


OPEN = -100000      # the first band's lower end where it takes all ages below 13

# -- logical sources over the driver's views ---------------------------------

SOURCES = {
    "sales": """sales AS (
  SELECT o.o_orderkey AS bd_sales_transaction_id,
         o.o_orderdate AS bd_transaction_date,
         CASE WHEN o.o_orderkey % 7 <> 0 THEN o.o_custkey END AS bd_contact_linked,
         p.p_type AS bd_productlonglabel,
         p.p_brand AS bd_articlelonglabel,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'MG' WHEN '2-HIGH' THEN 'DI'
              WHEN '3-MEDIUM' THEN 'VM' WHEN '4-NOT SPECIFIED' THEN 'TW'
              ELSE CASE WHEN o.o_orderstatus = 'F' THEN 'PC' ELSE 'ZZ' END END AS bd_equipment_type,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS bd_global_amount
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey)""",
    "sale_detail": """sale_detail AS (
  SELECT l.l_orderkey AS bd_sales_transaction_id,
         CASE WHEN l.l_linenumber <> 7 THEN l.l_suppkey END AS bd_support_serial_number_lookup,
         o.o_custkey AS bd_contact_linked,
         l.l_partkey AS bd_article_code_lookup,
         l.l_shipdate AS bd_contract_start_date,
         l.l_shipdate + to_days(CAST(l.l_quantity * 8 AS INTEGER)) AS bd_contract_end_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "support": """support AS (
  SELECT s_suppkey AS id, CAST(899240000 + s_suppkey % 6 AS INTEGER) AS bd_id_support_label
  FROM supplier)""",
    "contact": """contact AS (
  SELECT c_custkey AS Id,
         CASE WHEN c_custkey % 11 <> 0
              THEN DATE '1930-01-01' + CAST((c_custkey * 7919) % 33000 AS INTEGER) END AS birthdate,
         DATE '2023-06-01' + CAST((c_custkey * 13) % 240 AS INTEGER) AS createdon
  FROM customer)""",
    "card": """card AS (
  SELECT CAST(c_custkey AS VARCHAR) AS bd_mobibnumber FROM customer WHERE c_custkey % 13 <> 0)""",
    "article": """article AS (
  SELECT p_partkey AS bd_articleid, p_type AS bd_productlonglabel FROM part)""",
    "line": """line AS (
  SELECT n_nationkey AS NUM_LIGNE, n_name AS LIBEL_LIGNE FROM nation)""",
    "validation_a": """validation AS (
  SELECT event_id AS validation_id,
         ts AS DTHR_OPERATION,
         CASE WHEN event_id % 10 <> 0 THEN user_id END AS bd_linkedcustomer,
         CASE WHEN event_id % 10 = 0 THEN '0' ELSE CAST(user_id AS VARCHAR) END AS bd_mobibnumber,
         event_id % 25 AS NUM_LIGNE,
         event_type AS LIBEL_LONG_PRODUIRE,
         'S' || CAST(event_id % 3 AS VARCHAR) AS bd_support_class
  FROM events)""",
    "validation_b": """validation AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS validation_id,
         l.l_shipdate + to_hours(l.l_linenumber) AS DTHR_OPERATION,
         CASE WHEN l.l_suppkey % 10 <> 0 THEN o.o_custkey END AS bd_linkedcustomer,
         CASE WHEN l.l_suppkey % 10 = 0 THEN '0' ELSE CAST(o.o_custkey AS VARCHAR) END AS bd_mobibnumber,
         l.l_suppkey % 25 AS NUM_LIGNE,
         p.p_type AS LIBEL_LONG_PRODUIRE,
         l.l_returnflag AS bd_support_class
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey)""",
}


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def spine_cte(window, name: str = "spine") -> str:
    """Execution dates from the window's ``start`` to its ``end``."""
    return f"""{name} AS (
  SELECT CAST(g AS DATE) AS d
  FROM generate_series(DATE '{window.start}', DATE '{window.end}', INTERVAL 1 DAY) days(g))"""


class Days:
    """The trailing 8 dates before a run."""

    def __init__(self, as_of: dt.date):
        self.start, self.end = as_of - dt.timedelta(days=8), as_of - dt.timedelta(days=1)


def _spine(as_of: dt.date, name: str = "spine") -> str:
    return spine_cte(Days(as_of), name)


def _sources(*names: str) -> list[str]:
    return [SOURCES[n] for n in names]


def month_number(day: str) -> str:
    return f"(12 * year({day}) + month({day}))"


def weeks_between(a: str, b: str) -> str:
    """Sundays after day ``a`` up to day ``b``: DuckDB's weeks start on
    Monday, so both days are moved on by one first."""
    def sunday(x: str) -> str:
        return f"CAST(date_trunc('week', CAST({x} AS DATE) + 1) AS DATE)"

    return f"((CAST({sunday(b)} AS DATE) - CAST({sunday(a)} AS DATE)) // 7)"


# -- the jobs ------------------------------------------------------------------

def title_sales_by_support(as_of: dt.date = SALES_AS_OF, spine: str = "spine"):
    """Each sale line counts once per sales row of its transaction and day."""
    body = f"""SELECT day AS SalesDate, label AS support_type, CAST(n AS INTEGER) AS Sales,
       CAST(cards AS INTEGER) AS unique_cards, CAST(n // cards AS INTEGER) AS average_sales
FROM (
  SELECT bought.day, support_name.label, CAST(sum(bought.k) AS BIGINT) AS n,
         count(DISTINCT sold.card) AS cards
  FROM (SELECT bd_sales_transaction_id AS tx, CAST(bd_transaction_date AS DATE) AS day, count(*) AS k
        FROM sales SEMI JOIN {spine} ON CAST(bd_transaction_date AS DATE) = d
        GROUP BY ALL) bought
  JOIN (SELECT bd_sales_transaction_id AS tx, bd_support_serial_number_lookup AS card
        FROM sale_detail) sold ON sold.tx = bought.tx
  JOIN support ON support.id = sold.card
  LEFT JOIN {SUPPORTS} ON support_name.code = support.bd_id_support_label
  GROUP BY ALL) per_label"""
    return body, [*_sources("sale_detail", "support", "sales"), _spine(as_of)]


def active_clients(as_of: dt.date = SALES_AS_OF, kind: str = "b", until: str = "DATE '9999-12-31'"):
    """Days of registered cards' holders up to ``until``, by how many months they lie back."""
    back = f"{month_number('d')} - {month_number('day')}"
    body = f"""SELECT d AS DateOfExecution,
       count(DISTINCT CASE WHEN back <= 0 THEN who END) AS CurrentMonthActiveClients,
       count(DISTINCT CASE WHEN back = 1 THEN who END) AS LastMonthActiveClients,
       count(DISTINCT CASE WHEN back = 12 THEN who END) AS LastYearSameMonthActiveClients
FROM (
  SELECT d, who, {back} AS back
  FROM spine
  LEFT JOIN (SELECT DISTINCT bd_linkedcustomer AS who, CAST(DTHR_OPERATION AS DATE) AS day
             FROM validation SEMI JOIN card ON card.bd_mobibnumber = validation.bd_mobibnumber) seen
    ON day BETWEEN CAST(d - INTERVAL 12 MONTH AS DATE) AND {until}) marked
GROUP BY d"""
    return body, [*_sources(f"validation_{kind}", "card"), _spine(as_of)]


def active_contract_clients(as_of: dt.date = SALES_AS_OF):
    """A contract covers the month numbers from ``a`` (the next month if it
    starts after the 1st) to ``b`` (the month before the day after its end)."""
    def held(months_back: int) -> str:
        return f"count(DISTINCT CASE WHEN m - {months_back} BETWEEN a AND b THEN who END)"

    body = f"""SELECT d AS DateOfExecution, product AS type_abonnement,
       coalesce(band.label, '65+') AS Categorie_age,
       {held(0)} AS CurrentMonthActiveClients,
       {held(1)} AS LastMonthActiveClients,
       {held(12)} AS LastYearSameMonthActiveClients
FROM (
  SELECT d, {month_number('d')} AS m, who, a, b, bd_productlonglabel AS product,
         year(d) - year(birthdate) AS age
  FROM spine
  JOIN (SELECT bd_contact_linked AS who, bd_article_code_lookup AS code, first_day,
               {month_number('first_day')} + CASE WHEN day(first_day) > 1 THEN 1 ELSE 0 END AS a,
               {month_number('(last_day + 1)')} - 1 AS b
        FROM (SELECT *, CAST(bd_contract_start_date AS DATE) AS first_day,
                     CAST(bd_contract_end_date AS DATE) AS last_day FROM sale_detail) dated) held
    ON first_day >= CAST(d - INTERVAL 12 MONTH AS DATE)
  JOIN article ON article.bd_articleid = held.code
  JOIN contact ON contact.Id = held.who) held_by_age
LEFT JOIN {bands()} ON age BETWEEN band.low AND band.high
GROUP BY ALL"""
    return body, [*_sources("sale_detail", "contact", "article"), _spine(as_of)]


def clients_by_line(as_of: dt.date = EVENTS_AS_OF, kind: str = "a"):
    """Riders of a line and day: the known ones, and one row for card '0'."""
    body = f"""SELECT day AS DateOfExecution, coalesce(CAST(rider AS VARCHAR), 'N/A') AS ClientID,
       CAST(age AS INTEGER) AS Age, LIBEL_LIGNE,
       CASE WHEN known THEN coalesce(band.label, '65+') END AS AgeCategory,
       CASE WHEN known THEN 'Client Connu' ELSE 'Client Non Connu' END AS ClientType
FROM (
  SELECT DISTINCT day, known, LIBEL_LIGNE, Id AS rider, year(day) - year(birthdate) AS age
  FROM (
    SELECT CAST(DTHR_OPERATION AS DATE) AS day, NUM_LIGNE, TRUE AS known, bd_linkedcustomer AS who FROM validation
    UNION ALL
    SELECT CAST(DTHR_OPERATION AS DATE), NUM_LIGNE, FALSE, NULL FROM validation WHERE bd_mobibnumber = '0') ridden
  SEMI JOIN spine ON day = d
  JOIN line ON line.NUM_LIGNE = ridden.NUM_LIGNE
  LEFT JOIN contact ON contact.Id = who
  WHERE Id IS NOT NULL OR NOT known) riders
LEFT JOIN {bands(lowest=OPEN)} ON age BETWEEN band.low AND band.high"""
    return body, [*_sources(f"validation_{kind}", "contact", "line"), _spine(as_of)]


def _weekly(as_of: dt.date, keep: str):
    body = f"""SELECT CAST(who AS VARCHAR) AS ClientID, CAST(createdon AS DATE) AS AccountCreationDate,
       d AS DateOfExecution, CAST(n AS DOUBLE) AS ValidationCount, CAST(weeks AS INTEGER) AS Weeks,
       average AS AverageValidationsPerWeek
FROM (
  SELECT *, CASE WHEN old THEN 52 ELSE nullif({weeks_between('createdon', 'd')}, 0) END AS weeks,
         n / CAST(CASE WHEN old THEN 52 ELSE nullif({weeks_between('createdon', 'd - 1')}, 0) END AS DOUBLE)
           AS average
  FROM (
    SELECT d, Id AS who, createdon, createdon < CAST(d - INTERVAL 12 MONTH AS DATE) AS old,
           count(validation_id) AS n
    FROM contact
    JOIN validation ON bd_linkedcustomer = Id
    JOIN spine ON CAST(DTHR_OPERATION AS DATE) >= createdon
              AND CAST(DTHR_OPERATION AS DATE) >= CAST(d - INTERVAL 12 MONTH AS DATE)
    GROUP BY d, Id, createdon) counted) rated
WHERE {keep}"""
    return body, [*_sources("validation_a", "contact"), _spine(as_of)]


def avg_weekly_validations(as_of: dt.date = EVENTS_AS_OF, min_avg: float = 4):
    """Days both since the account began and in the last 12 months; an
    unknown average stays."""
    return _weekly(as_of, f"average >= {min_avg} OR average IS NULL")


def avg_weekly_validations_deleted(as_of: dt.date = EVENTS_AS_OF):
    return _weekly(as_of, "average < 4")


def total_clients(as_of: dt.date = SALES_AS_OF):
    """Distinct buyers: a contact, or else the transaction stands for one."""
    body = """SELECT d AS DateOfExecution, bd_productlonglabel AS type_abonnement,
       CAST(count(DISTINCT coalesce('contact ' || bd_contact_linked, 'sale ' || bd_sales_transaction_id))
            AS INTEGER) AS total_clients
FROM sales JOIN spine ON CAST(d - INTERVAL 12 MONTH AS DATE) <= CAST(bd_transaction_date AS DATE)
GROUP BY ALL"""
    return body, [*_sources("sales"), _spine(as_of)]


def purchase_to_validation_delay(as_of: dt.date = SALES_AS_OF):
    """For every month the dates lie in: latest purchase and first tap since
    its first day."""
    body = """SELECT DISTINCT CAST(buyer AS VARCHAR) AS bd_contact_linked, bd_articlelonglabel, bd_support_class,
       CAST(bought AS DATE) AS max_transaction_date,
       CAST(tapped AS DATE) AS first_validation_date_after_transaction,
       CAST(CAST(tapped AS DATE) - CAST(bought AS DATE) AS INTEGER) AS Delai
FROM (
  SELECT since, bd_contact_linked AS buyer, bd_articlelonglabel, max(bd_transaction_date) AS bought
  FROM sales JOIN (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS since FROM spine) m
    ON CAST(bd_transaction_date AS DATE) >= since
  GROUP BY ALL) purchase
JOIN (
  SELECT DISTINCT ON (since, bd_linkedcustomer) since AS tap_since, bd_linkedcustomer AS rider,
         DTHR_OPERATION AS tapped, bd_support_class
  FROM validation JOIN (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS since FROM spine) m
    ON CAST(DTHR_OPERATION AS DATE) >= since
  ORDER BY since, bd_linkedcustomer, DTHR_OPERATION, validation_id NULLS LAST, bd_support_class NULLS LAST) tap
  ON rider = buyer AND tap_since = since AND tapped >= bought"""
    return body, [*_sources("sales", "validation_b"), _spine(as_of)]


def purchase_to_first_validation_after(as_of: dt.date = SALES_AS_OF):
    """For every month the dates lie in: latest purchase since its first day,
    and the tap nearest after it."""
    body = """SELECT DISTINCT CAST(buyer AS VARCHAR) AS bd_contact_linked, bd_articlelonglabel, bd_support_class,
       CAST(bought AS DATE) AS max_transaction_date,
       CAST(tapped AS DATE) AS first_validation_date_after_transaction,
       CAST(CAST(tapped AS DATE) - CAST(bought AS DATE) AS INTEGER) AS Delai
FROM (
  SELECT since, bd_contact_linked AS buyer, bd_articlelonglabel, CAST(max(bd_transaction_date) AS TIMESTAMP) AS bought
  FROM sales JOIN (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS since FROM spine) m
    ON CAST(bd_transaction_date AS DATE) >= since
  WHERE bd_contact_linked IS NOT NULL
  GROUP BY ALL) purchase
ASOF JOIN (
  SELECT DISTINCT ON (bd_linkedcustomer, DTHR_OPERATION) bd_linkedcustomer AS rider,
         CAST(DTHR_OPERATION AS TIMESTAMP) AS tapped, bd_support_class
  FROM validation
  WHERE bd_linkedcustomer IS NOT NULL
  ORDER BY bd_linkedcustomer, DTHR_OPERATION, validation_id NULLS LAST, bd_support_class NULLS LAST) tap
  ON rider = buyer AND bought <= tapped"""
    return body, [*_sources("sales", "validation_b"), _spine(as_of)]


def validations_by_age(as_of: dt.date = EVENTS_AS_OF, start: dt.date = dt.date(2023, 1, 1), kind: str = "a"):
    """Age in the year of the day before the run."""
    body = f"""SELECT day AS Date_de_validation, product AS Type_abonnement, class AS Type_support,
       CAST(age AS INTEGER) AS Age, coalesce(band.label, '65+') AS Categorie_age,
       CAST(n AS INTEGER) AS Nombre_de_validation
FROM (
  SELECT CAST(DTHR_OPERATION AS DATE) AS day, LIBEL_LONG_PRODUIRE AS product, bd_support_class AS class,
         {(as_of - dt.timedelta(days=1)).year} - year(birthdate) AS age, count(DISTINCT validation_id) AS n
  FROM contact JOIN validation ON bd_linkedcustomer = Id
  WHERE DTHR_OPERATION >= DATE '{start}' AND DTHR_OPERATION < DATE '{as_of}'
  GROUP BY ALL) per_age
LEFT JOIN {bands()} ON age BETWEEN band.low AND band.high"""
    return body, _sources(f"validation_{kind}", "contact")


def validation_counts_yoy(as_of: dt.date = SALES_AS_OF, kind: str = "b"):
    """Daily counts joined to themselves: a date d looks at d - 12 months,
    and what it finds is due 12 months after that day."""
    daily = """SELECT CAST(DTHR_OPERATION AS DATE) AS day, LIBEL_LONG_PRODUIRE AS product,
              count(DISTINCT validation_id) AS n FROM validation GROUP BY ALL"""
    body = f"""SELECT now.day AS Date_de_validation, now.product AS Type_abonnement,
       CAST(now.n AS INTEGER) AS Nombre_de_validation,
       CAST(coalesce(past.n, 0) AS INTEGER) AS Nombre_de_validation_annee_precedente
FROM (SELECT * FROM ({daily}) a SEMI JOIN spine ON day = d) now
LEFT JOIN (SELECT CAST(day + INTERVAL 12 MONTH AS DATE) AS due, product, n FROM ({daily}) b
           SEMI JOIN spine ON day = CAST(d - INTERVAL 12 MONTH AS DATE)) past
  ON past.due = now.day AND past.product = now.product"""
    return body, [*_sources(f"validation_{kind}"), _spine(as_of)]


def distinct_customers_by_week():
    """Each customer once a week and product."""
    body = """SELECT week AS period_start, product, count(who) AS customers
FROM (SELECT DISTINCT CAST(date_trunc('week', DTHR_OPERATION) AS DATE) AS week, LIBEL_LONG_PRODUIRE AS product,
             bd_linkedcustomer AS who FROM validation)
GROUP BY ALL"""
    return body, _sources("validation_a")


def validation_rate_per_user(as_of: dt.date = EVENTS_AS_OF, spine: str = "spine"):
    body = f"""SELECT CAST(DTHR_OPERATION AS DATE) AS ValidationDate,
       CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT bd_linkedcustomer), 0) AS AverageValidationsPerUser
FROM validation SEMI JOIN {spine} ON CAST(DTHR_OPERATION AS DATE) = d
GROUP BY ALL"""
    return body, [*_sources("validation_a"), _spine(as_of, spine)]


def validation_rate_every_day(as_of: dt.date = EVENTS_AS_OF):
    body = f"""SELECT CAST(DTHR_OPERATION AS DATE) AS ValidationDate,
       CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT bd_linkedcustomer), 0) AS AverageValidationsPerUser
FROM validation WHERE CAST(DTHR_OPERATION AS DATE) < DATE '{as_of}' GROUP BY ALL"""
    return body, _sources("validation_a")


def sales_by_channel(as_of: dt.date = SALES_AS_OF):
    body = f"""SELECT CAST(bd_transaction_date AS DATE) AS DateOfExecution,
       coalesce(channel_name.label, bd_equipment_type) AS EquipementType, bd_productlonglabel AS ProductType,
       CAST(count(DISTINCT bd_sales_transaction_id) AS INTEGER) AS SalesQuant,
       CAST(trunc(sum(bd_global_amount)) AS INTEGER) AS Sales
FROM sales SEMI JOIN spine ON CAST(bd_transaction_date AS DATE) = d
LEFT JOIN {CHANNELS} ON channel_name.code = bd_equipment_type
GROUP BY ALL"""
    return body, [*_sources("sales"), _spine(as_of)]


# -- operators -----------------------------------------------------------------

def period_bounds():
    body = """SELECT d, first AS month_start, CAST(first + INTERVAL 1 MONTH AS DATE) - 1 AS month_end,
       CAST(first - INTERVAL 1 MONTH AS DATE) AS last_month_start, first - 1 AS last_month_end,
       CAST(first - INTERVAL 12 MONTH AS DATE) AS last_year_start,
       CAST(first - INTERVAL 11 MONTH AS DATE) - 1 AS last_year_end,
       CAST(d - INTERVAL 12 MONTH AS DATE) AS twelve_months_ago
FROM (SELECT DISTINCT CAST(DTHR_OPERATION AS DATE) AS d,
             CAST(DTHR_OPERATION AS DATE) - CAST(day(DTHR_OPERATION) - 1 AS INTEGER) AS first
      FROM validation) days"""
    return body, _sources("validation_b")


def age_bands(as_of: dt.date = SALES_AS_OF):
    body = f"""SELECT CAST(age AS INTEGER) AS Age, coalesce(closed.label, '65+') AS band_between,
       coalesce(open.label, '65+') AS band_open_low, count(*) AS n_contacts
FROM (SELECT {as_of.year} - year(birthdate) AS age FROM contact) aged
LEFT JOIN {bands('closed')} ON age BETWEEN closed.low AND closed.high
LEFT JOIN {bands('open', OPEN)} ON age BETWEEN open.low AND open.high
GROUP BY ALL"""
    return body, _sources("contact")


def account_weeks():
    body = f"""SELECT CAST({weeks_between('createdon', 'DTHR_OPERATION')} AS INTEGER) AS Weeks,
       count(*) AS n_validations
FROM contact JOIN validation ON bd_linkedcustomer = Id GROUP BY ALL"""
    return body, _sources("validation_a", "contact")


def equipment_labels():
    body = f"""SELECT bd_equipment_type, coalesce(channel_name.label, bd_equipment_type) AS EquipementType,
       count(*) AS n_rows
FROM sales LEFT JOIN {CHANNELS} ON channel_name.code = bd_equipment_type GROUP BY ALL"""
    return body, _sources("sales")


def first_validation_per_customer():
    body = """SELECT DISTINCT ON (bd_linkedcustomer)
       bd_linkedcustomer, DTHR_OPERATION, validation_id, bd_support_class, NUM_LIGNE
FROM validation WHERE bd_linkedcustomer IS NOT NULL
ORDER BY bd_linkedcustomer, DTHR_OPERATION, validation_id NULLS LAST, bd_support_class NULLS LAST"""
    return body, _sources("validation_a")


OLDER_SALES, OLDER_RATE = dt.date(2001, 7, 29), dt.date(2024, 1, 27)


def title_sales_upsert():
    """The newer run's rows, and the older run's whose key it has not."""
    older, _ = title_sales_by_support(spine="spine_old")
    newer, ctes = title_sales_by_support(spine="spine_new")
    ctes = [c for c in ctes if not c.startswith("spine")]
    ctes += [_spine(OLDER_SALES, "spine_old"), _spine(SALES_AS_OF, "spine_new"), f"older AS ({older})",
             f"newer AS ({newer})"]
    body = """SELECT older.* FROM older LEFT JOIN newer
  ON newer.SalesDate IS NOT DISTINCT FROM older.SalesDate
 AND newer.support_type IS NOT DISTINCT FROM older.support_type
WHERE newer.Sales IS NULL
UNION ALL FROM newer"""
    return body, ctes


def _rates_of_two_runs(gone: dt.date | None = None):
    """Both runs see the same taps, so the table is the rate of every date of
    either window, but for a date that has lost its taps."""
    lost = f" WHERE d <> DATE '{gone}'" if gone else ""
    either = (f"spine AS (SELECT DISTINCT d FROM (FROM spine_old UNION ALL FROM spine_new) x{lost})")
    body, _ = validation_rate_per_user()
    return body, [*_sources("validation_a"), _spine(OLDER_RATE, "spine_old"),
                  _spine(EVENTS_AS_OF, "spine_new"), either]


def validation_rate_replace_dates():
    return _rates_of_two_runs()


def stored_replace_dates():
    return _rates_of_two_runs(dt.date(2024, 1, 25))


def stored_append():
    body, ctes = sales_by_channel()
    return f"SELECT run.* FROM ({body}) run CROSS JOIN (VALUES (1), (2)) twice(n)", ctes


def duplicate_validation_ids():
    body = """SELECT validation_id, n AS n_rows
FROM (SELECT validation_id, count(*) AS n FROM validation GROUP BY ALL) x WHERE n > 1"""
    return body, _sources("validation_b")


def sales_lines_in_lookback(as_of: dt.date = SALES_AS_OF):
    body = """SELECT d, count(*) AS n_lines, count(DISTINCT bd_sales_transaction_id) AS n_transactions
FROM spine JOIN sales ON CAST(bd_transaction_date AS DATE) + INTERVAL 0 DAY >= d - INTERVAL 12 MONTH
GROUP BY ALL"""
    return body, [*_sources("sales"), _spine(as_of)]


def contracts_covering_month(as_of: dt.date = MONTH_START_AS_OF):
    first = "CAST(date_trunc('month', d) AS DATE)"
    body = f"""SELECT d, count(*) AS n_contracts
FROM spine JOIN sale_detail ON CAST(bd_contract_start_date AS DATE) <= {first}
  AND CAST(bd_contract_end_date AS DATE) + 1 >= CAST({first} + INTERVAL 1 MONTH AS DATE)
GROUP BY ALL"""
    return body, [*_sources("sale_detail"), _spine(as_of)]


def validations_since_account_start(as_of: dt.date = EVENTS_AS_OF):
    body = """SELECT d, bd_linkedcustomer, count(validation_id) AS n_validations
FROM contact JOIN validation ON bd_linkedcustomer = Id
JOIN spine ON CAST(DTHR_OPERATION AS DATE) >= createdon
          AND CAST(DTHR_OPERATION AS DATE) >= CAST(d - INTERVAL 12 MONTH AS DATE)
GROUP BY ALL"""
    return body, [*_sources("validation_a", "contact"), _spine(as_of)]


BUILDERS = {
    "title_sales_by_support": title_sales_by_support,
    "active_clients": active_clients,
    "active_contract_clients": active_contract_clients,
    "clients_by_line": clients_by_line,
    "avg_weekly_validations": avg_weekly_validations,
    "total_clients": total_clients,
    "purchase_to_validation_delay": purchase_to_validation_delay,
    "validations_by_age": validations_by_age,
    "validation_counts_yoy": validation_counts_yoy,
    "validation_rate_per_user": validation_rate_per_user,
    "sales_by_channel": sales_by_channel,
    "active_clients_dense": lambda: active_clients(EVENTS_AS_OF, "a"),
    "active_contract_clients_month_start": lambda: active_contract_clients(MONTH_START_AS_OF),
    "purchase_to_validation_delay_two_months": lambda: purchase_to_validation_delay(MONTH_START_AS_OF),
    "validation_counts_yoy_leap_lookup": lambda: validation_counts_yoy(LEAP_LOOKUP_AS_OF),
    "validation_counts_yoy_leap_window": lambda: validation_counts_yoy(LEAP_WINDOW_AS_OF),
    "clients_by_line_future_births": lambda: clients_by_line(SALES_AS_OF, "b"),
    "active_clients_capped": lambda: active_clients(until="d"),
    "active_clients_capped_dense": lambda: active_clients(EVENTS_AS_OF, "a", "d"),
    "purchase_to_first_validation_after": purchase_to_first_validation_after,
    "purchase_to_first_validation_after_two_months": lambda: purchase_to_first_validation_after(MONTH_START_AS_OF),
    "validations_by_age_kept": validations_by_age,
    "title_sales_colocated": title_sales_by_support,
    "total_clients_kept": total_clients,
    "active_clients_kept": active_clients,
    "active_clients_kept_dense": lambda: active_clients(EVENTS_AS_OF, "a"),
    "validation_rate_late": validation_rate_every_day,
    "validation_counts_yoy_by_words": validation_counts_yoy,
    "validation_counts_yoy_by_words_dense": lambda: validation_counts_yoy(EVENTS_AS_OF, "a"),
    "validation_counts_yoy_kept": validation_counts_yoy,
    "distinct_customers_by_week": distinct_customers_by_week,
    "validations_by_age_future_births":
        lambda: validations_by_age(SALES_AS_OF, dt.date(2001, 1, 1), "b"),
    "avg_weekly_validations_old_accounts": lambda: avg_weekly_validations(OLD_ACCOUNTS_AS_OF, 0),
    "active_clients_no_activity": lambda: active_clients(NO_TAPS_AS_OF, "a"),
    "period_bounds": period_bounds,
    "age_bands": age_bands,
    "account_weeks": account_weeks,
    "equipment_labels": equipment_labels,
    "active_clients_by_spine_join": active_clients,
    "first_validation_per_customer": first_validation_per_customer,
    "title_sales_upsert": title_sales_upsert,
    "validation_rate_replace_dates": validation_rate_replace_dates,
    "validation_counts_update": validation_counts_yoy,
    "duplicate_validation_ids": duplicate_validation_ids,
    "sales_lines_in_lookback": sales_lines_in_lookback,
    "contracts_covering_month": contracts_covering_month,
    "validations_since_account_start": validations_since_account_start,
    "validations_since_account_start_old": lambda: validations_since_account_start(OLD_ACCOUNTS_AS_OF),
    "avg_weekly_validations_deleted": avg_weekly_validations_deleted,
    "stored_append": stored_append,
    "stored_overwrite": validation_rate_per_user,
    "stored_replace_dates": stored_replace_dates,
    "stored_upsert": title_sales_upsert,
    "stored_update": validation_counts_yoy,
    "stored_delete": avg_weekly_validations,
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, build in BUILDERS.items():
        body, ctes = build()
        out[name] = with_ctes(ctes, body)
    return out
