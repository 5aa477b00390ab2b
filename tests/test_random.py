"""Random logical tables (NULLs in keys, times and ids, duplicates, ties,
shared labels, missing dimension rows, a hot customer, dates around month
and year ends) -> every job on Spark against the reference-style oracle SQL
run by DuckDB on the same rows."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

from billetic import oracle as O
from billetic.operators import DateWindow
from billetic.plans import clients, sales, validations
from billetic.testing import canonical, run_duckdb, run_spark

D, T = dt.date, dt.datetime

SCHEMAS = {
    "validation": [("validation_id", "long"), ("DTHR_OPERATION", "timestamp_ntz"),
                   ("bd_linkedcustomer", "long"), ("bd_mobibnumber", "string"),
                   ("NUM_LIGNE", "long"), ("LIBEL_LONG_PRODUIRE", "string"),
                   ("bd_support_class", "string")],
    "sales": [("bd_sales_transaction_id", "long"), ("bd_transaction_date", "timestamp_ntz"),
              ("bd_contact_linked", "long"), ("bd_productlonglabel", "string"),
              ("bd_articlelonglabel", "string"), ("bd_equipment_type", "string"),
              ("bd_global_amount", "decimal(18,2)")],
    "sale_detail": [("bd_sales_transaction_id", "long"), ("bd_support_serial_number_lookup", "long"),
                    ("bd_contact_linked", "long"), ("bd_article_code_lookup", "long"),
                    ("bd_contract_start_date", "timestamp_ntz"),
                    ("bd_contract_end_date", "timestamp_ntz")],
    "support": [("id", "long"), ("bd_id_support_label", "int")],
    "contact": [("Id", "long"), ("birthdate", "date"), ("createdon", "date")],
    "article": [("bd_articleid", "long"), ("bd_productlonglabel", "string")],
    "line": [("NUM_LIGNE", "long"), ("LIBEL_LIGNE", "string")],
    "card": [("bd_mobibnumber", "string")],
}
ARROW = {"long": pa.int64(), "string": pa.string(), "timestamp_ntz": pa.timestamp("us"),
         "date": pa.date32(), "int": pa.int32(), "decimal(18,2)": pa.decimal128(18, 2)}


def maybe(rng, value, p_null=0.15):
    return None if rng.random() < p_null else value


def moment(rng, lo: D, hi: D) -> T:
    """A time in [lo, hi]; on the hour, so that ties are frequent."""
    day = lo + dt.timedelta(days=rng.randrange((hi - lo).days + 1))
    return T(day.year, day.month, day.day, rng.randrange(24))


def tables(seed: int, as_of: D) -> dict:
    rng = random.Random(seed)
    lo, hi = as_of - dt.timedelta(days=430), as_of + dt.timedelta(days=20)
    customers = list(range(1, 13))
    hot = seed % 2 == 1                     # odd worlds: customer 1 has a third of the taps
    out = {}
    out["validation"] = []
    for _ in range(400):
        c = 1 if hot and rng.random() < 0.33 else maybe(rng, rng.choice(customers), 0.2)
        card = "0" if c is None or rng.random() < 0.05 else str(c)
        out["validation"].append((
            maybe(rng, rng.randrange(1, 330), 0.03), maybe(rng, moment(rng, lo, hi), 0.02), c, card,
            rng.randrange(6), maybe(rng, rng.choice(["A", "B"]), 0.1),
            maybe(rng, rng.choice(["S0", "S1"]), 0.1)))
    out["sales"] = []
    for tx in range(1, 300):                # several transactions a day
        when = maybe(rng, moment(rng, lo, hi), 0.03)
        contact = maybe(rng, rng.choice(customers), 0.25)
        for _ in range(rng.randrange(1, 4)):
            out["sales"].append((
                maybe(rng, tx, 0.04), when, contact, maybe(rng, rng.choice(["P1", "P2"]), 0.1),
                rng.choice(["A1", "A2", "A3"]),
                maybe(rng, rng.choice(["MG", "DI", "VM", "TW", "PC", "XX"]), 0.1),
                Decimal(rng.randrange(-500, 5000)) / 100))
    # a burst inside the window: several sales a day with the same labels, so
    # that rows of one day at different times must be grouped together
    for tx in range(400, 460):
        when = moment(rng, as_of - dt.timedelta(days=8), as_of - dt.timedelta(days=1))
        for _ in range(rng.randrange(1, 3)):
            out["sales"].append((tx, when, maybe(rng, rng.choice(customers), 0.25), "P1", "A1",
                                 rng.choice(["MG", "DI"]), Decimal(rng.randrange(100, 900)) / 100))
    out["sale_detail"] = []
    for _ in range(220):
        start = moment(rng, lo, hi)
        end = maybe(rng, start + dt.timedelta(days=rng.randrange(0, 400)), 0.1)
        start = maybe(rng, start, 0.03)
        out["sale_detail"].append((
            rng.choice([rng.randrange(1, 305), rng.randrange(400, 460)]),
            maybe(rng, rng.randrange(1, 11), 0.15),
            maybe(rng, rng.choice(customers), 0.1), rng.randrange(1, 6), start, end))
    out["support"] = [(i, 899240000 + rng.randrange(7)) for i in range(1, 11)] + [(4, 899240001)]
    out["contact"] = []
    for c in customers + [3, 7]:                     # two ids appear twice
        birth = maybe(rng, D(1930, 1, 1) + dt.timedelta(days=rng.randrange(36500)), 0.15)
        created = as_of - dt.timedelta(days=rng.randrange(-10, 500))
        if seed % 4 >= 2:                            # a timestamp with a time of day
            created = T(created.year, created.month, created.day, rng.randrange(24))
        out["contact"].append((c, birth, maybe(rng, created, 0.1)))
    out["article"] = [(1, "Abo1"), (2, "Abo2"), (3, None), (4, "Abo1"), (2, "Abo2")]  # no 5
    out["line"] = [(0, "L0"), (1, "L1"), (2, "L1"), (3, "L3"), (4, None)]  # 5 is missing
    out["card"] = [(str(c),) for c in customers if rng.random() < 0.8] + [("0",)]
    return out


def schemas(seed: int) -> dict:
    if seed % 4 < 2:
        return SCHEMAS
    out = dict(SCHEMAS)
    out["contact"] = [("Id", "long"), ("birthdate", "date"), ("createdon", "timestamp_ntz")]
    return out


def spark_frames(spark, data, seed):
    sch = schemas(seed)
    return {n: spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in sch[n]))
            for n, rows in data.items()}


def duck(data, seed):
    con = duckdb.connect()
    sch = schemas(seed)
    for name, rows in data.items():
        schema = pa.schema([(c, ARROW[t]) for c, t in sch[name]])
        cols = list(zip(*rows)) if rows else [[] for _ in schema]
        table = pa.table([pa.array(list(col), type=f.type) for col, f in zip(cols, schema)],
                         schema=schema)
        con.register(f"{name}_arrow", table)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_arrow")
    return con


LOGICAL = tuple(f"{n} AS" for n in SCHEMAS)


class Src:
    def __init__(self, frames):
        self.f = frames

    def __getattr__(self, name):
        return lambda *a: self.f[name]


JOBS = {
    "title_sales_by_support": (lambda s, w, a: sales.title_sales_by_support(
        s.sale_detail(), s.support(), s.sales(), w), lambda a: O.title_sales_by_support(a)),
    "active_clients": (lambda s, w, a: clients.active_clients(s.validation(), s.card(), w),
                       lambda a: O.active_clients(a, "a")),
    "active_contract_clients": (lambda s, w, a: clients.active_contract_clients(
        s.sale_detail(), s.contact(), s.article(), w), O.active_contract_clients),
    "clients_by_line": (lambda s, w, a: clients.clients_by_line(
        s.validation(), s.contact(), s.line(), w), O.clients_by_line),
    "avg_weekly_validations": (lambda s, w, a: clients.avg_weekly_validations(
        s.validation(), s.contact(), w), O.avg_weekly_validations),
    "total_clients": (lambda s, w, a: sales.total_clients(s.sales(), w), O.total_clients),
    "purchase_to_validation_delay": (lambda s, w, a: validations.purchase_to_validation_delay(
        s.sales(), s.validation(), w), O.purchase_to_validation_delay),
    "validations_by_age": (lambda s, w, a: validations.validations_by_age(
        s.validation(), s.contact(), a, start=a - dt.timedelta(days=400)), None),
    "validation_counts_yoy": (lambda s, w, a: validations.validation_counts_yoy(s.validation(), w),
                              O.validation_counts_yoy),
    "validation_rate_per_user": (lambda s, w, a: validations.validation_rate_per_user(
        s.validation(), w), O.validation_rate_per_user),
    "sales_by_channel": (lambda s, w, a: sales.sales_by_channel(s.sales(), w), O.sales_by_channel),
}

# execution dates: month starts and ends, year ends, leap days, ordinary days
AS_OF = {0: D(2024, 3, 2), 1: D(2024, 1, 1), 2: D(2024, 3, 1), 3: D(2023, 11, 17),
         4: D(2025, 3, 1), 5: D(2024, 8, 15), 6: D(2023, 12, 31), 7: D(2024, 1, 31),
         8: D(2024, 3, 31), 9: D(2024, 2, 29), 10: D(2025, 1, 3), 11: D(2024, 6, 1)}


@pytest.fixture(scope="module")
def worlds(spark):
    out = {}
    for seed, as_of in AS_OF.items():
        data = tables(seed, as_of)
        out[seed] = (Src(spark_frames(spark, data, seed)), duck(data, seed), as_of)
    return out


@pytest.mark.parametrize("seed", sorted(AS_OF))
@pytest.mark.parametrize("name", sorted(JOBS))
def test_random_tables_match_oracle(worlds, name, seed):
    src, con, as_of = worlds[seed]
    job, sql = JOBS[name]
    # every third world: a 40-day window over two or three months
    window = DateWindow.trailing(as_of, start_back=40 if seed % 3 == 2 else 8)
    got = canonical(*run_spark(job(src, window, as_of)))
    if sql is None:        # J8: the history starts 400 days back in these worlds
        body, _ = O.validations_by_age(as_of, start=as_of - dt.timedelta(days=400))
        ctes = []
    else:
        body, ctes = sql(as_of)
        ctes = [O.spine_cte(window) if c.startswith("spine AS") else c
                for c in ctes if not c.startswith(LOGICAL)]
    sql_text = O.with_ctes(ctes, body) if ctes else body
    want = canonical(*run_duckdb(con, sql_text))
    assert got == want
