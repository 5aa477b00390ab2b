"""The window-sensitive jobs against the DuckDB oracle at many execution
dates: month ends, year ends, leap days, a window over two months or two
years. The oracle is written the reference's way, so this checks the
histogram / band / membership rewrites on every calendar corner case."""

import datetime as dt

import pytest

from billetic import oracle as O
from billetic.plans import registry as R
from billetic.testing import canonical, duckdb_views, run_duckdb, run_spark
from conftest import SF_SMALL

D = dt.date

# Sales and the long validation fixture span 1995 .. 2001.
DATES = [D(1996, 3, 1), D(1996, 3, 2), D(1997, 1, 1), D(1997, 1, 5), D(1999, 12, 31),
         D(2000, 2, 29), D(2000, 3, 1), D(2000, 3, 8), D(2001, 3, 1), D(2001, 5, 31)]

JOBS = {
    "active_clients": (lambda sp, d: R.q_active_clients(sp, SF_SMALL, d, "b"),
                       lambda d: O.active_clients(d, "b")),
    "active_contract_clients": (lambda sp, d: R.q_active_contract_clients(sp, SF_SMALL, d),
                                O.active_contract_clients),
    "total_clients": (lambda sp, d: R.q_total_clients(sp, SF_SMALL, d), O.total_clients),
    "title_sales_by_support": (lambda sp, d: R.q_title_sales_by_support(sp, SF_SMALL, d),
                               O.title_sales_by_support),
    "purchase_to_validation_delay": (
        lambda sp, d: R.q_purchase_to_validation_delay(sp, SF_SMALL, d),
        O.purchase_to_validation_delay),
    "validation_counts_yoy": (lambda sp, d: R.q_validation_counts_yoy(sp, SF_SMALL, d),
                              O.validation_counts_yoy),
}


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("as_of", DATES, ids=str)
@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_matches_oracle_at_calendar_corners(spark, con, name, as_of):
    spark_fn, sql_fn = JOBS[name]
    body, ctes = sql_fn(as_of)
    s_cols, s_rows = canonical(*run_spark(spark_fn(spark, as_of)))
    d_cols, d_rows = canonical(*run_duckdb(con, O.with_ctes(ctes, body)))
    assert s_cols == d_cols
    assert s_rows == d_rows


EVENT_DATES = [D(2024, 1, 2), D(2024, 1, 9), D(2024, 1, 20), D(2024, 2, 1), D(2024, 2, 5)]


@pytest.mark.parametrize("as_of", EVENT_DATES, ids=str)
@pytest.mark.parametrize("name", ["avg_weekly_validations", "clients_by_line",
                                  "validation_rate_per_user", "validations_by_age"])
def test_event_jobs_match_oracle(spark, con, name, as_of):
    body, ctes = getattr(O, name)(as_of)
    s_cols, s_rows = canonical(*run_spark(getattr(R, f"q_{name}")(spark, SF_SMALL, as_of)))
    d_cols, d_rows = canonical(*run_duckdb(con, O.with_ctes(ctes, body)))
    assert s_cols == d_cols
    assert s_rows == d_rows


def test_contract_holders_over_a_fourteen_month_window(spark, con):
    """J3 over 14 months of execution dates: one pass."""
    from billetic.operators import DateWindow
    from billetic.plans.clients import active_contract_clients
    from billetic.sources.fixtures import FixtureSources

    window = DateWindow(D(2000, 6, 1), D(2001, 7, 31))
    src = FixtureSources(spark, SF_SMALL)
    got = active_contract_clients(src.sale_detail(), src.contact(), src.article(), window)
    body, ctes = O.active_contract_clients()
    ctes = [c for c in ctes if not c.startswith("spine")] + [O.spine_cte(window)]
    s_cols, s_rows = canonical(*run_spark(got))
    d_cols, d_rows = canonical(*run_duckdb(con, O.with_ctes(ctes, body)))
    assert s_cols == d_cols and len(s_rows) > 400
    assert s_rows == d_rows


LONG_WINDOW_JOBS = {
    "active_clients": lambda: O.active_clients(R.SALES_AS_OF, "b"),
    "total_clients": O.total_clients,
    "title_sales_by_support": O.title_sales_by_support,
    "validation_counts_yoy": O.validation_counts_yoy,
    "sales_by_channel": O.sales_by_channel,
    "purchase_to_validation_delay": O.purchase_to_validation_delay,
}


@pytest.mark.parametrize("name", sorted(LONG_WINDOW_JOBS))
def test_jobs_over_a_fourteen_month_window(spark, con, name):
    from billetic.operators import DateWindow

    window = DateWindow(D(2000, 6, 1), D(2001, 7, 31))
    got = getattr(R, f"q_{name}")(spark, SF_SMALL, window=window)
    body, ctes = LONG_WINDOW_JOBS[name]()
    ctes = [c for c in ctes if not c.startswith("spine")] + [O.spine_cte(window)]
    s_cols, s_rows = canonical(*run_spark(got))
    d_cols, d_rows = canonical(*run_duckdb(con, O.with_ctes(ctes, body)))
    assert s_cols == d_cols and len(s_rows) > 0
    assert s_rows == d_rows
