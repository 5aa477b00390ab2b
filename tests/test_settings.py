"""Every query gives the oracle's rows whatever the session time zone and
with ANSI mode off (a cluster may set either)."""

import pytest

from billetic.oracle import oracle_sql
from billetic.plans.registry import QUERIES
from billetic.testing import canonical, duckdb_views, run_duckdb, run_spark
from conftest import SF_SMALL

ORACLE = oracle_sql()
SETTINGS = {
    "los_angeles": {"spark.sql.session.timeZone": "America/Los_Angeles"},
    "tokyo_ansi_off": {"spark.sql.session.timeZone": "Asia/Tokyo", "spark.sql.ansi.enabled": "false"},
}


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("setting", sorted(SETTINGS))
def test_queries_do_not_depend_on_session_settings(spark, con, setting):
    conf = SETTINGS[setting]
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        bad = [n for n, fn in QUERIES.items()
               if canonical(*run_spark(fn(spark, SF_SMALL)))
               != canonical(*run_duckdb(con, ORACLE[n]))]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert bad == []
