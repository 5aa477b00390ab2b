"""The production path: logical sources stored as Parquet tables and read by
``CatalogSources`` give the same job results as the fixture derivations."""

import pytest

from billetic.plans import registry as R
from billetic.sources.catalog import SOURCE_COLUMNS, CatalogSources
from billetic.sources.fixtures import FixtureSources
from billetic.streaming import JOBS
from conftest import SF_SMALL

AS_OF = {
    "title_sales_by_support": R.SALES_AS_OF,
    "active_clients": R.SALES_AS_OF,
    "active_contract_clients": R.MONTH_START_AS_OF,
    "clients_by_line": R.EVENTS_AS_OF,
    "avg_weekly_validations": R.EVENTS_AS_OF,
    "total_clients": R.SALES_AS_OF,
    "purchase_to_validation_delay": R.MONTH_START_AS_OF,
    "validations_by_age": R.EVENTS_AS_OF,
    "validation_counts_yoy": R.SALES_AS_OF,
    "validation_rate_per_user": R.EVENTS_AS_OF,
    "sales_by_channel": R.SALES_AS_OF,
}
KIND = {"active_clients": "b", "purchase_to_validation_delay": "b", "validation_counts_yoy": "b"}


@pytest.fixture(scope="module")
def catalogs(spark, tmp_path_factory):
    """One stored catalog per validation fixture."""
    out = {}
    for kind in ("a", "b"):
        root = str(tmp_path_factory.mktemp(f"catalog_{kind}"))
        fx = FixtureSources(spark, SF_SMALL, kind)
        for name in SOURCE_COLUMNS:
            getattr(fx, name)().write.parquet(f"{root}/{name}")
        out[kind] = (fx, CatalogSources(spark, root))
    return out


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_catalog_tables_give_the_fixture_results(catalogs, name):
    from billetic.operators import DateWindow

    fx, cat = catalogs[KIND.get(name, "a")]
    window = DateWindow.trailing(AS_OF[name])
    want = table(JOBS[name].compute(fx, window, AS_OF[name]))
    got = table(JOBS[name].compute(cat, window, AS_OF[name]))
    assert got == want and len(want) > 0


def test_command_line_refresh_writes_every_report(spark, catalogs, tmp_path):
    from billetic.sources.sinks import read_target
    from billetic.streaming.__main__ import main

    root = catalogs["b"][1].root
    reports = str(tmp_path / "reports")
    main(["--sources", root, "--reports", reports, "--as-of", "2001-08-01",
          "--job", "sales_by_channel", "--job", "active_clients"])
    for name in ("sales_by_channel", "active_clients"):
        target = JOBS[name].target
        assert read_target(spark, f"{reports}/{target.name}", target).count() > 0


def test_catalog_tables_under_other_names(spark, catalogs):
    """Stored names that differ from the logical ones, through ``names``."""
    from billetic.operators import DateWindow
    from billetic.plans.validations import validation_rate_per_user

    fx, cat = catalogs["a"]
    spark.read.parquet(f"{cat.root}/validation").createOrReplaceTempView("Prod_Validation")
    named = CatalogSources(spark, None, {"validation": "Prod_Validation"})
    window = DateWindow.trailing(R.EVENTS_AS_OF)
    assert table(validation_rate_per_user(named.validation(), window)) == table(
        validation_rate_per_user(fx.validation(), window))
