"""Plan checks: literal bounds reach the Parquet scan,
only the needed columns are read, no row-multiplying Expand for the
distinct counts, a partial WindowGroupLimit before the shuffle for the first
row per group, and no Python anywhere in the plans."""

import contextlib
import datetime as dt
import io
import re

import pytest

from billetic.operators import DateWindow
from billetic.plans.clients import active_clients, active_contract_clients
from billetic.plans.registry import QUERIES, SALES_AS_OF
from billetic.plans.sales import title_sales_by_support, total_clients
from billetic.sources.colocated import read_colocated, store_colocated
from billetic.sources.fixtures import FixtureSources
from conftest import SF_SMALL


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def scan_details(text: str, table: str) -> list[str]:
    """The detail blocks of the Parquet scans of ``table``."""
    blocks = re.split(r"\n\(\d+\) ", text)
    return [b for b in blocks if b.startswith("Scan parquet") and f"/{table}.parquet" in b]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL), "extended")
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas", "CartesianProduct", "Join Cross"):
        assert marker not in text


def test_day_window_is_pushed_and_columns_pruned(spark):
    text = plan(QUERIES["validation_rate_per_user"](spark, SF_SMALL))
    (scan,) = scan_details(text, "events")
    pushed = re.search(r"PushedFilters: \[(.*)\]", scan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-23" in pushed and "LessThan(ts,2024-01-31" in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["event_id", "ts", "user_id"]


def test_lookback_literal_bound_reaches_orders_scan(spark):
    text = plan(QUERIES["total_clients"](spark, SF_SMALL))
    scans = scan_details(text, "orders")
    assert scans and all("GreaterThanOrEqual(o_orderdate,2000-07-24" in s for s in scans)


@pytest.mark.parametrize("name", ["active_clients", "active_contract_clients", "total_clients"])
def test_no_expand_for_distinct_counts(spark, name):
    assert "Expand" not in plan(QUERIES[name](spark, SF_SMALL))


def test_first_row_per_group_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["purchase_to_validation_delay"](spark, SF_SMALL))
    tree = text.split("\n\n")[0]
    assert "WindowGroupLimit" in tree
    # the partial limit sits below the exchange that feeds the window
    lines = tree.splitlines()
    exch = [i for i, l in enumerate(lines) if "Exchange" in l]
    wgl = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
    assert any(w > e for w in wgl for e in exch)


def test_spine_is_the_broadcast_side(spark):
    text = plan(QUERIES["contracts_covering_month"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin Inner BuildRight" in text


@contextlib.contextmanager
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


def test_sale_lines_are_pruned_by_a_runtime_bloom_filter(spark, tmp_path):
    """J1 over stored tables: the window's transactions prune the sale-line
    history at its scan though the sales table, and with it any estimate of
    the window's part, is far over the creation threshold; only the staged
    keys' true size counts. The sizes are those of a large table: no
    broadcast, a scan over the application threshold."""
    src = FixtureSources(spark, "/root/testdata/sf0.01")
    tables = {}
    for name in ("sales", "sale_detail", "support"):
        getattr(src, name)().write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    window = DateWindow.trailing(SALES_AS_OF)
    with settings(spark, {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "50k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }):
        text = plan(title_sales_by_support(tables["sale_detail"], tables["support"], tables["sales"], window))
    assert "bloom_filter_agg" in text and "might_contain" in text
    # the sales are not read again: the plan starts from the staged keys
    assert not scan_details(text, "sales") and f"{tmp_path}/sales" not in text


def test_co_located_sale_lines_are_not_shuffled(spark, tmp_path):
    """J1 with the window's keys above both thresholds: no exchange between
    the scan of the lines stored by transaction and their join, and the keys'
    range is pushed to that scan."""
    src = FixtureSources(spark, SF_SMALL)
    table = "co_located_lines_test"
    with settings(spark, {
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1b",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }):
        store_colocated(src.sale_detail(), table, "bd_sales_transaction_id", 8, f"{tmp_path}/lines")
        args = (src.support(), src.sales(), DateWindow.trailing(SALES_AS_OF))
        df = title_sales_by_support(read_colocated(spark, table), *args)
        lines, details = plan(df, "simple").splitlines(), plan(df)
        details = next(b for b in re.split(r"\n\(\d+\) ", details) if b.startswith("Scan") and table in b)
        plain = title_sales_by_support(src.sale_detail(), *args)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    scan = next(i for i, line in enumerate(lines) if "co_located_lines_test" in line)
    assert all(f"{op}(bd_sales_transaction_id" in details for op in ("GreaterThanOrEqual", "LessThanOrEqual"))
    above = []
    for line in reversed(lines[:scan]):
        above.append(line)
        if "Join" in line:
            break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    spark.sql(f"DROP TABLE {table}")


def test_a_long_window_is_no_cartesian_product(spark):
    window = DateWindow(dt.date(1990, 1, 1), dt.date(1990, 1, 1) + dt.timedelta(days=4999))
    src = FixtureSources(spark, SF_SMALL, "b")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for df in (total_clients(src.sales(), window), active_clients(src.validation(), src.card(), window)):
            text = plan(df, "extended")
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" in text


def test_contracts_are_read_once_for_fourteen_months(spark):
    window = DateWindow(dt.date(2000, 6, 1), dt.date(2001, 7, 31))
    src = FixtureSources(spark, SF_SMALL)
    text = plan(active_contract_clients(src.sale_detail(), src.contact(), src.article(), window))
    assert len(scan_details(text, "lineitem")) == 1


def test_the_contract_plan_has_one_size_for_any_window(spark):
    src = FixtureSources(spark, SF_SMALL)
    sizes = set()
    for days in (8, 425, 1826):         # 8 dates, 14 months, 5 years
        window = DateWindow(dt.date(2001, 7, 31) - dt.timedelta(days=days - 1), dt.date(2001, 7, 31))
        text = plan(active_contract_clients(src.sale_detail(), src.contact(), src.article(), window), "simple")
        lines = text.splitlines()
        sizes.add((len(lines), sum("Exchange" in x for x in lines)))
        contracts = [x for x in lines if "Generate" in x and "bd_contact_linked" in x]
        assert len(contracts) == 2 and all(len(x) < 500 for x in contracts)
    assert len(sizes) == 1


def test_facts_are_reduced_before_they_are_copied_to_passes(spark):
    """Every explode to month passes stands above an aggregate or a
    window limit, never on the facts."""
    text = plan(QUERIES["purchase_to_validation_delay_two_months"](spark, SF_SMALL), "simple")
    lines = text.splitlines()
    depth = [len(re.match(r"[\s:+|-]*", line)[0]) for line in lines]
    for i, line in enumerate(lines):
        if "Generate" in line:
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            assert any(x in "".join(below) for x in ("Aggregate", "WindowGroupLimit"))


def test_session_leaves_the_cluster_settings_alone(spark):
    from billetic.session import build_session

    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert build_session().conf.get("spark.sql.shuffle.partitions") == "2000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
