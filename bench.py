"""Benchmark: the 11 KPI jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each job's full plan is executed into Spark's ``noop`` sink (nothing is
collected to the driver). One warm-up pass, then the median of
$BENCH_REPEATS runs per job (default 5). Prints one JSON line.

"refresh" times two jobs with their writers (compute, check, merge, write).

Set BENCH_LOOP=1 to also time the reference's shape: the same job run once
per execution date (8 single-date jobs), reported under "loop8".
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from billetic.plans import registry as R  # noqa: E402
from billetic.session import build_session, ensure_checkpoint_dir  # noqa: E402
from billetic.sources.fixtures import FixtureSources  # noqa: E402
from billetic.streaming import refresh  # noqa: E402

JOBS = [
    "title_sales_by_support",
    "active_clients",
    "active_contract_clients",
    "clients_by_line",
    "avg_weekly_validations",
    "total_clients",
    "purchase_to_validation_delay",
    "validations_by_age",
    "validation_counts_yoy",
    "validation_rate_per_user",
    "sales_by_channel",
]

# job -> (as_of default) for the per-date loop comparison
LOOPABLE = {
    "title_sales_by_support": R.SALES_AS_OF,
    "active_clients": R.SALES_AS_OF,
    "active_contract_clients": R.SALES_AS_OF,
    "clients_by_line": R.EVENTS_AS_OF,
    "avg_weekly_validations": R.EVENTS_AS_OF,
    "total_clients": R.SALES_AS_OF,
    "validation_counts_yoy": R.SALES_AS_OF,
    "validation_rate_per_user": R.EVENTS_AS_OF,
    "sales_by_channel": R.SALES_AS_OF,
}


# refreshed into a stored table, too: a merge by key, and a replacement of dates
REFRESHES = ["title_sales_by_support", "validation_rate_per_user"]


def run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def single_date_loop(spark, sf_dir, name) -> float:
    """The reference's loop: one job per execution date (window of 1 day)."""
    from billetic.operators import DateWindow

    as_of = LOOPABLE[name]
    fn = getattr(R, f"q_{name}")
    total = 0.0
    for back in range(8, 0, -1):
        day = as_of - dt.timedelta(days=back)
        total += run(fn(spark, sf_dir, as_of, window=DateWindow.single(day)))
    return total


def _scale_factor(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(2, int(cpus) * 2)))
    extra = {"spark.driver.memory": "8g"} | dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if kv)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=partitions, extra=extra)
    qs = R.QUERIES

    for name in JOBS:                       # warm-up (JIT, file listing cache)
        run(qs[name](spark, sf_dir))

    times = {}
    for name in JOBS:
        samples = [run(qs[name](spark, sf_dir)) for _ in range(repeats)]
        times[name] = round(statistics.median(samples), 3)

    refreshes = {}
    root = f"{ensure_checkpoint_dir(spark)}/bench-refresh"
    sources = FixtureSources(spark, sf_dir, "a")
    for name in REFRESHES:
        samples = []
        for _ in range(1 + repeats):        # the first one warms up and creates the table
            t0 = time.perf_counter()
            refresh(spark, name, sources, LOOPABLE[name], f"{root}/{name}")
            samples.append(time.perf_counter() - t0)
        refreshes[name] = round(statistics.median(samples[1:]), 3)

    out = {
        "metric": "kpi_jobs_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _scale_factor(sf_dir),
        "cpus": int(cpus),
        "repeats": repeats,
        "refresh": refreshes,
    }
    if os.environ.get("BENCH_LOOP") == "1":
        out["loop8"] = {n: round(single_date_loop(spark, sf_dir, n), 3) for n in LOOPABLE}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
