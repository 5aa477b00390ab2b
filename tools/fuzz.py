"""Differential sweep beyond the test suite: for each seed, a random world of
logical tables (tests/test_random.py's generator), a random execution date
and a window of 1, 8, 40 or 100 days; every job on Spark against the
reference-style oracle SQL on DuckDB.

    python tools/fuzz.py FIRST_SEED LAST_SEED
"""

from __future__ import annotations

import datetime as dt
import os
import random
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import test_random as TR  # noqa: E402
from billetic import oracle as O  # noqa: E402
from billetic.operators import DateWindow  # noqa: E402
from billetic.session import build_session  # noqa: E402
from billetic.testing import canonical, run_duckdb, run_spark  # noqa: E402


def main():
    first, last = int(sys.argv[1]), int(sys.argv[2])
    spark = build_session("local[8]", 8)
    bad = 0
    for seed in range(first, last):
        rng = random.Random(1000 + seed)
        as_of = dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(900))
        window = DateWindow.trailing(as_of, start_back=rng.choice([1, 8, 40, 100]))
        data = TR.tables(seed, as_of)
        src, con = TR.Src(TR.spark_frames(spark, data, seed)), TR.duck(data, seed)
        for name, (job, sql) in TR.JOBS.items():
            got = canonical(*run_spark(job(src, window, as_of)))
            if sql is None:
                text, _ = O.validations_by_age(as_of, start=as_of - dt.timedelta(days=400))
            else:
                body, ctes = sql(as_of)
                ctes = [O.spine_cte(window) if c.startswith("spine AS") else c
                        for c in ctes if not c.startswith(TR.LOGICAL)]
                text = O.with_ctes(ctes, body)
            if got != canonical(*run_duckdb(con, text)):
                bad += 1
                print("MISMATCH", seed, as_of, window, name, flush=True)
    print(f"seeds {first}..{last - 1}: {bad} mismatches")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
