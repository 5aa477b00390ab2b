"""Run the trailing refresh of one job, or of all, the way the reference's
procedures are executed:

    python -m billetic.streaming --sources <dir> --reports <dir> \\
        [--job title_sales_by_support] [--as-of 2024-05-02]

(on a cluster: ``spark-submit --py-files billetic.zip billetic/streaming/__main__.py ...``).

``--sources`` holds one Parquet table per logical source (``validation``,
``sales``, ``sale_detail``, ``support``, ``contact``, ``article``, ``line``,
``card``); without it the sources are catalog tables. ``--table
validation=Prod_Validation`` (repeatable) names a source stored under another
name. Each report is written to ``<reports>/<target table name>``.
``--as-of`` defaults to today, which gives the reference's window (today-8 ..
today-1). Master, memory and ``spark.checkpoint.dir`` come from the cluster
configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from billetic.session import ensure_checkpoint_dir
from billetic.sources.catalog import CatalogSources
from billetic.streaming.refresh import JOBS, refresh


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="billetic.streaming")
    parser.add_argument("--sources", help="folder of Parquet tables; catalog tables when omitted")
    parser.add_argument("--table", action="append", default=[], metavar="LOGICAL=STORED",
                        help="stored name of a logical source (repeatable)")
    parser.add_argument("--reports", required=True)
    parser.add_argument("--job", choices=sorted(JOBS), action="append",
                        help="job to run (repeatable); all jobs when omitted")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("billetic-refresh").config(
        "spark.sql.session.timeZone", "UTC").getOrCreate()
    ensure_checkpoint_dir(spark)
    names = dict(item.split("=", 1) for item in args.table)
    sources = CatalogSources(spark, args.sources, names)
    for name in args.job or list(JOBS):
        refresh(spark, name, sources, args.as_of, f"{args.reports}/{JOBS[name].target.name}")


if __name__ == "__main__":
    main()
