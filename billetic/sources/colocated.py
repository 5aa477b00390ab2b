"""Tables stored by a join key: bucketed and sorted, so that a join on the key
reads them where they are.

A join of two large sides shuffles both. A fact table without a date (the sale
lines) would cross the network whole on every run; stored once by its
transaction, only the other side moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def store_colocated(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                    mode: str = "overwrite") -> None:
    """Write ``df`` as the catalog table ``table``, hashed on ``key`` into
    ``buckets`` files and sorted by it within each. The rows are rebalanced by
    the same hash first, so a bucket is one file and not one a task; AQE splits
    a hot key (and NULL keys, which share a bucket) among several.

    ``path`` is the table's folder (the warehouse if not given). Use at least
    as many buckets as ``spark.sql.shuffle.partitions``: a join with fewer
    shuffles both sides. ``mode="append"`` adds files to the buckets; rewrite
    the table now and then to sort them as a whole. A join reads a bucket in
    one task: where one key holds a large part of all rows, read the table
    with ``spark.sql.sources.bucketing.enabled=false``, so that the join
    shuffles it and AQE splits the key."""
    writer = df.hint("rebalance", buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_colocated(spark: SparkSession, table: str) -> DataFrame:
    """The stored table; its buckets are known to the planner."""
    return spark.table(table)
