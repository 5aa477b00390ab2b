"""Spark session settings the jobs rely on.

The jobs themselves never create a session; they take DataFrames. This module
is for entry points (tests, bench, the driver contract) and documents the
settings that matter at scale:

* ``spark.sql.session.timeZone=UTC`` -- every "day" is the calendar day of a
  timestamp without time zone; a session zone must never shift it.
* AQE on, with partition coalescing and skew-join splitting: small aggregate
  tables become broadcasts at run time only when their *measured* size is
  under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; big ones stay
  sort-merge joins, and a hot key (anonymous card, a very active customer) is
  split across tasks instead of landing in one.
* No Spark UI (no server is opened).
* A checkpoint directory: read from ``spark.checkpoint.dir`` when the cluster
  names one; only a local session (tests, bench) gets a scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "billetic",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the settings of the module docstring.

    What spark-submit or the cluster has set is left alone: the number of
    shuffle partitions is written only if the caller names one (tests and the
    bench do), and memory never."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a scratch one only in local mode.

    On a cluster the directory must be the shared folder named by
    ``spark.checkpoint.dir``; a machine-local folder would not survive the loss
    of an executor, so in that case we refuse rather than invent one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; name a shared folder for checkpoints"
        )
    scratch = tempfile.mkdtemp(prefix="billetic-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint directory and read it back:
    it is computed once, a lost executor costs a re-read, and the planner
    knows the table's true size instead of an estimate of its inputs."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
