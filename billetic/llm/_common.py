"""Helpers shared by the operators: tables in the shared scratch folder,
connected components, and runs of equal keys in sorted batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billetic.session import CHECKPOINT_CONF, ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: the one named by
    ``spark.checkpoint.dir``, or a local session's own checkpoint folder."""
    base = spark.conf.get(CHECKPOINT_CONF, None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back. Cuts
    the lineage (a lost executor costs a re-read, not a re-run) and gives the
    planner the table's true size."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data. Python workers on this machine find the
    package where the driver has it, from any working folder (a cluster gets
    it by ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, longer if a frame has a column of that name already."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def n_words(text: Column | str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 if null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(u, v)`` links -> ``(node, root)``: for each node of a link the least
    node reachable. Alternating large-star and small-star rounds, each
    written to the shared folder; the number of rounds is logarithmic in the
    size of the largest component. Nothing but a count and a checksum of the
    links reaches the driver."""
    spark = edges.sparkSession
    cur = stored(edges.filter("u <> v").select("u", "v").distinct(), "cc")
    seen = _checksum(cur)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        cur = stored(_small_star(_large_star(cur)), "cc")
        now = _checksum(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    if seen[0] == 0:
        return spark.createDataFrame([], "node long, root long")
    pairs = cur.select(F.explode(F.array(
        F.struct(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root")),
        F.struct(F.least("u", "v").alias("node"), F.least("u", "v").alias("root")),
    )).alias("p")).select("p.*")
    return pairs.distinct()


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    # written first: the links of a hub meet one plain row, and its partition can be split
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    kept = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(least.select("u", F.col("m").alias("v"))).distinct()


def key_runs(batches: Iterator, key: str) -> Iterator:
    """Cut Arrow batches that are sorted by ``key`` into tables that end where
    a key ends, so that no run of equal keys is ever cut. Only the last,
    perhaps unfinished run is held back."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def run_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))


class Groups:
    """Union-find over 0..n-1 that takes whole arrays of pairs; the least
    member is the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        apart = a != b
        if not apart.any():
            return
        pairs = np.unique(np.stack((a[apart], b[apart]), 1), axis=0)
        for x, y in pairs.tolist():
            x, y = self._find(x), self._find(y)
            if x != y:
                self.root[max(x, y)] = min(x, y)
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return
            self.root = up
