"""Shards by k-d tree: split at distributed weighted medians along the widest
metadata dimension until the leaves have the target bytes.

The law is ``bytes``: shard sizes near equal. A document's size is the UTF-8
bytes of its text plus 8. Equal texts are one point of the tree, and so stay
in one shard, unless a text's copies weigh more than 1/16 of a shard: then
its rows are dealt by their running number in the stored table into chunks of
1/64 of a shard, each a point of its own.

A point's dimensions are the logarithm of its size, and the places of its
source and language (the least ones of its copies) on a hash scale, each of 12
bits; null is a value like any other. A node of k leaves is split along the
dimension in which it reaches over the largest part of the whole table's
range, at the point that gives k // 2 leaves their part of the bytes. No
points are sorted: a histogram of each dimension (at most 4096 places) shows
the widest one and the place in which the part ends; a second one, over 12
bits of a hash of the texts at that place, shows where to cut through it, to
within 1/4096 of its weight. All nodes of a level are split in the same jobs;
their cuts are one row per node, written before they meet the points.

Slots number a shard's documents from 0 without gaps: by buckets of the
running number, then in them. Only buckets are sorted, never a shard.

Only DataFrame functions are used. Defined cases: a null text weighs 8 and
has CRC 0; rows may repeat, ids and whole rows alike; an empty table gives an
empty result. Only four columns are read, so others may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billetic.llm._common import stored

SCALE = 12                       # bits of a dimension's place, and of a tie
DIMS = 3
HEAVY, CHUNKS = 16, 64           # parts of a shard: texts above the first are dealt in parts of the second
SLOT_BUCKETS = 4096

RESULT = ("doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")


def _points(rows: DataFrame, total: int, n_shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their chunk, and one point for each text and chunk."""
    heavy, chunk = max(1, total // (n_shards * HEAVY)), max(1, total // (n_shards * CHUNKS))
    big = stored(rows.groupBy("text_key", "size").agg(F.sum("size").alias("weight")).filter(
        F.col("weight") > heavy).select(
            F.col("text_key").alias("b_key"), F.col("size").alias("b_size"),
            F.ceil(F.col("weight") / chunk).cast("long").alias("chunks")), "bigtexts")
    dealt = rows.join(big, (F.col("text_key") == F.col("b_key")) & (F.col("size") == F.col("b_size")),
                      "left").withColumn(
        "chunk", F.coalesce(F.pmod(F.col("nth"), F.col("chunks")), F.lit(0))).drop("b_key", "b_size", "chunks")

    def place(value: Column) -> Column:
        return F.xxhash64(value).bitwiseAND(F.lit((1 << SCALE) - 1))

    points = dealt.groupBy("text_key", "size", "chunk").agg(
        F.sum("size").alias("weight"), F.min("source").alias("source"), F.min("lang").alias("lang"))
    log_size = F.least(F.lit((1 << SCALE) - 1),
                       (F.log2(F.col("size").cast("double")) / 40 * (1 << SCALE)).cast("long"))
    return dealt, points.select(
        "text_key", "size", "chunk", "weight", log_size.alias("d0"), place(F.col("source")).alias("d1"),
        place(F.col("lang")).alias("d2"), place(F.struct("text_key", "size", "chunk")).alias("tie"))


def _upto(hist: DataFrame, keys: list[str], by: str) -> DataFrame:
    """``n`` of a histogram, summed up to each bucket. All of a node's buckets
    (at most 4096 a dimension) are in one task."""
    over = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    return hist.repartition("lo").withColumn("upto", F.sum("n").over(over))


def _place(dim: str) -> Column:
    return F.element_at(F.array("d0", "d1", "d2"), F.col(dim) + 1)


def _cut_places(points: DataFrame, reach: list[int]) -> DataFrame:
    """For each node of two or more leaves: the dimension, the place in which
    the left leaves' part ends, and how much of it is left there."""
    dims = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"d{i}").alias("place")) for i in range(DIMS)]))
    hist = points.filter("hi - lo > 1").select("lo", "hi", "weight", dims.alias("d")).groupBy(
        "lo", "hi", "d.dim", "d.place").agg(F.sum("weight").alias("n"))
    keys = ["lo", "hi", "dim"]
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    budget = F.sum("n").over(Window.partitionBy(*keys)) * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))
    reached = _upto(hist, keys, "place").withColumns({"mid": mid, "budget": budget})
    width = F.element_at(F.array(*[F.lit(max(1, r)) for r in reach]), F.col("dim") + 1)
    cuts = reached.groupBy(*keys).agg(
        ((F.max("place") - F.min("place")) / F.first(width)).alias("part"), F.first("mid").alias("mid"),
        F.min(F.when(F.col("upto") >= F.col("budget"), F.struct(
            "place", (F.col("budget") - F.col("upto") + F.col("n")).alias("rest")))).alias("cut"))
    return cuts.groupBy("lo", "hi").agg(F.max(F.struct(
        "part", (-F.col("dim")).alias("order"), "dim", "mid", "cut")).alias("best")).select(
        F.col("lo").alias("node"), "best.dim", "best.mid", "best.cut.place", "best.cut.rest")


def _cut_ties(points: DataFrame, cuts: DataFrame) -> DataFrame:
    """The cuts with ``tie``: points at the place go left up to it."""
    there = points.join(cuts, points["lo"] == cuts["node"]).filter(_place("dim") == F.col("place"))
    hist = there.groupBy("lo", "tie").agg(F.sum("weight").alias("n"), F.first(F.struct(*cuts.columns)).alias("at"))
    # as many buckets as bring the sum nearest to what is left
    near = F.struct(F.abs(F.col("upto") - F.col("at.rest")).alias("off"), F.col("tie"))
    ties = _upto(hist, ["lo"], "tie").groupBy("lo").agg(F.min(near).alias("near"), F.first("at").alias("at"))
    none = F.col("at.rest") < F.col("near.off")
    return ties.select("at.node", "at.dim", "at.mid", "at.place",
                       F.when(none, F.lit(-1)).otherwise(F.col("near.tie")).alias("cut_tie"))


def _split(points: DataFrame, ties: DataFrame) -> DataFrame:
    """Send the points of each node that is cut to one of its halves."""
    here = _place("dim")
    left = (here < F.col("place")) | ((here == F.col("place")) & (F.col("tie") <= F.col("cut_tie")))
    done = F.col("node").isNull()
    return points.join(ties, points["lo"] == ties["node"], "left").select(
        "text_key", "size", "chunk", "weight", "d0", "d1", "d2", "tie",
        F.when(done | left, F.col("lo")).otherwise(F.col("mid")).alias("lo"),
        F.when(done | ~left, F.col("hi")).otherwise(F.col("mid")).alias("hi"))


def kd_shards(
    docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every
    row; the number of shards is given or follows from ``target_bytes``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key"),
        F.col(source_col).alias("source"), F.col(lang_col).alias("lang"),
        F.monotonically_increasing_id().alias("nth")), "rows")
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    if n_shards is None:
        n_shards = max(1, math.ceil(total / target_bytes))
    dealt, points = _points(rows, total, n_shards)
    points = stored(points.withColumns({"lo": F.lit(0), "hi": F.lit(n_shards)}), "points")
    ends = points.agg(*[(F.max(f"d{i}") - F.min(f"d{i}")) for i in range(DIMS)]).first()
    for _ in range(math.ceil(math.log2(n_shards)) if n_shards > 1 else 0):
        cuts = stored(_cut_places(points, list(ends)), "cuts")
        points = stored(_split(points, stored(_cut_ties(points, cuts), "ties")), "points")
    placed = stored(dealt.select("doc_id", "size", "text_crc32", "text_key", "chunk", "nth").join(
        points.select("text_key", "size", "chunk", F.col("lo").alias("shard")),
        ["text_key", "size", "chunk"]).withColumn(
            "bucket", F.pmod(F.xxhash64("nth"), F.lit(SLOT_BUCKETS))), "placed")
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "bucket").orderBy("nth")
    return placed.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.row_number().over(order) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
