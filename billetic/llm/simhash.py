"""SimHash near-duplicates with BK-trees.

A text's fingerprint has 64 bits: bit ``b`` is 1 when it is set in more than
half of the XXH64 hashes (seed 42) of its word shingles, repeats included.
Two fingerprints link when they differ in at most ``radius`` bits.

Plan. Only distinct fingerprints are compared; a group of copies is one row
after the map-side combine. The 64 bits are cut into ``radius + 2`` blocks;
two linked fingerprints agree on at least two of them, so each fingerprint
goes to one shard for every pair of blocks (keyed by the pair and its bits).
Each shard is a BK-tree: a child hangs at the integer Hamming distance to its
parent, and a search follows only the edges within ``radius`` of the
distance to the node. Shards are not broadcast: their number and size grow
with the corpus, so they are shuffled to tasks by key, where a tree lives
only while its shard is read. Links leave a shard as stars (each
fingerprint with the least of its local component), never as all pairs.

A shard of more than ``max_shard`` distinct fingerprints is not built as one
tree. Its members take an exact way of their own: two fingerprints within 2
bits share a midpoint within 1 bit of both, so they meet under one of 65 keys
each, and at most 65 fingerprints can meet under a key. (At radius 1 they meet
under the bit in which they differ and the value without it.)

Defined cases: a null or empty text, or one without words, has fingerprint 0,
linked like any other. Fewer words than a shingle make one shingle of all of
them. Equal texts are always linked. A null ``doc_id`` never is a component's
id unless the component has no other.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from billetic.llm._common import (
    Groups,
    connected_components,
    key_runs,
    quoted,
    run_bounds,
    stored,
    unused,
)

SEED = 42
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        end = len(data)
        if at + size < end and (m := _SPACE.search(data, at + size)):
            end = m.start()
        yield data[at:end].split()
        at = end


def simhash64(text: str | None, words: int = 3) -> int:
    """The fingerprint as an unsigned integer."""
    counts, total, tail, h = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest
    for block in _word_blocks((text or "").encode().lower()):
        seq = tail + block
        if len(seq) < words:
            tail = seq
            continue
        line = b" ".join(seq)
        ends = np.cumsum([len(w) + 1 for w in seq])
        starts = [0, *ends[: len(seq) - words].tolist()]
        stops = (ends[words - 1:] - 1).tolist()
        hashes = np.fromiter((h(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)),
                             np.uint64, len(stops))
        for part in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8), bitorder="little")
            counts += bits.reshape(-1, 64).sum(0, dtype=np.int64)
        total += len(hashes)
        tail = seq[len(seq) - words + 1:] if words > 1 else []
    if not total:
        return h(b" ".join(tail), SEED) if tail else 0
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > total).tolist()))


def fingerprint(text: Column | str, words: int = 3) -> Column:
    """Column of fingerprints as signed 64-bit integers."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash64(t, words) for t in texts], np.uint64).view(np.int64))

    return of(text)


def as_hex(fp: Column | str) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class BKTree:
    """A BK-tree over distinct 64-bit values, built and searched a level at a
    time; ``child[node, d]`` is the child at distance ``d`` or -1."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.child = np.full((len(values), 65), -1, np.int32)
        todo, at = np.arange(1, len(values)), np.zeros(len(values) - 1, np.int64)
        while len(todo):
            d = np.bitwise_count(values[todo] ^ values[at])
            free = self.child[at, d] < 0
            _, first = np.unique(at[free] * 65 + d[free], return_index=True)
            new = np.flatnonzero(free)[first]
            self.child[at[new], d[new]] = todo[new]
            down = np.ones(len(todo), bool)
            down[new] = False
            todo, at = todo[down], self.child[at[down], d[down]].astype(np.int64)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (index of query, node) within ``radius``."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = d <= radius
            yield q[hit], node[hit]
            nq, nn = [], []
            for step in range(-radius, radius + 1):
                e = d + step
                ok = (e > 0) & (e <= 64)
                nxt = self.child[node[ok], e[ok]]
                found = nxt >= 0
                nq.append(q[ok][found])
                nn.append(nxt[found].astype(np.int64))
            q, node = np.concatenate(nq), np.concatenate(nn)


def _link_shard(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    tree, groups = BKTree(values.view(np.uint64)), Groups(len(values))
    for at in range(0, len(values), 4096):
        for q, node in tree.search(values[at:at + 4096].view(np.uint64), radius):
            groups.join(q + at, node)
    tied = np.flatnonzero(groups.root != np.arange(len(values)))
    return values[tied], values[groups.root[tied]]


def _search_shards(radius: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in key_runs(batches, "shard"):
            fps = part.column("fp").to_numpy()
            starts, ends = run_bounds(part.column("shard").to_numpy())
            us, vs = [], []
            for i in np.flatnonzero(ends - starts > 1).tolist():
                u, v = _link_shard(fps[starts[i]:ends[i]], radius)
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return search


def _shards(distinct: DataFrame, radius: int) -> DataFrame:
    """(shard, fp): one row for every pair of blocks."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    part = [F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1))
            for i in range(n)]
    keys = [F.xxhash64(F.lit(i), F.lit(j), part[i], part[j])
            for i, j in itertools.combinations(range(n), 2)]
    return distinct.select(F.explode(F.array(*keys)).alias("shard"), "fp")


def _midpoint_links(fps: DataFrame) -> DataFrame:
    """All links of at most 2 bits among ``fps``, as stars around the least
    fingerprint under each midpoint (at most 65 rows a midpoint)."""
    near = F.concat(F.array("fp"), F.array(*[
        F.col("fp").bitwiseXOR(F.lit((1 << b) - ((1 << 64) if b == 63 else 0))) for b in range(64)]))
    keyed = fps.select("fp", F.explode(near).alias("mid"))
    least = F.min("fp").over(Window.partitionBy("mid"))
    return keyed.select(F.col("fp").alias("u"), least.alias("v")).filter("u <> v")


def _one_bit_links(fps: DataFrame) -> DataFrame:
    """All pairs that differ in one bit: two rows a key."""
    without = F.array(*[F.struct(F.lit(b).alias("bit"), F.col("fp").bitwiseAND(
        F.lit(~(1 << b) if b < 63 else (1 << 63) - 1)).alias("rest")) for b in range(64)])
    keyed = fps.select("fp", F.explode(without).alias("key"))
    return keyed.groupBy("key").agg(F.max("fp").alias("u"), F.min("fp").alias("v")).filter("u <> v").select("u", "v")


def fingerprint_links(distinct: DataFrame, radius: int = 2, max_shard: int = 20_000) -> DataFrame:
    """Star links ``(u, v)`` whose components are those of all pairs of
    distinct fingerprints ``fp`` within ``radius`` bits. Exact."""
    if not 0 <= radius <= 2:
        raise ValueError("radius is 0, 1 or 2")
    shards = _shards(distinct, radius)
    big = stored(shards.groupBy("shard").count().filter(F.col("count") > max_shard).select("shard"),
                 "bigshards")
    small = shards.join(big, "shard", "left_anti").repartition("shard").sortWithinPartitions("shard")
    links = small.mapInArrow(_search_shards(radius), "u long, v long")
    if big.isEmpty():
        return links
    rest = shards.join(big, "shard", "left_semi").select("fp").distinct()
    if radius == 0:
        return links            # distinct fingerprints differ
    return links.union(_midpoint_links(rest) if radius == 2 else _one_bit_links(rest))


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int,
             max_shard: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and per fingerprint its component's
    first row: ``first`` is (no id?, id, hash of the text), the least of the
    component."""
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                              fingerprint(F.col(text_col), words).alias("fp")), "fps")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = stored(rows.groupBy("fp").agg(F.min(order).alias("least")), "distinct")
    comps = connected_components(fingerprint_links(distinct.select("fp"), radius, max_shard))
    rooted = distinct.join(comps, distinct["fp"] == comps["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "rooted")
    first = stored(rooted.groupBy("root").agg(F.min("least").alias("first")), "firsts")
    return rows, stored(rooted.join(first, "root").select("fp", "first"), "classes")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
    radius: int = 2, max_shard: int = 20_000,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``;
    ``component_id`` is the least id reachable over links, itself included."""
    rows, classes = _classes(docs, id_col, text_col, words, radius, max_shard)
    return rows.join(classes, "fp").select("doc_id", "fp", F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
             radius: int = 2, max_shard: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the
    least id. Of rows that repeat this id the one with the least text hash
    stays; of wholly equal rows one. A component without any id keeps one
    row, too."""
    _, classes = _classes(docs, id_col, text_col, words, radius, max_shard)

    def label(doc_id, text_hash) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")),
                           text_hash.cast("string"))

    key, row = unused("__keep", docs), unused("__row", docs)
    keep = classes.select(label(F.col("first.doc_id"), F.col("first.text_hash")).alias(key)).distinct()
    tagged = docs.withColumn(key, label(F.col(id_col), F.xxhash64(text_col)))
    # rows that share an id and a text: few, or one large group that map tasks reduce to a row each
    twice = stored(tagged.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "repeated")
    kept = tagged.join(keep, key, "left_semi")
    columns = list(map(quoted, docs.columns))
    one = kept.join(twice, key, "left_semi").groupBy(key).agg(
        F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(row))
    return kept.join(twice, key, "left_anti").select(*columns).union(
        one.select(*[F.col(row)[c].alias(c) for c in docs.columns]))
