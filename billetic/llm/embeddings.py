"""Embedding near-duplicates by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard
transform; its hash is the axis it then lies nearest to, with the sign. A
table's bucket is the hash of ``hashes`` such turns. With multiprobe a vector
also goes to the buckets of its next nearest axes, ``probes`` buckets in all.
The candidates of a bucket are verified by their cosine in double precision,
so no pair below ``threshold`` is linked.

Equal vectors are one class with a count from the start (map-side combine),
whatever their number. A bucket's pairs are not emitted: the task that reads
a bucket counts each member's links and returns a star per local component.
A pair that meets in several buckets is counted in the first one only, which
both vectors' codes tell without any exchange. A bucket of more than
``block`` classes is cut into chunks; each pair of chunks is a task of its
own.

The number of turns grows with the table (buckets keep a few members), and
tables and probes with it, so that a pair at cosine 0.95 in 64 dimensions is
found with probability 0.99 or more at every size.

Defined cases: null, empty and zero vectors and those with a null or a
component that is not finite link with nothing; only vectors of one length
are compared; rows that repeat an id or a vector are vectors of their own. A
null id is never a component's id unless it has no other; such a row is kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billetic.llm._common import Groups, connected_components, key_runs, run_bounds, stored

#: turns -> (tables, probes)
PLANS = {1: (3, 3), 2: (4, 4), 3: (7, 8), 4: (12, 12)}


def turns_for(n_vectors: int, dims: int = 64) -> int:
    """As many as leave a bucket some tens of vectors at most."""
    turns, buckets = 1, 2 * dims
    while n_vectors / buckets > 64 and turns < max(PLANS):
        turns, buckets = turns + 1, buckets * 2 * dims
    return turns


def hadamard(x: np.ndarray) -> np.ndarray:
    """Of each row, whose length is a power of two; norms stay."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def codes(x: np.ndarray, turns: int, tables: int, probes: int) -> np.ndarray:
    """(vectors, tables, probes) bucket ids of normed vectors, nearest first."""
    n, dims = x.shape
    d = 1 << (dims - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, d - dims)))
    rng = np.random.default_rng(dims)
    signs = rng.choice([-1.0, 1.0], (tables, turns, 3, d))
    near = min(3, d)
    out = np.empty((n, tables, probes), np.uint64)
    for t in range(tables):
        axes, losses = [], []
        for turn in signs[t]:
            y = x
            for s in turn:
                y = hadamard(y * s)
            m = np.abs(y)
            top = np.argpartition(-m, near - 1, 1)[:, :near] if near < d else np.argsort(-m, 1)
            v = np.take_along_axis(m, top, 1)
            order = np.argsort(-v, 1, kind="stable")
            top, v = np.take_along_axis(top, order, 1), np.take_along_axis(v, order, 1)
            axes.append((2 * top + (np.take_along_axis(y, top, 1) < 0)).astype(np.uint64))
            losses.append((v[:, :1] - v) ** 2)
        ids, loss = [], []
        for pick in itertools.product(range(near), repeat=turns):
            code = np.full(n, np.uint64(dims * 1000 + t))
            for j, i in enumerate(pick):
                code = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + axes[j][:, i]
            ids.append(code ^ (code >> np.uint64(29)))
            loss.append(sum(losses[j][:, i] for j, i in enumerate(pick)))
        ids, loss = np.stack(ids, 1), np.stack(loss, 1)
        first = np.argsort(loss, 1, kind="stable")[:, :probes]
        taken = np.take_along_axis(ids, first, 1)
        if taken.shape[1] < probes:
            taken = np.concatenate([taken, np.repeat(taken[:, :1], probes - taken.shape[1], 1)], 1)
        out[:, t] = taken
    return out


def _normed(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    # first by the largest component: squares of large ones don't overflow
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _entries(turns: int, tables: int, probes: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids, n = batch.column("cid").to_numpy(), batch.column("n").to_numpy()
                lists = batch.column("embedding")
                lens = lists.value_lengths().to_numpy()
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                ends = np.cumsum(lens)
                for dims in np.unique(lens).tolist():
                    rows = np.flatnonzero(lens == dims)
                    x = flat[(ends[rows] - dims)[:, None] + np.arange(dims)]
                    blobs = [v.tobytes() for v in x]
                    got = codes(_normed(blobs), turns, tables, probes).reshape(len(rows), -1)
                    own = np.repeat(np.arange(len(rows)), got.shape[1])
                    buckets = got.ravel().view(np.int64)
                    _, first = np.unique(np.stack((own, buckets)), axis=1, return_index=True)
                    own, buckets = own[first], buckets[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(buckets), pa.array(ids[rows[own]]), pa.array(n[rows[own]]),
                         pa.array(blobs, pa.binary()).take(pa.array(own))], names=["bucket", "cid", "n", "vec"])

    return build


def _meets_first(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of code arrays (pairs, tables, probes): the bucket in which
    a pair counts. ``a`` is the vector of the lesser class."""
    ha, hb = a[:, :, 0], b[:, :, 0]
    one = (ha[:, :, None] == b).any(2)
    two = (hb[:, :, None] == a).any(2)
    any_ = one | two
    t = any_.argmax(1)
    rows = np.arange(len(a))
    # probes that meet probes only are no meeting
    where = np.where(one[rows, t], ha[rows, t], hb[rows, t])
    return np.where(any_.any(1), where, np.uint64(0)), any_.any(1)


def _link_buckets(threshold: float, turns: int, tables: int, probes: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in key_runs(batches, "slot"):
            slots, cids = part.column("slot").to_numpy(), part.column("cid").to_numpy()
            n, chunk = part.column("n").to_numpy(), part.column("chunk").to_numpy()
            lo, hi = part.column("lo").to_numpy(), part.column("hi").to_numpy()
            buckets = part.column("bucket").to_numpy().view(np.uint64)
            vecs = part.column("vec").combine_chunks()
            starts, ends = run_bounds(slots)
            out = []
            for k in np.flatnonzero(ends - starts > 1).tolist():
                a, b = int(starts[k]), int(ends[k])
                order = a + np.argsort(cids[a:b], kind="stable")
                x = _normed(vecs.take(pa.array(order)).to_pylist())
                if lo[a] == hi[a]:
                    left, right = order, order
                    i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
                else:
                    is_left = chunk[order] == lo[a]
                    left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
                    i, j = np.nonzero(x[left] @ x[right].T >= threshold)
                    i, j = left[i], right[j]
                    i, j = np.minimum(i, j), np.maximum(i, j)
                if not len(i):
                    continue
                used, back = np.unique(np.concatenate((i, j)), return_inverse=True)
                c = codes(x[used], turns, tables, probes)
                keep = np.zeros(len(i), bool)
                for at in range(0, len(i), 50_000):
                    p, q = back[at:at + 50_000], back[len(i) + at:len(i) + min(at + 50_000, len(i))]
                    p = p[: len(q)]
                    where, met = _meets_first(c[p], c[q])
                    keep[at:at + len(q)] = met & (where == buckets[a])
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                links = np.bincount(i, n[order[j]], len(order)) + np.bincount(j, n[order[i]], len(order))
                groups = Groups(len(order))
                groups.join(i, j)
                rows = np.flatnonzero(links)
                out.append((cids[order[rows]], links[rows].astype(np.int64), cids[order[groups.root[rows]]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 names=["cid", "links", "root"])

    return link


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
    turns: int | None = None, block: int = 2000,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    e = F.col("embedding")
    good = F.coalesce(e.isNotNull() & F.forall(
        e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0),
        F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding")).withColumn("good", good)
    classes = stored(rows.filter("good").groupBy("embedding").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n")).withColumn(
        "cid", F.monotonically_increasing_id()), "vectorclasses")
    if turns is None:
        size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dims")).first()
        turns = turns_for(size["n"], size["dims"] or 1)
    tables, probes = PLANS[turns]
    entries = stored(classes.select("cid", "n", "embedding").mapInArrow(
        _entries(turns, tables, probes), "bucket long, cid long, n long, vec binary"), "entries")
    big = stored(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > block).select(
        F.col("bucket").alias("b_bucket"), F.ceil(F.col("m") / block).cast("int").alias("chunks")), "bigbuckets")
    cut = entries.join(big, entries["bucket"] == big["b_bucket"], "left").select(
        "bucket", "cid", "n", "vec", F.coalesce("chunks", F.lit(1)).alias("chunks"),
        F.pmod(F.xxhash64("cid"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "bucket", "cid", "n", "vec", "chunk", F.least("chunk", "other").alias("lo"),
        F.greatest("chunk", "other").alias("hi")).withColumn("slot", F.xxhash64("bucket", "lo", "hi"))
    found = stored(dealt.repartition("slot").sortWithinPartitions("slot").mapInArrow(
        _link_buckets(threshold, turns, tables, probes), "cid long, links long, root long"), "vectorlinks")
    links = found.groupBy("cid").agg(F.sum("links").alias("links")).withColumnRenamed("cid", "l_cid")
    comps = connected_components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    whole = classes.join(comps, classes["cid"] == comps["node"], "left").join(
        links, classes["cid"] == links["l_cid"], "left").select(
        "embedding", "least_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "cid").alias("root"))
    least = whole.groupBy("root").agg(F.min("least_id").alias("component_id"))
    told = stored(whole.join(least, "root").select("embedding", "n_links", "component_id"), "vectorcomps")
    in_class = rows.filter("good").join(told, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("good")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return in_class.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
