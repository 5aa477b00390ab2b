"""Repeated passages by a run-length index.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(lesser id, or the same document at an earlier place) is marked; strings are
judged on the input, and matches never cross documents. The result is exact.

1. Each window of LENGTH bytes has an anchor: the leftmost of its GRAM-byte
   grams with the least hash. The choice depends on the window's bytes only,
   so equal windows have equal anchors at the same offset. Neighbouring
   windows share anchors: a document has about one for every 35 bytes. A row
   per anchor says which windows it owns and carries a hash of their bytes.
2. Copies that a map task sees together are settled there: all but the
   earliest of them are marked at once and only pass through, spread over
   all tasks, so a passage that a third of the documents share is one row
   per map task. The rest is shuffled by anchor and streamed in order, with
   nothing kept but the last row. Rows with equal owned bytes form a class: all but its
   earliest are marked whole. An anchor with one class is done; of the others
   each class's earliest row goes on. These are the borders of the repeated
   stretches, a small part of the text.
3. Their bytes (at most 168 a row) are fetched from the documents. The windows
   of an anchor with more than ``max_rows`` of them are parted by how far they
   begin before the anchor: those of the far half share more bytes on its
   left, the others on its right. These bytes are their new, longer anchor,
   and step 2 is done again with it, until an anchor is small enough. A row
   has two parts at most; where every window is a part of its own, all of an
   anchor are equal and step 2 settles it.
4. Blocks of whole anchors get a run-length index (``runlength``):
   Burrows-Wheeler runs with sampled ends, from which the matching statistics
   are streamed; where they reach LENGTH, all but the earliest place are
   marked. A block's suffix order (1 MB of text) is kept while it is read, as
   the marks name every place of a match and not only the runs' ends.
5. Marks meet the documents, and are joined to maximal spans there.

Hashes of 113 bits stand for the bytes of windows in steps 2 and 3 only.

A document is an id and a text. Ids with several texts (null is an id here)
are found first; their texts are numbered by their SHA-256, and the number
goes with the id. So no two documents are ever taken for one.

Defined cases: a null text is empty; nulls among ids come last; rows that
repeat an id and its text are one document and share the result; rows with
one id and different texts are different documents, in order of their
SHA-256. Only the id and the text are read, so other columns may have any
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billetic.llm._common import key_runs, stored
from billetic.llm.runlength import RunLengthIndex

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1            # grams in a window
PIECE = 1 << 18
NO_ID = (1 << 63) - 1
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _M1
    x ^= x >> np.uint64(32)
    x += b
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end (``ends``: where each stops): gram hash,
    hash of the owned bytes, and first window, last window and anchor place
    of each anchor."""
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    n = len(data) - LENGTH + 1
    if n <= 0:
        return none
    g, size = _BYTE[data], 1
    while size < GRAM:
        g = _mix(g[:-size], g[size:])
        size *= 2
    low, off, size = (g >> np.uint64(32)).astype(np.uint32), np.zeros(len(g), np.uint8), 1

    def widen(low, off, step):
        right = low[step:] < low[:-step]
        off = np.where(right, off[step:] + np.uint8(step), off[:-step])
        return np.minimum(low[step:], low[:-step]), off

    while size * 2 <= SPAN:
        low, off = widen(low, off, size)
        size *= 2
    if size < SPAN:
        low, off = widen(low, off, SPAN - size)
    # windows that stay in their text
    inside = np.ones(n, bool)
    for e in ends[:-1].tolist():
        inside[max(0, e - LENGTH + 1):e] = False
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    place = at + off[at]
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    first, last = at[np.concatenate(([0], cut))], at[np.concatenate((cut - 1, [len(at) - 1]))]
    place = place[np.concatenate(([0], cut))]

    def window(i):
        return _mix(_mix(g[i], g[i + GRAM]), _mix(g[i + 2 * GRAM], g[i + LENGTH - GRAM]))

    owned = _mix(window(first), window(last)) & ~np.uint64(0x7FFF)
    owned |= ((place - first) << 7 | (place - last)).astype(np.uint64)
    return g[place].view(np.int64), owned.view(np.int64), first, last, place


SETTLED = 128 << 7      # added to the owned hash's low bits, which hold the place of the windows


def _settle(rows: np.ndarray) -> np.ndarray:
    """Of rows (h, c, d, q) with equal owned bytes the earliest stays as it
    is; the others are settled as marks, with an anchor that spreads them."""
    order = np.argsort(rows[:, 0], kind="stable")
    h = rows[order, 0]
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[:-1] |= same[1:]
    some = rows[order[same]]
    some = some[np.lexsort(some.T[::-1])]
    new = np.ones(len(some), bool)
    new[1:] = (some[1:, :2] != some[:-1, :2]).any(1)
    first = np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))
    later = (some[:, 2:] != some[first][:, 2:]).any(1)
    spread = _mix(some[later, 2].view(np.uint64) + np.uint64(1), some[later, 3].view(np.uint64))
    some[later, 0] = spread.view(np.int64)
    some[later, 1] += SETTLED
    return np.concatenate([rows[order[~same]], some])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, x, text) -> (h, c, d, q); q is the text hash x and the anchor's
    place in one number."""
    def out(parts):
        found = _settle(np.stack([np.concatenate(c) for c in zip(*parts, strict=True)], 1))
        return pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(4)], names=["h", "c", "d", "q"])

    def rows(texts, ids, hashes, base):
        ends = np.cumsum([len(t) for t in texts])
        h, c, _, _, place = anchors(np.frombuffer(b"".join(texts), np.uint8), ends)
        doc = np.searchsorted(ends, place, "right")
        at = place - np.concatenate(([0], ends[:-1]))[doc] + base
        return h, c, np.array(ids)[doc], np.array(hashes)[doc] << 32 | at

    for batch in batches:
        parts, texts, ids, hashes, size = [], [], [], [], 0
        column = batch.column("text").cast(pa.binary())
        for d, x, t in zip(batch.column("d").to_pylist(), batch.column("x").to_pylist(), column, strict=True):
            n = len(t.as_buffer()) if t.is_valid else 0
            if n < LENGTH:
                continue
            data = t.as_py()
            if n > 2 * PIECE:
                for at in range(0, n - LENGTH + 1, PIECE):
                    parts.append(rows([data[at:at + PIECE + LENGTH - 1]], [d], [x], at))
                    if len(parts) > 64:
                        yield out(parts)
                        parts = []
                continue
            texts.append(data)
            ids.append(d)
            hashes.append(x)
            size += n
            if size >= PIECE:
                parts.append(rows(texts, ids, hashes, 0))
                texts, ids, hashes, size = [], [], [], 0
                if len(parts) > 64:
                    yield out(parts)
                    parts = []
        if texts:
            parts.append(rows(texts, ids, hashes, 0))
        if parts:
            yield out(parts)


_JUDGED = "d long, x int, kind int, s int, e int, h long, p int"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, c, d, q) -> marks (kind 0) and the classes' first
    rows where an anchor has several classes (kind 1)."""
    held = None                 # the last class's first row, as (h, c, d, q)
    several = False             # its anchor has more than one class
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy() for k in ("h", "c", "d", "q")], 1)
        settled = (rows[:, 1] & SETTLED) > 0
        if settled.any():
            yield _judged(rows[settled], rows[:0])
            rows = rows[~settled]
            if not len(rows):
                continue
        given = held is not None
        if given:
            rows = np.concatenate([[held], rows])
        n = len(rows)
        new_h, new = np.ones(n, bool), np.ones(n, bool)
        new_h[1:] = rows[1:, 0] != rows[:-1, 0]
        new[1:] = new_h[1:] | (rows[1:, 1] != rows[:-1, 1])
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        mark = ((rows[:, 2:] != rows[first][:, 2:]).any(1)) & ~new
        reps = np.flatnonzero(new)
        opens = new_h[reps]
        # of an anchor with several classes: the class before or after has the same anchor
        joint = ~opens
        joint[:-1] |= ~opens[1:]
        if given and several:
            # its first row is out already
            joint[0] = False
        last = rows[reps[-1]]
        out_reps = reps[joint]
        several = bool(~opens[-1]) or (len(reps) == 1 and given and several)
        held = last
        yield _judged(rows[mark], rows[out_reps])
        # a last class that only opens its anchor waits; one that went out is remembered as such


def _judged(marks: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
    rows = np.concatenate([marks, reps])
    kind = np.repeat(np.array([0, 1], np.int32), [len(marks), len(reps)])
    low, high = (rows[:, 1] >> 7) & 127, rows[:, 1] & 127
    place = rows[:, 3] & 0xFFFFFFFF
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[:, 2]), pa.array((rows[:, 3] >> 32).astype(np.int32)), pa.array(kind),
         pa.array((place - low).astype(np.int32)), pa.array((place - high + LENGTH).astype(np.int32)),
         pa.array(rows[:, 0]), pa.array(place.astype(np.int32))], names=["d", "x", "kind", "s", "e", "h", "p"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, x, text, borders) -> the bytes of every border."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        ids, hashes = batch.column("d").to_pylist(), batch.column("x").to_pylist()
        out, size = [], 0
        for d, x, t, borders in zip(ids, hashes, texts, batch.column("borders").to_pylist(), strict=True):
            data = t.as_py()
            for b in borders:
                out.append((b["h"], d, x << 32 | b["s"], b["p"] - b["s"], data[b["s"]:b["e"]]))
                size += 1
            if size > 20_000:
                yield _context_batch(out)
                out, size = [], 0
        if out:
            yield _context_batch(out)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                                                                  pa.binary()), strict=True)],
        names=["h", "d", "q", "low", "bytes"])


def _halves(level: int) -> list[tuple[int, int]]:
    """The ranges of window starts before an anchor, after so many halvings."""
    ranges = [(0, SPAN - 1)]
    for _ in range(level):
        ranges = [part for u, v in ranges
                  for part in ([(u, (u + v) // 2), ((u + v) // 2 + 1, v)] if v > u else [(u, v)])]
    return ranges


def _parts(batch: pa.RecordBatch, level: int) -> Iterator[tuple]:
    """(new anchor, hash of the bytes, d, place, start, low, bytes) of every
    part of a batch of contexts."""
    ranges = _halves(level)
    for row in batch.to_pylist():
        data, low = row["bytes"], row["low"]
        high = low + LENGTH - len(data)         # its windows begin high to low bytes before the anchor
        for u, v in ranges:
            near, far = max(u, high), min(v, low)
            if near > far:
                continue
            core = data[low - u:low + LENGTH - v]
            name = hashlib.blake2b(core, digest_size=8, key=row["h"].to_bytes(8, "little", signed=True)
                                   + bytes((level, u))).digest()
            piece = data[low - far:low + LENGTH - near]
            own = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
            yield (int.from_bytes(name, "little", signed=True), own & ~0x7FFF | far << 7 | near, row["d"],
                   row["q"] + low, row["q"] + low - far, far, piece)


def _part_rows(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [p[:4] for p in _parts(batch, level)]
            if rows:
                found = _settle(np.array(rows, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(4)], names=["h", "c", "d", "q"])

    return run


def _part_contexts(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, d, start, low, piece) for h, _, d, _, start, low, piece in _parts(batch, level)]
            if rows:
                yield _context_batch(rows)

    return run


def _index_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor -> marks, from an index for every block of
    whole anchors."""
    held, size = [], 0

    def finish():
        table = pa.concat_tables(held).sort_by([("d", "ascending"), ("q", "ascending")])
        d, q = table.column("d").to_numpy(), table.column("q").to_numpy()
        contexts = table.column("bytes").to_pylist()
        index = RunLengthIndex(contexts)
        at, earliest = index.repeats(LENGTH)
        ends = np.cumsum([len(c) for c in contexts])
        begin = np.concatenate(([0], ends[:-1]))
        row, of = np.searchsorted(ends, at, "right"), np.searchsorted(ends, earliest, "right")
        q_at, q_of = q[row] + at - begin[row], q[of] + earliest - begin[of]
        # equal rows are one document: what starts at the same place is no repeat
        later = (d[row] != d[of]) | (q_at != q_of)
        return _marks(d[row][later], q_at[later])

    for part in key_runs(batches, "h"):
        held.append(part)
        size += part.column("bytes").nbytes
        if size >= 1 << 20:
            yield finish()
            held, size = [], 0
    if held:
        yield finish()


def _marks(d: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
    """Marked windows, neighbours joined."""
    order = np.lexsort((q, d))
    d, q = d[order], q[order]
    cut = np.ones(len(d), bool)
    cut[1:] = (d[1:] != d[:-1]) | (q[1:] - q[:-1] > LENGTH) | (q[1:] >> 32 != q[:-1] >> 32)
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(d)) - 1 if len(d) else first
    return pa.RecordBatch.from_arrays(
        [pa.array(d[first]), pa.array((q[first] >> 32).astype(np.int32)),
         pa.array((q[first] & 0xFFFFFFFF).astype(np.int32)),
         pa.array(((q[last] & 0xFFFFFFFF) + LENGTH).astype(np.int32))], names=["d", "x", "s", "e"])


def spans_of(marks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Packed marks (start << 32 | end) -> maximal spans."""
    m = np.sort(np.array(marks, np.int64))
    s, e = m >> 32, np.maximum.accumulate(m & 0xFFFFFFFF)
    cut = np.ones(len(m), bool)
    cut[1:] = s[1:] > e[:-1]
    first = np.flatnonzero(cut)
    return s[first], e[np.append(first[1:], len(m)) - 1] if len(m) else e


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        texts = batch.column("text").cast(pa.binary())
        for t, marks in zip(texts, batch.column("marks").to_pylist(), strict=True):
            data = t.as_py() or b""
            starts, ends = spans_of(marks or [])
            keep, at = hashlib.sha256(), 0
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                keep.update(data[at:a])
                at = b
            keep.update(data[at:])
            out.append((len(data), int((ends - starts).sum()), len(starts), keep.hexdigest(),
                        [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        cols = [batch.column("id")] + [pa.array(c, k) for c, k in zip(
            zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), span), strict=True)]
        if out:
            yield pa.RecordBatch.from_arrays(
                cols, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(d, x, id, text)``: ``d`` is the id, the greatest number for null;
    ``x`` tells the texts of one ``d`` apart, in order."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).select(
        F.coalesce("id", F.lit(NO_ID)).alias("d"), "id", "text",
        F.concat(F.when(F.col("id").isNull(), "1").otherwise("0"),
                 F.sha2(F.coalesce("text", F.lit("")), 256)).alias("hx"))
    known = stored(rows.select("d", "hx").distinct(), "doctexts")
    several = known.groupBy("d").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d")
    keys = known.join(several, "d", "left_semi").withColumn("part", F.substring("hx", 1, 4))
    upto = Window.partitionBy("d").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = keys.groupBy("d", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "d", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("d", "part").orderBy("hx"))
    numbered = stored(keys.join(starts, ["d", "part"]).select(
        F.col("d").alias("n_d"), F.col("hx").alias("n_hx"), (F.col("start") + nth - 1).cast("int").alias("n_x")),
        "numberedtexts")
    return rows.join(numbered, (F.col("d") == F.col("n_d")) & (F.col("hx") == F.col("n_hx")), "left").select(
        "d", F.coalesce("n_x", F.lit(0)).alias("x"), "id", "text")


def _judged_rows(rows: DataFrame) -> DataFrame:
    return stored(rows.repartition("h").sortWithinPartitions("h", "c", "d", "q").mapInArrow(_judge, _JUDGED), "judged")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 4000
                   ) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` of every
    row; spans are byte offsets, ends exclusive."""
    keyed = _documents(docs, id_col, text_col)
    of_rows, of_contexts = "h long, c long, d long, q long", "h long, d long, q long, low int, bytes binary"
    judged = _judged_rows(keyed.select("d", "x", "text").mapInArrow(_anchor_rows, of_rows))
    found = [judged]
    lists = judged.filter("kind = 1").groupBy("d", "x").agg(F.collect_list(F.struct("h", "s", "e", "p")).alias("borders"))
    contexts = stored(keyed.select("d", "x", "text").join(lists, ["d", "x"]).mapInArrow(_contexts, of_contexts),
                      "contexts")
    marks = []
    for level in range(1, SPAN):
        wide = stored(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(
            F.col("n") > max_rows).select("h"), "wideanchors")
        near = contexts.join(wide, "h", "left_anti").repartition("h").sortWithinPartitions("h")
        marks.append(near.mapInArrow(_index_blocks, "d long, x int, s int, e int"))
        if wide.isEmpty():
            break
        large = stored(contexts.join(wide, "h", "left_semi").select(*contexts.columns), "widecontexts")
        judged = _judged_rows(large.mapInArrow(_part_rows(level), of_rows))
        found.append(judged)
        left = judged.filter("kind = 1").select(
            "h", "d", F.shiftleft(F.col("x").cast("long"), 32).bitwiseOR(F.col("s").cast("long")).alias("q"))
        contexts = stored(large.mapInArrow(_part_contexts(level), of_contexts).join(
            left, ["h", "d", "q"], "left_semi").dropDuplicates(["h", "d", "q"]).select(*contexts.columns), "contexts")
    for judged in found:
        marks.append(judged.filter("kind = 0").select("d", "x", "s", "e"))
    every = marks[0]
    for more in marks[1:]:
        every = every.union(more)
    packed = F.shiftleft(F.col("s").cast("long"), 32).bitwiseOR(F.col("e").cast("long"))
    per_doc = every.groupBy("d", "x").agg(F.collect_list(packed).alias("marks"))
    done = keyed.join(per_doc, ["d", "x"], "left").select("id", "text", "marks").mapInArrow(
        _digest, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                 "spans array<struct<start:int,end:int>>")
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
