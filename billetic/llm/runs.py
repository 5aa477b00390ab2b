"""Periodic runs of words by Baier grouping.

A run is a stretch of words with least period q (words q apart are the same)
that no neighbour extends, of at least ``max(6, 4 q)`` words here.

Each text is judged on its own, in a map over the rows, so nothing is
shuffled and no group of documents meets:

1. Words are numbered. In a run of four periods every word occurs four times
   and every pair of neighbours three times; a text is cut where this fails,
   and the segments of six words or more go on. No run crosses a cut, and no
   cut can lengthen one.
2. Segments of many texts are laid end to end with separators. Phase one of
   Baier's suffix sorter groups their suffixes: groups are taken from the
   highest down, each finds for its members the nearest earlier suffix of a
   lower group and moves that one up, its prefix longer by the group's. When
   it ends, a group's prefix is its members' longest Lyndon word: the Lyndon
   array, without sorting the suffixes. The same is done with the words'
   order reversed. Time is linear in the words.
3. A run has a Lyndon root that is the longest Lyndon word at its place in one
   of the two orders. So each place with its Lyndon length is extended by the
   longest common extensions to both sides (exact ranks of stretches of 1, 2,
   4, ... words), and long enough ones are runs.

A word is dropped from the collapsed text if a run holds it after that run's
first q words.

Defined cases: a null text, an empty one and one of spaces have no words, no
runs and an empty collapsed text; rows that repeat are judged one by one; an
empty table gives an empty result. Texts of any length are judged whole.
Among runs of equal exponent the least start, then the least period is first.
Only the id and the text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

LEAST, TIMES = 6, 4         # a run's least words, and its least periods
BATCH = 1 << 18             # words whose suffixes are grouped together


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word at each place. Symbol 0 is a
    separator, less than all and never inside a word; the first symbol has to
    be one."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    ranked = symbols[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    opens = np.flatnonzero(first)
    group_of = np.empty(n, np.int64)
    group_of[order] = opens[np.cumsum(first) - 1]
    sizes = np.zeros(n, np.int64)
    sizes[opens] = np.diff(np.append(opens, n))
    low = int((symbols == 0).sum())
    sa, isa, group, size = order.tolist(), place.tolist(), group_of.tolist(), sizes.tolist()
    length, before, found = [1] * n, [0] * n, [0] * n

    end = n
    while end > low:
        g = group[sa[end - 1]]
        u = length[g]
        if end - g == 1:
            i = sa[g]
            end = g
            p = i - 1
            while group[p] > g:
                p = before[p]
            before[i] = p
            found[i] = u
            h = group[p]
            if h < low:
                continue
            m = size[h] - 1
            if not m:
                length[h] += u
                continue
            last, at = h + m, isa[p]
            other = sa[last]
            sa[at], isa[other], sa[last], isa[p] = other, at, p, last
            size[h], size[last], length[last], group[p] = m, 1, length[h] + u, last
            continue
        members = sorted(sa[g:end])
        end = g
        times: dict[int, int] = {}
        for i in members:
            p = i - 1
            while group[p] > g:
                p = before[p]
            if group[p] == g:
                p = before[p]       # less than i, so it is known
            before[i] = p
            found[i] = u
            if group[p] >= low:
                times[p] = times.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, k in times.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):
            moved: dict[int, int] = {}
            for p in by_times[k]:
                h = group[p]
                m = size[h] - 1
                last, at = h + m, isa[p]
                other = sa[last]
                sa[at], isa[other], sa[last], isa[p] = other, at, p, last
                size[h] = m
                moved[h] = moved.get(h, 0) + 1
            for h, m in moved.items():
                start = h + size[h]
                longer = length[h] + k * u
                size[start], length[start] = m, longer
                if start != h:
                    for p in sa[start:start + m]:
                        group[p] = start
    return np.array(found, np.int64)


class Extensions:
    """Longest common extensions inside a text, by exact ranks of all its
    stretches of 1, 2, 4, ... symbols."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.n = len(symbols)
        self.ranks = [symbols]
        while 2 << len(self.ranks) - 1 <= longest:
            step = 1 << len(self.ranks) - 1
            r = self.ranks[-1].astype(np.int64)
            key = r[:-step] * (int(r.max()) + 1) + r[step:] if len(r) > step else r[:0]
            self.ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int32))

    def _walk(self, a: np.ndarray, b: np.ndarray, right: bool) -> np.ndarray:
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r, step = self.ranks[k], 1 << k
            x, y = (a + got, b + got) if right else (a - got - step, b - got - step)
            fits = np.flatnonzero((x >= 0) & (y < len(r)))
            got[fits] += step * (r[x[fits]] == r[y[fits]])
        return got

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal symbols from a and b on (a < b)."""
        return self._walk(a, b, True)

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal symbols before a and b."""
        return self._walk(a, b, False)


def runs_of(segments: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of segments of positive numbers: segment, start, length and period of
    each run, by segment, start and period."""
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    lens = np.array([len(s) for s in segments], np.int64)
    if not lens.sum():
        return none
    n = int(lens.sum()) + len(lens) + 1
    begin = np.cumsum(lens + 1) - lens          # after the separator
    symbols = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[np.concatenate(([0], begin + lens))] = False
    symbols[inside] = np.concatenate(segments)
    top = int(symbols.max()) + 1
    roots = []
    at = np.flatnonzero(inside)
    for order in (symbols, np.where(inside, top - symbols, 0)):
        period = lyndon_lengths(order)[at]
        # a run of four periods holds a root with its first word after it again
        again = at + period < n
        again[again] = symbols[at[again]] == symbols[at[again] + period[again]]
        roots.append(np.stack((at[again], period[again]), 1))
    a, p = np.unique(np.concatenate(roots), axis=0).T
    if not len(a):
        return none
    apart = symbols.copy()
    apart[~inside] = top + np.arange(n - len(at))
    ext = Extensions(apart, int(lens.max()))
    right = ext.right(a, a + p)
    whole = right >= p
    a, p, right = a[whole], p[whole], right[whole]
    left = ext.left(a, a + p)
    start, length = a - left, left + p + right
    long_ = length >= np.maximum(LEAST, TIMES * p)
    if not long_.any():
        return none
    found = np.unique(np.stack((start, p, length), 1)[long_], axis=0)
    of = np.searchsorted(begin, found[:, 0], "right") - 1
    return of, found[:, 0] - begin[of], found[:, 2], found[:, 1]


def segments_of(numbers: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of a text in which runs can lie, as (start, end)."""
    if len(numbers) < LEAST:
        return []
    often = np.bincount(numbers)[numbers] >= TIMES
    if often.sum() < LEAST:
        return []
    pairs = numbers[:-1].astype(np.int64) * (int(numbers.max()) + 1) + numbers[1:]
    both = np.flatnonzero(often[:-1] & often[1:])
    _, which, count = np.unique(pairs[both], return_inverse=True, return_counts=True)
    joined = np.zeros(len(pairs) + 2, np.int8)
    joined[1 + both[count[which] >= TIMES - 1]] = 1
    edge = np.diff(joined)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
    long_ = ends - starts >= LEAST
    return list(zip(starts[long_].tolist(), ends[long_].tolist(), strict=True))


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        found: list[list[tuple]] = [[] for _ in range(len(texts))]
        held, of, size = [], [], 0

        def settle(held, of, found):
            for k, start, length, period in zip(*(x.tolist() for x in runs_of(held)), strict=True):
                row, shift = of[k]
                found[row].append((shift + start, length, period))

        for row, text in enumerate(texts):
            words = (text.as_py() or b"").split()
            if len(words) < LEAST:
                continue
            number = _Numbers()
            numbers = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            for a, b in segments_of(numbers):
                held.append(numbers[a:b] + 1)
                of.append((row, a))
                size += b - a
            if size >= BATCH:
                settle(held, of, found)
                held, of, size = [], [], 0
        if held:
            settle(held, of, found)

        runs, kept = [], []
        for row, text in enumerate(texts):
            data = text.as_py() or b""
            own = sorted(found[row], key=lambda r: (r[0], r[2]))
            words = data.split()
            if own:
                depth = np.zeros(len(words) + 1, np.int64)
                for start, length, period in own:
                    depth[start + period] += 1
                    depth[start + length] -= 1
                words = [w for w, gone in zip(words, np.cumsum(depth)[:-1].tolist(), strict=True) if not gone]
            runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, runs, collapsed)`` of every row: runs as (start, length,
    period) in words, by start, then period, and the text without the
    repeated periods."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_judge, StructType([
        rows.schema["doc_id"], StructField("runs", _parse_datatype_string(
            "array<struct<start:long,length:long,period:long>>")), *_parse_datatype_string("collapsed string").fields]))


def strongest(runs: Column | str) -> Column:
    """The run with the greatest exact length / period; null if there is none."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.aggregate(
        runs, F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
