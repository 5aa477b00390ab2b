"""Spelling variants by an index of variable-length grams.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word of most occurrences, if it has
``times`` as many as the word; its root is where the forms lead.

1. Words are counted with DataFrame functions; only words of at least
   ``least_points`` code points and ``least_count`` occurrences go on, once
   each.
2. The gram dictionary is a trie of grams of 2 to 4 code points, pruned by
   frequency: a gram has longer ones below it only if it occurs in the words
   more than ``1 / SHARE`` times their number. At most 3 x SHARE x (mean
   length) grams are that frequent, whatever the number of words; they are the
   dictionary that goes to the tasks.
3. A word is decomposed into one gram at each place: the shortest there that
   is not frequent, or else the longest. One edit changes only grams that
   hold its place, so a word's bound is the most grams over one place; the
   other grams are also in every near word, moved by at most one place.
4. A word's grams are put in order, the rarest first. Of two near words, the
   first gram in this order that the edit left alone is among the first
   (bound + 1) of both, since only changed grams come before it. So these few
   go into the lists, keyed by gram, place and length (the shorter word of an
   insertion goes to both places its gram may have in the longer one). Lists
   are merged in the tasks that read them: all their pairs are verified in
   arrays, and only near words leave. Lists over ``block`` words are cut into
   pairs of chunks, so no task holds a long list.
5. Each pair once; counts and forms by plain aggregates; roots by doubling.
   A form has ``times`` times the occurrences, so chains are short.

The result is exact: the dictionary only steers which lists are read.

Defined cases: null texts have no words; a null id writes nothing before the
colon; equal rows count as often as they stand; a table without words gives an
empty result. Of near words with equal counts the least in code-point order is
the form. Words of any length are kept whole. Only the id and the text are
read, so other columns may have any names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billetic.llm._common import key_runs, run_bounds, stored

SHORTEST, LONGEST = 2, 4        # code points of a gram
SHARE = 4000
PAIRS = 1 << 21                 # pairs verified at a time
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_runs(text: Column | str) -> Column:
    """The maximal runs of letters of a text, A-Z lower-cased."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit("[a-zÀ-ÿ]+"), F.lit(0))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = 7,
                least_count: int = 2, drop_one_in: int | None = 31) -> DataFrame:
    """``(word, n)``. A run whose hash with the id is divided by
    ``drop_one_in`` loses one code point (None: no run does)."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"),
                       F.explode(word_runs(F.col(text_col))).alias("w"))
    rows = rows.filter(F.char_length("w") >= least_points)
    word = F.col("w")
    if drop_one_in:
        rows = rows.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")))
        at = (F.col("h") % F.char_length("w")).cast("int")
        word = F.when(F.col("h") % drop_one_in == 0, F.concat(
            F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.char_length("w")))).otherwise(F.col("w"))
    return rows.select(word.alias("word")).filter(F.char_length("word") >= least_points).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and code matrix of the words of each length."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lens).tolist():
        rows = np.flatnonzero(lens == n)
        yield rows, np.frombuffer(b"".join([words[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), n)


def _codes(matrix: np.ndarray, q: int) -> np.ndarray:
    """A number for the gram of ``q`` code points at each place."""
    places = matrix.shape[1] - q + 1
    code = np.full((len(matrix), max(places, 0)), q, np.int64)
    for k in range(q):
        code = code << 8 | matrix[:, k:k + places]
    return code


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [_codes(m, q).ravel() for _, m in _by_length(_latin(batch.column("word")))
                 for q in range(SHORTEST, LONGEST + 1)]
        if parts:
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])


class GramIndex:
    """The frequent grams of the dictionary, and what follows from them for a
    word: its grams, their order and its bound."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]

    def _count(self, codes: np.ndarray) -> np.ndarray:
        """Occurrences of frequent grams; 0 for others."""
        if not len(self.grams):
            return np.zeros(codes.shape, np.int64)
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        return np.where(self.grams[at] == codes, self.counts[at], 0)

    def decompose(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words of one length: gram, its count and its length at each
        place, and each word's bound."""
        m, n = matrix.shape
        gram = _codes(matrix, SHORTEST)
        count = self._count(gram)
        size = np.full(gram.shape, SHORTEST, np.int64)
        for q in range(SHORTEST + 1, LONGEST + 1):
            longer = _codes(matrix, q)
            places = longer.shape[1]
            grow = (size[:, :places] == q - 1) & (count[:, :places] > 0)
            c = self._count(longer)
            gram[:, :places][grow], count[:, :places][grow], size[:, :places][grow] = longer[grow], c[grow], q
        # grams over each place, and those that would be longer if the word went on
        over = np.zeros((m, n + 1), np.int64)
        rows = np.arange(m)
        for i in range(gram.shape[1]):
            over[:, i] += 1
            over[rows, i + size[:, i]] -= 1
        bound = np.cumsum(over, 1).max(1)
        at_end = (np.arange(gram.shape[1]) + size == n) & (count > 0) & (size < LONGEST)
        return gram, count, size, np.maximum(bound, at_end.sum(1))

    def signature(self, matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, place, gram) of the grams a word is listed under: for each of
        the first places in its order, of the rows whose bound reaches it."""
        gram, count, _, bound = self.decompose(matrix)
        place = np.broadcast_to(np.arange(gram.shape[1]), gram.shape)
        order = np.lexsort((place, gram, count), axis=1)
        for k in range(int(bound.max()) + 1):
            rows = np.flatnonzero(bound >= k)
            at = order[rows, k]
            yield rows, at, gram[rows, at]


def _key(gram: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    x = gram.astype(np.uint64) * _M1
    x ^= x >> np.uint64(32)
    x += place.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(length)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x.view(np.int64)


def _list_words(grams: np.ndarray, counts: np.ndarray):
    index = GramIndex(grams, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _latin(batch.column("word"))
            for rows, matrix in _by_length(words):
                n = matrix.shape[1]
                for at, place, gram in index.signature(matrix):
                    keys = [_key(gram, place, n), _key(gram, place, n + 1), _key(gram, place + 1, n + 1)]
                    of = pa.array(np.tile(rows[at], 3))
                    frame = np.repeat(np.array([n, n + 1, n + 1], np.int32), len(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(frame), batch.column("word").take(of),
                         batch.column("n").take(of)], names=["key", "frame", "word", "n"])

    return run


def near_in_frame(matrix: np.ndarray, a: np.ndarray, b: np.ndarray, short_b: bool) -> np.ndarray:
    """Of pairs of rows: do they differ by one replaced code point, or
    (``short_b``: b lacks the last column) by one deleted from a? Words are
    distinct."""
    if not short_b:
        return (matrix[a] != matrix[b]).sum(1) == 1
    n = matrix.shape[1]
    x, y = matrix[a], matrix[b][:, :n - 1]
    head, tail = x[:, :n - 1] != y, x[:, 1:] != y
    first = np.where(head.any(1), head.argmax(1), n - 1)
    last = np.where(tail.any(1), n - 2 - tail[:, ::-1].argmax(1), -1)
    return last < first


def _merge_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in key_runs(batches, "slot"):
        part = part.combine_chunks()
        words = _latin(part.column("word").combine_chunks())
        lens = np.fromiter(map(len, words), np.int64, len(words))
        frame = part.column("frame").to_numpy()
        chunk = part.column("chunk").to_numpy()
        whole = part.column("lo").to_numpy() == part.column("hi").to_numpy()
        starts, ends = run_bounds(part.column("slot").to_numpy())
        stop = np.repeat(ends, ends - starts)
        later = stop - np.arange(len(words)) - 1            # rows of the list after each
        upto = np.cumsum(later)
        at = 0
        while at < len(words):
            cut = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right"))
            cut = max(cut, at + 1)
            k = later[at:cut]
            a = np.repeat(np.arange(at, cut), k)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(k) - k, k)
            ok = (frame[a] == frame[b]) & (whole[a] | (chunk[a] != chunk[b])) & (
                (lens[a] == frame[a]) | (lens[b] == frame[b]))
            a, b = a[ok], b[ok]
            at = cut
            # the longer word first; of equal ones the lesser, as they are sorted
            swap = lens[a] < lens[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            found = []
            kind = frame[a] * 2 + (lens[a] != lens[b])
            for one in np.unique(kind).tolist():
                n, short = one >> 1, bool(one & 1)
                pairs = np.flatnonzero(kind == one)
                used, back = np.unique(np.concatenate((a[pairs], b[pairs])), return_inverse=True)
                matrix = np.frombuffer(b"".join([words[i].ljust(n, b"\0") for i in used.tolist()]),
                                       np.uint8).reshape(len(used), n)
                left, right = back[:len(pairs)], back[len(pairs):]
                step = max(1, (32 << 20) // n)
                for p in range(0, len(pairs), step):
                    near = near_in_frame(matrix, left[p:p + step], right[p:p + step], short)
                    found.append(pairs[p:p + step][near])
            if found and len(near := np.concatenate(found)):
                a, b = pa.array(a[near]), pa.array(b[near])
                yield pa.RecordBatch.from_arrays(
                    [c.combine_chunks() for c in (part.column("word").take(a), part.column("n").take(a),
                                                  part.column("word").take(b), part.column("n").take(b))],
                    names=["word", "n", "other", "other_n"])


def near_words(words: DataFrame, block: int = 2000) -> DataFrame:
    """``(word, n)`` of distinct words of at least 6 code points up to U+00FF
    -> ``(word, n, other, other_n)``: every near pair, once."""
    grams = words.mapInArrow(_count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    least = max(32, words.count() // SHARE)
    frequent = grams.filter(F.col("n") > least).toArrow()
    lists = words.mapInArrow(
        _list_words(frequent["gram"].to_numpy(), frequent["n"].to_numpy()),
        "key long, frame int, word string, n long")
    lists = stored(lists, "gramlists")
    big = stored(lists.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > block).select(
        F.col("key").alias("b_key"), F.ceil(F.col("m") / block).cast("int").alias("chunks")), "longlists")
    cut = lists.join(big, lists["key"] == big["b_key"], "left").select(
        "key", "frame", "word", "n", F.coalesce("chunks", F.lit(1)).alias("chunks"),
        F.pmod(F.xxhash64("word"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"))
    dealt = cut.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", "frame", "word", "n", "chunk", F.least("chunk", "partner").alias("lo"),
        F.greatest("chunk", "partner").alias("hi")).withColumn("slot", F.xxhash64("key", "lo", "hi")).drop("key")
    return dealt.repartition("slot").sortWithinPartitions("slot", "word").mapInArrow(
        _merge_lists, "word string, n long, other string, other_n long").dropDuplicates(["word", "other"])


def variant_groups(words: DataFrame, times: int = 10, block: int = 2000) -> DataFrame:
    """``(word, n)`` -> ``(word, n, n_near, form, form_n, root)``."""
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_words(words, block), "nearwords")
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = F.min(F.when(F.col("other_n") >= times * F.col("n"),
                        F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))))
    judged = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    forms = stored(judged.select(
        F.col("word").alias("w"), "n_near", F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n")),
        "forms")
    tops = stored(forms.filter(F.col("form").isNotNull()).select("w", F.col("form").alias("top")), "tops")
    while True:
        up = tops.select(F.col("w").alias("u"), F.col("top").alias("higher"))
        moved = stored(tops.join(up, tops["top"] == up["u"], "left").select(
            "w", F.coalesce("higher", "top").alias("top"), F.col("higher").isNotNull().alias("moved")), "tops")
        tops = moved.select("w", "top")
        if moved.filter("moved").isEmpty():
            break
    rooted = forms.join(tops.withColumnRenamed("w", "t"), F.col("w") == F.col("t"), "left").select(
        "w", "n_near", "form", "form_n", "top")
    return words.join(rooted, words["word"] == rooted["w"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form",
        F.col("form_n").cast("long").alias("form_n"), F.coalesce("top", "word").alias("root"))
