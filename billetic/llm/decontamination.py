"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of words (letters and digits, lower case) in which
numbers, names and units are typed placeholders: a word that starts with a
digit (after a sign or currency) is a number; a known unit right after a
number is a unit; a capitalised word that does not open a sentence is a name.
Windows of ``window`` places are hashed, and the hashes of all documents meet
those of the benchmark in a hash join. A template with fewer literal words than
half its places says nothing and is left out; an item shorter than the
window (five words at least) is one window of its own length.

The same windows are hashed a second time with every word as a literal (case
folded, marks taken off; numbers keep their sign and decimal marks), and both
kinds meet both kinds. Copied words so match whatever their case, and
whatever sentence marks stand between them; lists of names and series of
numbers, which have no template, match as copies.

Windows that match in a row lie on a diagonal (place in the document less
place in the item). A document has leaked an item if on one diagonal the
windows cover ``run`` words (all of a shorter item; all that an item's
templates cover, if that is less) and the slots are consistent: each value of the item's placeholders stands for one value of the
document's, everywhere. A question with other numbers, names or units is so
caught (``reparameterised``), while tables of numbers that happen to have an
item's shape are not.

The benchmark's hashes (8 bytes each) are sent to the tasks as a filter if
there are at most ``max_filter`` of them; otherwise every document window
goes through the join. The result is the same.

Defined cases: null and empty texts, and items under five words, match
nothing. Rows that repeat an id are judged on their own text. An item's first
word is indexed as a literal and as a name, for it may stand inside a
sentence of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billetic.llm._common import stored, unused

NUMBER, NAME, UNIT = np.uint64(1), np.uint64(2), np.uint64(3)
LEAST_WORDS = 5
PIECE = 4 << 20
GROUP = 1 << 20
# Units of measure that may follow a number.
UNITS = frozenset("""
    % percent mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms
    ounce ounces oz pound pounds lb lbs ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons
    ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
    meter meters metre metres kilometer kilometers kilometre kilometres mph kmh hz khz mhz ghz w kw watt watts
    v volt volts a amp amps j joule joules n newton newtons pa k c f degree degrees cent cents dollar dollars
    euro euros usd eur gbp byte bytes kb mb gb tb
""".split())
_NUMBER = re.compile(r"^[^\w]*\d")
_OTHER = re.compile(r"(?:(?!%)[\W_])+")
_AROUND = re.compile(r"^(?:(?![-+−.#$€£¥%])[\W_])+|(?:(?!%)[\W_])+$")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ITEM_SCHEMA = "item_id long, win long, ipos int, n int, islots array<string>, need int, words int, rich boolean"
_WINDOW_SCHEMA = "doc_id long, text_hash long, win long, pos int, slots array<string>"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(32))) * _MIX + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


class Sequences:
    """The canonical words of several texts, one after the other."""

    def __init__(self, texts: pa.Array):
        split = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        lens = pc.list_value_length(split).to_numpy()
        coded = pc.list_flatten(split).dictionary_encode()
        raw = coded.dictionary.to_pylist()
        number = np.array([bool(_NUMBER.match(w)) for w in raw], bool)
        clean = [(_AROUND if x else _OTHER).sub("", w).casefold() for w, x in zip(raw, number, strict=True)]
        unit = np.array([w.strip(".,;:!?()\"'").lower() in UNITS for w in raw], bool)
        title = np.array([(c := w.lstrip("\"'([{«“‘"))[:1].isupper() and not c[1:2].isupper() for w in raw], bool)
        ends = np.array([w.rstrip("\"')]}»”’")[-1:] in (".", "!", "?") for w in raw], bool)
        word = np.array([bool(w) for w in clean], bool)
        hashes = pd.util.hash_array(np.array(clean, object), categorize=False).astype(np.uint64)
        hashes = np.where(hashes < 8, hashes + np.uint64(8), hashes)

        ids = coded.indices.to_numpy()
        doc = np.repeat(np.arange(len(texts)), lens)
        keep = word[ids]
        self.raw, self.clean, self.ids, self.doc = raw, clean, ids[keep], doc[keep]
        ids, doc = self.ids, self.doc
        opens = np.ones(len(ids), bool)
        opens[1:] = (doc[1:] != doc[:-1]) | ends[ids[:-1]]
        is_number = number[ids]
        after = np.zeros(len(ids), bool)
        after[1:] = is_number[:-1] & (doc[1:] == doc[:-1])
        self.code = np.where(is_number, NUMBER, np.where(
            after & unit[ids], UNIT, np.where(title[ids] & ~opens, NAME, hashes[ids])))
        self.title = title[ids] & opens & ~is_number
        self.literal = hashes[ids]
        self.first = np.searchsorted(doc, np.arange(len(texts)))

    def windows(self, n: int, code: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of ``n`` (5 or more) places that
        stay in their text and have enough literals."""
        code = self.code if code is None else code
        if len(code) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        h, size = code, 1
        while size * 2 <= n:
            h, size = _mix(h[:-size], h[size:]), size * 2
        if size < n:
            h = _mix(h[: len(h) - (n - size)], h[n - size:])
        literals = np.concatenate(([0], np.cumsum(code > UNIT)))
        ok = (self.doc[n - 1:] == self.doc[: len(h)]) & (2 * (literals[n:] - literals[:-n]) >= n)
        at = np.flatnonzero(ok)
        return at, h[at] + np.uint64(n)

    def slots(self, at: int, n: int, code: np.ndarray | None = None) -> list[str]:
        code = self.code if code is None else code
        kinds = {1: "number", 2: "name", 3: "unit"}
        return [f"{kinds[int(code[i])]}:{self.clean[self.ids[i]]}" if code[i] <= UNIT else ""
                for i in range(at, at + n)]

    def differ(self, n: int) -> np.ndarray:
        """For each start whether the window has placeholders, and so another
        hash as literals."""
        slots = np.concatenate(([0], np.cumsum(self.code <= UNIT)))
        return slots[n:] > slots[:-n]


def item_windows(item_id: int, text: str | None, window: int, run: int) -> list[tuple]:
    """Rows of the benchmark's index for one item."""
    seq = Sequences(pa.array([text], pa.large_string()))
    words = len(seq.code)
    if words < LEAST_WORDS:
        return []
    n = min(window, words)
    codes = [seq.code]
    if seq.title[0]:
        named = seq.code.copy()
        named[0] = NAME
        codes.append(named)
    rows, covered = [], set()
    for k, code in enumerate(codes):
        at, h = seq.windows(n, code)
        for i, x in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
            if k == 0 or i == 0:
                rows.append((x, i, seq.slots(i, n, code)))
                covered.update(range(i, i + n))
    rich = {i for _, i, _ in rows}
    at, h = seq.windows(n, seq.literal)
    pick = seq.differ(n)[at]
    rows += [(x, i, [""] * n) for i, x in zip(at[pick].tolist(), h[pick].view(np.int64).tolist(), strict=True)]
    need = min(run, len(covered))
    return [(item_id, x, i, n, s, need, words, i in rich) for x, i, s in rows]


def _index(window: int, run: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = [r for i, t in zip(df["item_id"], df["text"], strict=True)
                    for r in item_windows(None if pd.isna(i) else int(i), t, window, run)]
            yield pd.DataFrame(rows, columns=["item_id", "win", "ipos", "n", "islots", "need", "words", "rich"])

    return build


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[str], bool]]:
    """Texts in groups of about GROUP characters: (rows, texts, whether it
    goes on). A text over PIECE characters comes in pieces cut at white space."""
    rows, part, size = [], [], 0
    for row, text in enumerate(texts):
        text = text or ""
        if len(text) > PIECE:
            at = 0
            while at < len(text):
                cut = re.compile(r"\s").search(text, at + PIECE)
                end = cut.start() if cut else len(text)
                yield [row], [text[at:end]], end < len(text)
                at = end
            continue
        rows.append(row)
        part.append(text)
        size += len(text)
        if size > GROUP:
            yield rows, part, False
            rows, part, size = [], [], 0
    if rows:
        yield rows, part, False


def _find(sizes: list[int], known: np.ndarray | None):
    most = max(sizes)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("text_hash").to_numpy()
            out, base, tail = [], 0, ""
            for rows, texts, more in _pieces(t.as_py() for t in batch.column("text")):
                seq = Sequences(pa.array([f"{tail} {texts[0]}" if tail else texts[0], *texts[1:]],
                                         pa.large_string()))
                for n in sizes:
                    for code in (seq.code, seq.literal):
                        at, h = seq.windows(n, code)
                        if code is seq.literal:
                            other = seq.differ(n)[at]
                            at, h = at[other], h[other]
                        if known is not None and len(h):
                            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                            hit = known[place] == h
                            at, h = at[hit], h[hit]
                        for i, x in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
                            d = int(seq.doc[i])
                            out.append((rows[d], x, base + i - int(seq.first[d]), seq.slots(i, n, code)))
                if more:
                    # the next piece starts with the last words of this one
                    last = [seq.raw[j] for j in seq.ids[-2 * most:]]
                    base += len(seq.ids) - len(last)
                    tail = " ".join(last)
                else:
                    base, tail = 0, ""
                while len(out) >= 20_000 or (out and not more):
                    part, out = out[:20_000], out[20_000:]
                    r = [o[0] for o in part]
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(r)), pa.array(hashes[r]), pa.array([o[1] for o in part], pa.int64()),
                        pa.array([o[2] for o in part], pa.int32()),
                        pa.array([o[3] for o in part], pa.list_(pa.string()))],
                        names=["doc_id", "text_hash", "win", "pos", "slots"])

    return find


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = 8, run: int = 13,
          max_filter: int = 2_000_000) -> DataFrame:
    """One row per document and leaked item: ``doc_id, item_id, text_hash,
    matched_words, item_words, n_places`` (diagonals), ``n_slots`` (different
    values compared), ``reparameterised``."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    index = stored(items.mapInPandas(_index(window, run), _ITEM_SCHEMA), "index")
    spark = docs.sparkSession
    sizes = sorted(r["n"] for r in index.select("n").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long, text_hash long, matched_words int, "
                                         "item_words int, n_places long, n_slots int, reparameterised boolean")
    hashes = index.select("win").distinct()
    known = None
    if index.count() <= max_filter:
        known = np.sort(np.array([r["win"] for r in hashes.collect()], np.int64).view(np.uint64))
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.col(text_col).alias("text")).mapInArrow(_find(sizes, known), _WINDOW_SCHEMA)
    met = found.join(index, "win").withColumn(
        "pairs", F.filter(F.arrays_zip("islots", "slots"), lambda p: p["islots"] != ""))
    lines = met.groupBy("doc_id", "text_hash", "item_id", (F.col("pos") - F.col("ipos")).alias("line")).agg(
        F.collect_set(F.struct("ipos", "rich", "pairs")).alias("windows"),
        F.first("n").alias("n"), F.first("need").alias("need"), F.first("words").alias("words"))

    def places(windows: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(
            windows["ipos"], lambda p: F.sequence(p, p + F.col("n") - 1))))

    def consistent(windows: Column) -> Column:
        pairs = F.array_distinct(F.flatten(windows["pairs"]))
        return F.size(pairs) == F.size(F.array_distinct(pairs["islots"]))

    def rich(windows: Column) -> Column:
        return F.filter(windows, lambda w: w["rich"])

    def leaked(windows: Column) -> Column:
        return ((F.size(places(windows)) >= F.least(F.lit(run), "words"))
                | ((F.size(rich(windows)) > 0) & (F.size(places(rich(windows))) >= F.col("need"))))

    def stretch(first: Column, words: Column) -> Column:
        """The windows inside ``words`` words from a place on."""
        return F.filter("windows", lambda w: (w["ipos"] >= first) & (w["ipos"] + F.col("n") <= first + words))

    # a diagonal that contradicts itself counts as far as its stretches don't
    starts = F.array_distinct(F.col("windows.ipos"))
    good = F.array_distinct(F.concat(*[F.flatten(F.transform(starts, lambda p, m=m: F.when(
        consistent(stretch(p, m)) & leaked(stretch(p, m)), stretch(p, m)).otherwise(F.slice("windows", 1, 0))))
        for m in (F.least(F.lit(run), "words"), F.col("need"))]))
    lines = lines.withColumn("windows", F.when(consistent(F.col("windows")), F.col("windows")).otherwise(good))
    lines = lines.filter((F.size("windows") > 0) & leaked(F.col("windows"))).withColumns({
        "covered": F.size(places(F.col("windows"))), "pairs": F.array_distinct(F.flatten(F.col("windows.pairs")))})
    return lines.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("covered").alias("matched_words"), F.first("words").alias("item_words"),
        F.count(F.lit(1)).alias("n_places"), F.max(F.size("pairs")).alias("n_slots"),
        F.min(F.exists("pairs", lambda p: p["islots"] != p["slots"])).alias("reparameterised"),
    ).select("doc_id", "item_id", "text_hash", "matched_words", "item_words", "n_places", "n_slots",
             "reparameterised")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` that leak no item; columns unchanged."""
    of, hashed = unused("__id", docs), unused("__hash", docs)
    bad = stored(leaks(docs, benchmark, id_col, text_col, **options).select(
        F.col("doc_id").alias(of), F.col("text_hash").alias(hashed)).distinct(), "leaked")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(of)) & (F.xxhash64(F.col(text_col)) == F.col(hashed))
    return docs.join(bad, same, "left_anti")
