"""Mixing sources to target weights with hash-threshold histograms.

Sources in code point order, null last, take the weights in turn. They share
``total`` x the sum of all sizes by weight; a target stops at ``cap`` x its
source's size and the excess is reshared until none is above.

A source with target T and size S takes every document floor(T / S) times,
and once more those whose hash lies below a threshold that spends the rest
R = T - floor(T / S) x S. The thresholds of the copies are nested: who is in
with the smaller budget is in with the larger one. No document is taken more
than ``cap`` times (rounded up).

The threshold is found without sorting: sizes are summed by source and the
top 12 bits of the hash; the running sum over these (at most 4096) buckets
shows the bucket in which the budget ends; only this bucket is split by the
next 12 bits, and so on down to 60 bits. Then one filter picks the documents.
The hash is MD5 of the id and the text, so equal rows share their fate, and
a rerun on any number of machines takes the same documents. Documents at the
very last hash value (one, unless rows are equal) are in if that brings the
sum nearer to the budget.

Only DataFrame functions are used. Tables that meet the documents hold one
row per source. Defined cases: a null text has size 0 and is taken as its
hash says; a null source is a source of its own; a table without words has
targets 0 and takes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billetic.llm._common import n_words, quoted, stored, unused

BITS, LEVELS = 12, 5


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), total: tuple[int, int] = (3, 2),
            cap: int = 2) -> DataFrame:
    """``(source, size)`` per source -> also ``target``. ``total`` is a
    fraction. The capped sources are those with the least size per weight:
    with them in that order, a source is capped iff the level reached when
    all before it are capped is still at or above its own."""
    num, den = total
    if num > cap * den:
        raise ValueError("the total can't exceed cap times all sizes")
    nth = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.pmod(F.row_number().over(nth) - 1, F.lit(len(weights))) + 1).cast("int"))
    up = Window.orderBy((F.col("size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, rest = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    ranked = sizes.select("source", "size", w.alias("w"))
    ranked = ranked.select(
        "*",
        # den x (what is left when all before are capped)
        (num * F.sum("size").over(Window.partitionBy())
         - cap * den * F.coalesce(F.sum("size").over(before), F.lit(0))).alias("left"),
        F.sum("w").over(rest).alias("open"))
    ranked = ranked.withColumn(
        "capped", F.col("left") * F.col("w") >= cap * den * F.col("size") * F.col("open"))
    level = F.max(F.when(~F.col("capped"), F.struct("open", "left"))).over(Window.partitionBy())
    target = F.when(F.col("capped"), (cap * F.col("size")).cast("double")).otherwise(
        (F.col("level.left") * F.col("w")).cast("double") / (F.col("level.open") * den).cast("double"))
    return ranked.withColumn("level", level).select("source", "size", target.alias("target"))


def _digits(hash_col: Column, level: int) -> Column:
    return F.shiftright(hash_col, BITS * (LEVELS - 1 - level)).bitwiseAND(F.lit((1 << BITS) - 1))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """``sized``: (source, hash, size); ``budgets``: (source, budget). Adds
    per source ``edge``: the hashes below it are in, and ``with_edge``: so is
    the edge itself."""
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"),
                           F.lit(0).cast("double").alias("spent"))
    for level in range(LEVELS):
        s = state.select(F.col("source").alias("s_source"), "budget", "prefix", "spent")
        inside = sized.join(s, F.col("source").eqNullSafe(F.col("s_source"))).filter(
            F.shiftright("hash", BITS * (LEVELS - level)) == F.col("prefix"))
        hist = inside.groupBy("source", _digits(F.col("hash"), level).alias("digit")).agg(
            F.sum("size").alias("n"), F.first("budget").alias("budget"),
            F.first("prefix").alias("prefix"), F.first("spent").alias("spent"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("digit")) + F.col("spent")
        # the first bucket whose running sum reaches the budget; if none does, past the last
        run = hist.select("*", upto.alias("upto")).groupBy("source").agg(
            F.first("budget").alias("budget"),
            F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("digit", "n", "upto"))).alias("hit"),
            F.max(F.struct("digit", "n", "upto")).alias("last"), F.first("prefix").alias("prefix"))
        end = F.coalesce("hit", "last")
        state = run.select(
            "source", "budget",
            (F.shiftleft("prefix", BITS) + end["digit"]).alias("prefix"),
            (end["upto"] - end["n"]).cast("double").alias("spent"), end["n"].alias("edge_size"))
    over = F.col("spent") + F.col("edge_size") - F.col("budget")
    return state.select("source", F.col("prefix").alias("edge"),
                        (F.abs(over) < F.col("budget") - F.col("spent")).alias("with_edge"))


def _place(id_col: str, text_col: str) -> Column:
    """A document's 60-bit hash."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                               F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        n_words(text_col).alias("size"), _place(id_col, text_col).alias("hash")), "sized")


def _plan(sized: DataFrame, weights: Sequence[int], total: tuple[int, int], cap: int) -> DataFrame:
    """One row per source: its size, target and thresholds."""
    by_source = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("size")), weights,
                               total, cap), "targets")
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    budgets = by_source.select("*", whole.cast("long").alias("whole")).select(
        "*", (F.col("target") - F.col("whole") * F.col("size")).alias("budget"))
    edges = thresholds(sized.select("source", "hash", "size"), budgets)
    e = edges.select(F.col("source").alias("e_source"), "edge", "with_edge")
    return stored(budgets.join(e, F.col("source").eqNullSafe(F.col("e_source"))).select(
        F.col("source").alias("p_source"), F.col("size").alias("p_size"), F.col("target").alias("p_target"),
        "whole", "edge", "with_edge"), "mixplan")


def _copies(place: Column) -> Column:
    more = F.when((place < F.col("edge")) | ((place == F.col("edge")) & F.col("with_edge")), 1).otherwise(0)
    return (F.col("whole") + more).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (5, 2, 1), total: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, copies, taken``;
    ``copies`` is how often the mix takes the document, ``taken`` its words
    then."""
    sized = _sized(docs, id_col, text_col, source_col)
    plan = _plan(sized, weights, total, cap)
    copies = _copies(F.col("hash"))
    return sized.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id", "source", "size", F.col("p_size").alias("source_size"),
        F.col("p_target").alias("target"), copies.alias("copies"),
        (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: Sequence[int] = (5, 2, 1), total: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """The rows of the mix, columns unchanged: each row as often as it is
    taken. The plan (one row per source) meets the documents where they are
    read; no text is shuffled unless the plan is too large to broadcast."""
    plan = _plan(_sized(docs, id_col, text_col, source_col), weights, total, cap)
    place, of, at, time = (unused(name, docs) for name in ("__place", "__source", "__plan", "__time"))
    plan = plan.select(F.col("p_source").alias(of), F.struct("whole", "edge", "with_edge").alias(at))
    tagged = docs.withColumn(place, _place(id_col, text_col))
    joined = tagged.join(plan, F.col(source_col).eqNullSafe(F.col(of)))
    more = F.when((F.col(place) < F.col(at)["edge"])
                  | ((F.col(place) == F.col(at)["edge"]) & F.col(at)["with_edge"]), 1).otherwise(0)
    times = F.array_repeat(F.lit(1), (F.col(at)["whole"] + more).cast("int"))
    return joined.select(*map(quoted, docs.columns), F.explode(times).alias(time)).drop(time)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS s,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source),
tried AS (
  -- a source is capped iff the level with all sources of less size per weight capped reaches it
  SELECT a.source, a.s, a.w,
         (SELECT 3 * sum(s) FROM by_source) - 4 * coalesce(sum(b.s) FILTER (b.s * a.w < a.s * b.w), 0) AS room,
         sum(b.w) FILTER (b.s * a.w >= a.s * b.w) AS open
  FROM by_source a CROSS JOIN by_source b GROUP BY a.source, a.s, a.w),
level AS (
  SELECT max_by(room, open) AS l_room, max(open) AS l_open FROM tried WHERE room * w < 4 * s * open),
target AS (
  SELECT source, s, CASE WHEN room * w >= 4 * s * open THEN (2 * s)::DOUBLE
    ELSE (l_room * w)::DOUBLE / (l_open * 2)::DOUBLE END AS target
  FROM tried CROSS JOIN level),
budget AS (
  SELECT source, s, target, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS whole FROM target),
run AS (
  SELECT sized.*, s, target, whole, target - whole * s AS budget,
         sum(size) OVER (PARTITION BY sized.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY sized.source, h) AS here
  FROM sized JOIN budget ON sized.source IS NOT DISTINCT FROM budget.source)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
       (size * (whole + CASE WHEN upto < budget OR upto - here < budget AND upto - budget < budget - (upto - here)
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run
"""
