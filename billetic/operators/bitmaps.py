"""Exact distinct counts that can be merged (A3).

The distinct ids of a group are kept as words: ``id >> 6`` names a word of 64
consecutive ids, whose bits say which of them occur. Words of two days, two
files or two deliveries of the same file merge by ``bit_or`` and are counted
by ``bit_count``, exactly, where plain distinct counts cannot be added.

Both aggregates run in generated code with a map-side partial: a dense group
shuffles one row (key, two longs) per 64 ids instead of one per id, and a
sparse one at most one per id, as an exact distinct count does anyway. (The
built-in 4 KiB bitmaps pack dense ids closer still, but a group with a few
scattered ids costs 4 KiB each, and their binary buffers need a sort.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD, BITS = "id_word", "id_bits"


def id_words(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, id_word) -> id_bits``. ``value`` is an integer column, negative
    ids included; a NULL is no id, but its group stays, with no bit set.
    Other types have no neighbours to share a word with and are refused."""
    if not isinstance(df.schema[value].dataType, T.IntegralType):
        raise TypeError(f"{value} is {df.schema[value].dataType.simpleString()}, expected an integer")
    v = F.col(value).cast("long")
    bit = F.expr(f"shiftleft(1L, CAST(CAST(`{value}` AS BIGINT) & 63 AS INT))")
    return merge_words(
        df.select(*keys, F.shiftright(v, 6).alias(WORD), F.coalesce(bit, F.lit(0).cast("long")).alias(BITS)), keys)


def merge_words(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the id sets of equal ``keys`` (fewer keys than the words
    have: a coarser group, such as a month of days)."""
    return words.groupBy(*keys, WORD).agg(F.bit_or(BITS).alias(BITS))


def count_words(words: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Distinct ids per group of merged words (one row per keys and word)."""
    return words.groupBy(*keys).agg(F.sum(F.bit_count(BITS)).cast("long").alias(out))
